"""Registries, manifests, retention and streams on small cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import times
from tessera.operators import monitor
from tessera.schemas import UPLOAD_EVENT
from tessera.sources import manifests, objects, registry
from tessera.streaming import receipts


def test_upsert_and_first_writer(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("a", 2, None)], "k string, seq int, v string")
    assert {tuple(r) for r in registry.latest_state(log, "k", "seq").select("k", "v").collect()} == {("a", None), ("b", "y")}
    more = spark.createDataFrame([("b", 3, "z")], "k string, seq int, v string")
    assert {tuple(r) for r in registry.upsert(log, more, "k", "seq").select("k", "v").collect()} == {("a", None), ("b", "z")}
    new, refused = registry.insert_if_absent(spark.createDataFrame([("a", 1), ("c", 2), ("c", 1)], "k string, n int"), log, "k", F.col("n"))
    assert [tuple(r) for r in new.collect()] == [("c", 1)] and refused.count() == 2
    assert [r["k"] for r in registry.scan_filtered(log, F.col("seq") == 1, 1, ("k",)).collect()] == ["a"]
    assert registry.lookup(log, "k", "b").count() == 1


def test_tagged_items(spark):
    item = '{"id": {"S": "x"}, "n": {"N": "3"}, "ok": {"BOOL": true}, "ids": {"L": [{"S": "a"}, {"S": "b"}]}}'
    rows = spark.read.json(spark.sparkContext.parallelize([item]))
    assert tuple(registry.from_attributes(rows, {"id": "string", "n": "bigint", "ok": "boolean", "ids": "array<string>"}).first()) == ("x", 3, True, ["a", "b"])


def test_manifests_and_transforms(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"label": "A", "submissionId": "", "submissionIdTemplate": "s-{run_id}-a", "files": [{"fileId": "f", "source": "x.json"}]}))
    row = manifests.manifests(spark, str(tmp_path / "m.json"), "7").first()
    assert (row["submissionId"], row["files"][0]["fileId"]) == ("s-7-a", "f")
    (tmp_path / "e.json").write_text(json.dumps({"label": "E", "files": []}))
    with pytest.raises(Exception, match="no files"):
        manifests.manifests(spark, str(tmp_path / "e.json"), "7").collect()
    source = '{"a": "é", "b": [1, 2]}'.encode()
    assert manifests.file_bytes(source, None) == source
    assert manifests.file_bytes(source, {"type": "compact_json"}) == '{"a":"é","b":[1,2]}'.encode()
    assert manifests.file_bytes(source, {"type": "update_top_level_fields", "fields": {"a": "x"}}).endswith(b"}\n")
    with pytest.raises(ValueError, match="unknown"):
        manifests.file_bytes(source, {"type": "other"})


def test_retention_and_ages(spark):
    rows = spark.createDataFrame([("ingestion/a", 13), ("ingestion/b", 15), ("processed/a", 4), ("canonical/a", 900)], "key string, days int")
    now = F.lit("2026-01-31 00:00:00").cast("timestamp")
    aged = rows.withColumn("at", now - F.make_dt_interval(F.col("days")))
    assert {r["key"] for r in objects.live(aged, "key", "at", now).collect()} == {"ingestion/a", "canonical/a"}
    ages = spark.sql("select timestamp'2026-01-01 00:15:00' as now, explode(array(timestamp'2026-01-01 00:00:01', timestamp'2026-01-01 00:00:00', timestamp'2025-12-31 23:59:59', null)) as ts")
    assert [r[0] for r in ages.select(monitor.older("ts", F.col("now"))).collect()] == [False, True, True, False]
    row = spark.range(1).select(times.utc_text(times.parsed(F.lit("2026-01-01T00:00:00.5Z"))), times.clock_run_id(times.parsed(F.lit("2026-01-01T10:20:30Z"))), times.parsed(F.lit("no"))).first()
    assert tuple(row) == ("2026-01-01T00:00:00.500000Z", "20260101102030", None)


def test_streamed_receipts_are_each_taken_once(spark, tmp_path):
    source = tmp_path / "events"
    source.mkdir()
    event = lambda *ks: json.dumps({"Records": [{"eventName": "x", "s3": {"bucket": {"name": "b"}, "object": {"key": k, "sequencer": "1"}}} for k in ks]})
    taken: list[tuple] = []
    each = lambda batch, n: taken.extend((r["submissionId"], r["fileId"]) for r in batch.collect())
    stream = lambda: receipts.recorded(receipts.upload_events(spark, str(source), UPLOAD_EVENT))
    (source / "1.json").write_text(event("ingestion/s/a", "ingestion/s/a", "other/s/b"))
    receipts.drain(stream(), each, str(tmp_path / "state"))
    (source / "2.json").write_text(event("ingestion/s/a", "ingestion/s/c+d"))
    receipts.drain(stream(), each, str(tmp_path / "state"))
    assert sorted(taken) == [("s", "a"), ("s", "c d")]


def test_dashboards_fill_gaps(spark):
    rows = spark.sql("select 'A' as status, timestamp'2026-01-01 00:01:00' as ts, 2.0D as value union all select 'B', timestamp'2026-01-01 00:07:00', 3.0D")
    assert sorted(tuple(r)[1:] for r in monitor.dashboard(rows, ["A", "B"]).collect()) == [(0.0, 3.0), (2.0, 0.0)]
    alarm = monitor.alarms(rows.withColumn("name", F.lit("n")), 3, "max").where("inAlarm").collect()
    assert [r["value"] for r in alarm] == [3.0]


def test_transforms_of_fixtures():
    source = b'{"b": 1, "a": "\xc3\xa9"}'
    assert manifests.file_bytes(source, {"type": "update_top_level_fields"}) == '{\n  "b": 1,\n  "a": "é"\n}\n'.encode()
    assert manifests.file_bytes(source, {"type": "update_top_level_fields", "fields": {"c": 2, "b": 3}}) == '{\n  "b": 3,\n  "a": "é",\n  "c": 2\n}\n'.encode()
    assert manifests.file_bytes(source, {"type": "compact_json"}) == '{"b":1,"a":"é"}'.encode() and manifests.file_bytes(source, {}) == manifests.file_bytes(source, None) == source
    for bad in ({"type": "update_top_level_fields", "fields": {"a": 1}}, {"type": "update_top_level_fields"}):
        with pytest.raises(ValueError, match="object"):
            manifests.file_bytes(b"[1]", bad)
    with pytest.raises(ValueError, match="unknown"):
        manifests.file_bytes(source, {"type": "odd"})


def test_new_rows_are_dealt_out_once(spark):
    """Rows that are inserted are not joined to their own numbers again; the first row of each key stays whole."""
    rows = spark.createDataFrame([("a", 1, "x"), ("c", 2, "y"), ("c", 1, "z"), (None, 3, "n")], "k string, n int, s string")
    new, refused = registry.insert_if_absent(rows, spark.createDataFrame([("a",)], "k string"), "k", F.col("n"))
    assert new.columns == rows.columns
    assert sorted(map(tuple, new.collect()), key=str) == [("c", 1, "z"), (None, 3, "n")]
    assert sorted(map(tuple, refused.collect())) == [("a", 1, "x"), ("c", 2, "y")]
    assert new._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_few_keys_are_sent_to_the_rows(spark):
    from tessera.functions import keys
    from tessera.operators import dedupe

    rows = spark.createDataFrame([(i, f"h{i % 3}") for i in range(9)], "n int, h string")
    both = [dedupe.with_first(rows, "h", ("n",), few) for few in (False, True)]
    assert sorted(map(tuple, both[0].collect())) == sorted(map(tuple, both[1].collect()))
    assert "rightHint=(strategy=broadcast)" in both[1]._jdf.queryExecution().optimizedPlan().toString()
    said = spark.createDataFrame([("a",), (None,), ("",)], "c string").select(keys.content_hash(F.col("c")), keys.hash_of_digest(keys.digest(F.col("c"))))
    assert all(a == b for a, b in said.collect())
