"""The ingestion scenarios from upload to scoped retrieval, on files in a folder."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.operators import receipts
from tessera.plans import engine as engine_module
from tessera.plans.engine import Engine
from tessera.schemas import UPLOAD_EVENT
from tessera.sources import manifests, objects, reports


def report(number: int, topic: str) -> bytes:
    body = {
        "report_id": f"sample-{number:03d}", "title": topic, "report_date": "2026-04-18", "source_version": "v1",
        "executive_summary": [f"{topic} grows.", f"Buyers of {topic} wait."], "segments": [{"segment_id": f"s{number}", "segment_name": f"{topic} in cities", "risk_notes": ["cost", "staff"]}],
    }
    return json.dumps(body, indent=1).encode()


TOPICS = ["warehouse robots", "vertical farming", "pet insurance veterinary", "cloud kitchens", "telehealth", "recycling", "modular building"]
SOURCES = {t: report(i, t) for i, t in enumerate(TOPICS)}
SETS = {
    "A": [(TOPICS[0], None), (TOPICS[1], None)],
    "B": [(TOPICS[2], None), (TOPICS[3], None)],
    "C": [(TOPICS[0], None), (TOPICS[4], None)],
    "D": [(TOPICS[0], {"type": "compact_json"}), (TOPICS[5], None)],
    "E": [(TOPICS[0], {"type": "update_top_level_fields", "fields": {"source_version": "v2", "report_date": "2026-04-19", "title": "warehouse robots, revised"}}), (TOPICS[6], None)],
}


class Clock:
    def __init__(self):
        self.at = datetime(2026, 5, 1, tzinfo=timezone.utc)

    def __call__(self) -> datetime:
        self.at += timedelta(seconds=1)
        return self.at


def events(spark, *uploads: str):
    record = lambda key, i: {"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {"key": key, "sequencer": f"{i:04d}"}}}
    return spark.createDataFrame([([record(k, i) for i, k in enumerate(uploads)],)], UPLOAD_EVENT)


def upload(spark, engine: Engine, root: Path, sid: str, files: list[tuple[str, bytes]]) -> None:
    for name, content in files:
        path = root / "ingestion" / sid / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    engine.receive(events(spark, *(f"ingestion/{sid}/{n}" for n, _ in files)))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    engine = Engine(spark, str(root), clock=Clock())
    for label, files in SETS.items():
        named = [(f"f{i}.json", manifests.file_bytes(SOURCES[t], how)) for i, (t, how) in enumerate(files)]
        upload(spark, engine, root, label, named)
        assert engine.complete(label, ["f0.json", "f1.json"])["isValid"]
    while engine.coordinate(batch=4) == "SUCCEEDED":
        pass
    engine.refresh()
    return engine


def documents_of(engine: Engine) -> dict[str, list[str]]:
    return {r["submissionId"]: r["documentIds"] for r in engine.state("submissions").collect()}


def by_title(engine: Engine) -> dict:
    return {r["documentId"]: r for r in engine.state("documents").collect()}


def test_each_submission_is_ready_with_two_documents(world):
    rows = world.state("submissions").collect()
    assert {r["submissionId"]: r["status"] for r in rows} == dict.fromkeys(SETS, "READY")
    assert all(len(r["documentIds"]) == 2 and r["callbackStatus"] == "DELIVERED" for r in rows)


def test_equal_bytes_and_equal_text_share_a_document(world):
    ids = {k: set(v) for k, v in documents_of(world).items()}
    assert len(ids["A"] & ids["C"]) == 1 and ids["A"] & ids["C"] == ids["A"] & ids["D"]
    assert not ids["A"] & ids["E"] and not ids["A"] & ids["B"]
    hashes = world.state("raw_files").groupBy("canonicalHash").agg(F.count("*").alias("n")).where("n > 1").collect()
    assert [r["n"] for r in hashes] == [2]  # as uploaded and compact


def test_a_new_version_replaces_the_old_one(world):
    versions = world.state("documents").where("businessDocumentKey = 'sample-000'").collect()
    assert {(r["sourceVersion"], r["isActive"]) for r in versions} == {("v1", False), ("v2", True)}


def test_retrieval_stays_within_the_submission(world):
    ids = documents_of(world)
    for sid in ("A", "B"):
        found = world.query(sid, "veterinary expenses of pet owners", 99)
        assert found["retrievedDocumentIds"] and set(found["retrievedDocumentIds"]) <= set(ids[sid])
        assert found["summary"] == f"Summary placeholder: retrieved {len(found['retrievalResults'])} scoped chunks for submission {sid} for query 'veterinary expenses of pet owners'." and not found["modelInvoked"]
    assert world.query("B", "pet insurance veterinary", 1)["retrievalResults"][0]["text"].startswith("Report Id: sample-002")


def test_a_failing_model_leaves_the_placeholder(world):
    def model(prompt: str) -> str:
        raise RuntimeError("down")

    found = world.query("A", "robots", model=model)
    assert found["modelError"] == "RuntimeError: down" and not found["modelInvoked"]
    seen = []
    found = world.query("A", "robots", model=lambda p: seen.append(p) or "said ")
    assert (found["summary"], found["modelInvoked"]) == ("said", True)
    assert world.query("A", "robots", model=lambda p: [{"type": "text", "text": "a"}, {"type": "image", "text": "x"}, {"type": "text", "text": "b"}])["summary"] == "a\nb"
    sections, first = seen[0].split("\n\n\n\n")[0], found["retrievalResults"][0]
    assert sections.split("\n\n")[1:3] == ["Submission ID: A", "User query: robots"]
    assert f"Result 1\ndocumentId: {first['documentId']}\ns3Uri: {first['s3Uri']}\nscore: {first['score']}\n{first['text']}" in seen[0]


def test_processed_texts_are_kept(spark, world):
    rows = spark.read.parquet(f"{world.root}/processed").where("submissionId = 'A'").collect()
    assert sorted(r["fileId"] for r in rows) == ["f0.json", "f1.json"] and all(r["markdown"].startswith("Report Id: sample-00") for r in rows)


def test_unknown_submissions_raise_and_missing_files_are_named(world):
    with pytest.raises(ValueError, match="unknown"):
        world.query("Z", "x")
    verdict = world.complete("A", ["f0.json", "f9.json", "f9.json"])
    assert (verdict["reason"], verdict["missingFileIds"]) == ("MISSING_FILES", ["f9.json", "f9.json"])
    assert world.complete("Z", ["f0.json"])["reason"] == "SUBMISSION_NOT_FOUND"


def test_replayed_and_foreign_events_change_nothing(spark, world):
    before = world.state("submissions").select("submissionId", "receivedFileCount", "fileIds").orderBy("submissionId").collect()
    actions = world.receive(events(spark, "ingestion/A/f0.json", "processed/A/f0.md", "ingestion/x"))
    assert {r["action"]: r["n"] for r in actions.collect()} == {"recorded": 1, "ignored": 1, "malformed": 1}
    assert world.state("submissions").select("submissionId", "receivedFileCount", "fileIds").orderBy("submissionId").collect() == before


def test_broken_files_fail_and_stay_failed(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("bad.json", b"{nope"), ("ok.json", report(9, "soap"))])
    assert engine.complete("X", ["bad.json", "ok.json"])["reason"] == "FILES_UNRESOLVED"
    assert {r["status"] for r in engine.state("raw_files").collect()} == {"FAILED", "RESOLVED"}
    alert = json.loads(engine.state("manual_review").first()["body"])
    assert alert.pop("errorMessage").startswith("Expecting property name")
    assert {k: alert[k] for k in ("alertType", "submissionId", "fileId", "rawS3Key", "processedS3Key", "errorType")} == {
        "alertType": "preprocessing_failed", "submissionId": "X", "fileId": "bad.json", "rawS3Key": "ingestion/X/bad.json", "processedS3Key": "processed/X/bad.json.md", "errorType": "JSONDecodeError",
    }
    upload(spark, engine, tmp_path, "Y", [("again.json", b"{nope")])
    assert engine.complete("Y", ["again.json"])["reason"] == "FILES_UNRESOLVED"


def test_a_failing_job_fails_run_and_documents(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap"))])
    engine.complete("X", ["ok.json"])
    assert engine.coordinate(job=lambda docs: {"ingestionJobId": "j", "status": "IN_PROGRESS"}) == "STARTED"
    assert engine.coordinate(poll=lambda op: {"status": "COMPLETE", "numberOfDocumentsFailed": 1, "failureReasons": ["disk", "net"]}) == "FAILED"
    row = engine.state("documents").first()
    assert (row["kbIngestionStatus"], row["lastIngestionError"]) == ("FAILED", "disk | net")
    assert engine.coordinate() == "no_pending_documents"
    assert engine.refresh().first()["status"] == "FAILED"
    metrics, alerts = engine.monitor()
    assert sorted((r["name"], r["dimensions"].get("Status"), r["value"]) for r in metrics.collect()) == [
        ("CallbackFailureCount", None, 0.0), ("DocumentsStuckInIngesting", None, 0.0), ("IngestionRunCount", "FAILED", 1.0), ("ManualReviewItemsQueued", None, 0.0),
        ("SubmissionCount", "FAILED", 1.0), ("SubmissionsStuckNonTerminal", None, 0.0),
    ]
    assert alerts.count() == 0


def test_driving_to_the_end(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap"))])
    engine.complete("X", ["ok.json"])
    assert engine.drive("X", 60, pause=0.1) == "READY"
    said = {r["action"] for r in engine.state("audit_log").collect()}
    assert {"recorded_submission_file", "submission_validation_completed", "raw_file_claimed", "preprocessing_completed", "canonical_document_created", "submission_documents_attached", "kb_coordinator_ingestion_completed", "submission_ready", "ready_callback_delivered"} <= said

    def callback(row):
        raise RuntimeError("gone")

    upload(spark, engine, tmp_path, "Y", [("ok.json", report(9, "soap"))])
    engine.complete("Y", ["ok.json"])
    assert engine.drive("Y", 60, pause=0.1, callback=callback) == "READY"
    row = engine.state("submissions").where("submissionId = 'Y'").first()
    assert (row["callbackStatus"], row["callbackFailureReason"]) == ("FAILED", "gone")
    metrics, alerts = engine.monitor()
    assert [r["alertType"] for r in alerts.collect()] == ["callback_failed"]


def test_a_file_in_progress_is_waited_for(spark, tmp_path):
    """Another submission's claim is waited for three times; when it resolves in between, its document is attached."""
    waits = []
    engine = Engine(spark, str(tmp_path), clock=Clock(), wait=waits.append)
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap"))])
    digest = __import__("hashlib").sha256(report(9, "soap")).hexdigest()
    claim = lambda status, document: spark.createDataFrame([(f"sha256:{digest}", status, document)], "rawFileHash string, status string, documentId string")
    engine.append("raw_files", claim("PROCESSING", None), engine.next_seq())
    assert engine.complete("X", ["ok.json"])["reason"] == "FILES_UNRESOLVED" and waits == [2.0] * 3

    def resolve(seconds):
        waits.append(seconds)
        engine.append("raw_files", claim("RESOLVED", "doc-1"), engine.next_seq())

    engine.wait = resolve
    waits.clear()
    assert engine.complete("X", ["ok.json"])["isValid"] and waits == [2.0]
    assert engine.state("submissions").first()["documentIds"] == ["doc-1"]


def test_chunks_lie_below_canonical(spark, world):
    rows = spark.read.parquet(f"{world.root}/canonical")
    assert sorted(r["contentKey"] for r in rows.collect()) == sorted(r["contentKey"] for r in world.chunks().collect()) != []
    documents = [r["documentId"] for r in rows.select("documentId").distinct().limit(2).collect()]
    assert {r["documentId"] for r in world.chunks(documents).collect()} == set(documents)


def test_lost_chunk_objects_are_written_again(spark, tmp_path, monkeypatch):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    write, calls = objects.write_chunks, []

    def lossy(rows, path):
        calls.append(rows.count())
        if len(calls) == 1:
            rows = rows.where("chunkIndex > 1")
        write(rows, path)

    monkeypatch.setattr(objects, "write_chunks", lossy)
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap " * 4000))])
    assert engine.complete("X", ["ok.json"])["isValid"]
    assert calls[1] == 1 and spark.read.parquet(f"{tmp_path}/canonical").count() == calls[0] > 1


def test_snapshots_read_like_the_whole_log(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=lambda: datetime(2026, 5, 1, tzinfo=timezone.utc))  # a clock that stands still
    row = lambda i, status: spark.createDataFrame([(f"s{i}", status)], "submissionId string, status string")
    for i in range(3):
        engine.append("submissions", row(i, "RECEIVING"), engine.next_seq())
    engine.append("submissions", row(1, "COMPLETE"), engine.next_seq())
    engine.compact("submissions")
    engine.append("submissions", row(2, "READY"), engine.next_seq())
    engine.compact("submissions")
    engine.append("submissions", row(0, "FAILED"), engine.next_seq())
    for reader in (engine, Engine(spark, str(tmp_path))):
        assert {r["submissionId"]: r["status"] for r in reader.state("submissions").collect()} == {"s0": "FAILED", "s1": "COMPLETE", "s2": "READY"}
        assert {r["submissionId"]: r["status"] for r in reader.state("submissions", ["s0", "s2", "s9"]).collect()} == {"s0": "FAILED", "s2": "READY"}
        assert reader.log("submissions").count() == 4
    assert engine.tidy(files=1) == ["submissions"] and engine.log("submissions").count() == 3


def files_read(frame) -> int:
    """Files that a frame's scans have read."""
    frame.collect()
    total, plans = 0, [frame._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind == "FileSourceScanExec":
            total += plan.metrics().apply("numFiles").value()
        else:
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return total


def test_lookups_read_as_many_files_however_long_the_history(spark, tmp_path, monkeypatch):
    from tessera.sources import registry

    monkeypatch.setattr(registry, "BUCKET_ROWS", 50)
    read = []
    for n in (200, 2000):
        engine = Engine(spark, f"{tmp_path}/{n}", clock=Clock())
        rows = spark.range(n).select(F.concat(F.lit("s"), F.col("id") % (n // 2)).alias("submissionId"), F.lit("RECEIVING").alias("status"))
        engine.append("submissions", rows, engine.next_seq())
        vectors = spark.range(n).select(F.concat(F.lit("d"), "id").alias("documentId"), F.lit("k").alias("contentKey"))
        engine.append("vectors", vectors, engine.next_seq())
        for name in ("submissions", "vectors"):
            engine.compact(name)
        one = engine.state("submissions", ["s7"])
        assert one.count() == 1 and engine.state("submissions").count() == n // 2
        many = engine.state("submissions", spark.createDataFrame([("s7",), ("s8",)], "submissionId string"))
        assert many.count() == 2
        scope = engine.log("vectors", ["d1", "d2"])
        assert scope.count() == 2
        read.append((files_read(one), files_read(scope), files_read(engine.state("submissions"))))
    (few, scoped, every), (few_later, scoped_later, every_later) = read
    assert few_later <= few <= 2 and scoped_later <= max(scoped, 2) and every_later > 4 * every


def test_missing_events_are_replayed_before_the_deadline(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock(), wait=lambda s: None)
    engine.receive(events(spark, "ingestion/X/a.json"))
    asked = []
    assert engine.await_files("X", ["a.json", "b.json"], 1, pause=60, replay=lambda keys: asked.append(keys) or events(spark, *keys))
    assert asked == [["ingestion/X/b.json"]]
    assert not engine.await_files("X", ["c.json"], 0)


def test_steps_run_by_the_clock(spark, tmp_path):
    engine, done = Engine(spark, str(tmp_path), clock=Clock()), []
    query = engine.scheduled(lambda: done.append(engine.coordinate()), f"{tmp_path}/state", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert done and set(done) == {"no_pending_documents"}


def test_forced_callback_failures(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap"))])
    engine.complete("X", ["ok.json"])
    engine.coordinate()
    engine.refresh(fail=True)
    row = engine.state("submissions").first()
    assert (row["status"], row["callbackStatus"], row["callbackFailureReason"]) == ("READY", "FAILED", "forced failure")
    assert engine.state("manual_review").count() == 0  # the monitor tells
    engine.monitor()
    alert = json.loads(engine.state("manual_review").first()["body"])
    assert (alert["alertType"], alert["callbackStatus"], alert["callbackFailureReason"], alert["environment"], len(alert["documentIds"])) == ("callback_failed", "FAILED", "forced failure", "dev", 1)


def test_listing_and_repair(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("a/b.json", b"1"), ("c.json", b"2")])
    assert {r["key"] for r in objects.listing(spark, str(tmp_path), "ingestion").collect()} == {"ingestion/X/a/b.json", "ingestion/X/c.json"}
    assert {r["fileId"] for r in objects.raw_files(spark, str(tmp_path)).collect()} == {"a/b.json", "c.json"}
    keys = spark.createDataFrame([("k1",), ("k2",)], "key string")
    have = [keys.where("key = 'k1'")]
    objects.verified(keys, lambda: have[-1], lambda gone: have.append(keys), "key")
    with pytest.raises(RuntimeError, match="k2"):
        objects.verified(keys, lambda: keys.where("key = 'k1'"), lambda gone: None, "key")


def test_generated_reports_are_deterministic(spark):
    rows = reports.reports(spark, 3).collect()
    assert rows == reports.reports(spark, 3).collect() and json.loads(rows[1]["content"])["report_id"] == "sample-001"


def test_classified_keys(spark):
    rows = receipts.classified(spark.createDataFrame([("ingestion/s/a/b.json",), ("ingestion//x",), ("other/s/x",), ("ingestion/s/",)], "key string"))
    assert [tuple(r) for r in rows.select("action", "submissionId", "fileId").collect()] == [("recorded", "s", "a/b.json"), ("malformed", None, None), ("ignored", None, None), ("malformed", None, None)]


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), "submissionId string, expectedFileIds array<string>, turn long")


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_many_submissions_at_once(spark, tmp_path):
    """Shared, equal and broken contents in one batch: what one after the other would give."""
    soap, tea = report(1, "soap"), report(2, "tea")
    newer = soap.replace(b'"v1"', b'"v2"')
    held = {
        "A": [("x", soap), ("y", tea)], "B": [("x", soap), ("z", b"{nope")], "C": [("x", json.dumps(json.loads(soap)).encode())], "D": [("x", newer)], "E": [("x", tea)], "F": [],
        "G": [("x", b"{nope"), ("w", report(3, "ink"))],
    }
    engine = Engine(spark, str(tmp_path), clock=Clock())
    for sid, files in held.items():
        upload(spark, engine, tmp_path, sid, files) if files else None
    asked = requests(spark, *((sid, [n for n, _ in files] + ["missing"] * (sid == "E") or ["x"], turn) for turn, (sid, files) in enumerate(held.items())))
    said = {r["submissionId"]: r["reason"] for r in engine.complete_many(asked).collect()}
    assert said == {"A": "OK", "B": "FILES_UNRESOLVED", "C": "OK", "D": "OK", "E": "MISSING_FILES", "F": "SUBMISSION_NOT_FOUND", "G": "FILES_UNRESOLVED"}
    states = {r["submissionId"]: (r["status"], len(r["documentIds"] or [])) for r in engine.state("submissions").collect()}
    assert states == {"A": ("COMPLETE", 2), "B": ("RECEIVING", 0), "C": ("COMPLETE", 1), "D": ("COMPLETE", 1), "E": ("RECEIVING", 0), "G": ("RECEIVING", 0)}
    documents = engine.state("documents").collect()
    assert sorted((r["businessDocumentKey"], r["sourceVersion"], r["isActive"]) for r in documents) == [("sample-001", "v1", False), ("sample-001", "v2", True), ("sample-002", "v1", True), ("sample-003", "v1", True)]
    ids = documents_of(engine)
    assert ids["C"][0] in ids["A"] and ids["D"][0] not in ids["A"]
    assert sorted(r["status"] for r in engine.state("raw_files").collect()) == ["FAILED"] + ["RESOLVED"] * 5
    assert engine.state("manual_review").count() == 1


def test_jobs_do_not_grow_with_the_batch(spark, tmp_path):
    took = []
    for n in (2, 12):
        engine = Engine(spark, str(tmp_path / str(n)), clock=Clock())
        held = {f"S{i}": [("x", report(i % 5, "soap")), ("y", report(100 + i, "tea"))] for i in range(n)}
        for sid, files in held.items():
            for name, content in files:
                objects.put(spark, f"{tmp_path}/{n}/ingestion/{sid}/{name}", content)
        engine.receive(events(spark, *(f"ingestion/{sid}/{name}" for sid, files in held.items() for name, _ in files)))
        before = jobs(spark)
        verdicts = engine.complete_many(requests(spark, *((sid, ["x", "y"], 0) for sid in held)))
        took.append(jobs(spark) - before)
        assert {r["reason"] for r in verdicts.collect()} == {"OK"}
    assert took[1] <= 1.25 * took[0]  # broadcasts and re-plans differ, not the steps


def test_seen_again_and_waiting_submissions(spark, tmp_path):
    """A content that comes again is seen later; one in progress leaves its submission to the next batch."""
    waits = []
    engine = Engine(spark, str(tmp_path), clock=Clock(), wait=waits.append)
    upload(spark, engine, tmp_path, "X", [("a", report(1, "soap"))])
    engine.complete("X", ["a"])
    first = engine.state("raw_files").first()
    upload(spark, engine, tmp_path, "Y", [("b", report(1, "soap"))])
    upload(spark, engine, tmp_path, "Z", [("c", report(2, "tea"))])
    digest = __import__("hashlib").sha256(report(2, "tea")).hexdigest()
    engine.append("raw_files", spark.createDataFrame([(f"sha256:{digest}", "PROCESSING")], "rawFileHash string, status string"), engine.next_seq())
    asked = requests(spark, ("Y", ["b"], 0), ("Z", ["c"], 1))
    assert {r["submissionId"]: r["reason"] for r in engine.complete_many(asked).collect()} == {"Y": "OK", "Z": "FILES_IN_PROGRESS"} and not waits
    again = engine.state("raw_files").where(F.col("rawFileHash") == first["rawFileHash"]).first()
    assert (again["status"], again["documentId"], again["firstSeenAt"]) == (first["status"], first["documentId"], first["firstSeenAt"]) and again["lastSeenAt"] > first["lastSeenAt"]
    assert {r["submissionId"]: r["reason"] for r in engine.complete_all(asked).collect()} == {"Y": "OK", "Z": "FILES_UNRESOLVED"} and waits == [2.0] * 3


def test_documents_are_ingesting_before_the_job_starts(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap"))])
    engine.complete("X", ["ok.json"])
    assert engine.coordinate(configured=False) == "missing_configuration"
    assert engine.state("runs").count() == 0 and engine.state("documents").first()["kbIngestionStatus"] == "PENDING_INGESTION"
    seen = []

    def job(documents):
        seen.append(engine.state("documents").first().asDict())
        raise RuntimeError("no such index")

    with pytest.raises(RuntimeError, match="no such index"):
        engine.coordinate(job=job)
    run = engine.state("runs").first()
    assert (seen[0]["kbIngestionStatus"], seen[0]["pendingIngestionRunId"]) == ("INGESTING", run["ingestionRunId"])
    row = engine.state("documents").first()
    assert (run["status"], row["kbIngestionStatus"], row["lastIngestionError"], row["pendingIngestionRunId"]) == ("FAILED", "FAILED", "no such index", None)
    assert {"kb_coordinator_missing_configuration", "kb_coordinator_documents_selected", "kb_coordinator_ingestion_submit_failed"} <= {r["action"] for r in engine.state("audit_log").collect()}


def test_review_queue_of_the_engine(spark, tmp_path):
    """Alerts repeat with each pass; equal ones of five minutes are one message, and five receives make it a dead letter."""
    engine = Engine(spark, str(tmp_path), clock=Clock())
    old = spark.createDataFrame([("S", "RECEIVING", datetime(2026, 4, 1, tzinfo=timezone.utc))], "submissionId string, status string, updatedAt timestamp")
    engine.append("submissions", old, engine.next_seq())
    engine.monitor()
    engine.monitor()
    assert engine.state("manual_review").count() == 2 and engine.review_queue().count() == 1
    for _ in range(5):
        assert [r["submissionId"] for r in engine.receive_reviews().collect()] == ["S"]
        assert engine.receive_reviews().count() == 0  # in flight
        engine.clock.at += timedelta(minutes=2)
    assert engine.receive_reviews().count() == 0 and [r["state"] for r in engine.review_queue().collect()] == ["DEAD"]
    engine.monitor()  # later than five minutes: a new message
    got = engine.receive_reviews()
    assert got.count() == 1
    engine.delete_reviews(got)
    engine.clock.at += timedelta(minutes=2)
    assert sorted(r["state"] for r in engine.review_queue().collect()) == ["DEAD", "DELETED"]


def test_accepted_messages_silence_from_themselves_on(spark):
    """Against a plain loop, hot contents in stretches of a few times; equal times, null groups and contents."""
    import random

    from tessera.operators import review

    start, rnd = datetime(2026, 5, 1), random.Random(7)
    at = lambda s: start + timedelta(seconds=s)
    two = spark.createDataFrame([(1, "g", "c", at(299)), (2, "g", "c", at(301)), (3, "g", "c", at(599)), (4, "g", "c", None)], "messageId long, alertType string, c string, sentAt timestamp_ntz")
    assert sorted(r["messageId"] for r in review.accepted(two, F.col("c")).collect()) == [1, 3]
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice(["x", "x", "x", "y", None]), at(rnd.randint(0, 9000))) for i in range(700)]
    last, want = {}, []
    for i, g, c, t in sorted(rows, key=lambda r: (r[3], r[0])):
        if (g, c) not in last or t - last[g, c] >= timedelta(minutes=5):
            last[g, c] = t
            want.append(i)
    frame = spark.createDataFrame(rows, "messageId long, alertType string, c string, sentAt timestamp_ntz")
    for stretch in (5, 40, None):
        got = review.accepted(frame, F.col("c"), stretch=stretch)
        assert sorted(r["messageId"] for r in got.collect()) == sorted(want)
    assert review.accepted(frame.limit(0), F.col("c")).collect() == []


def test_alarms_of_the_engine(spark, tmp_path):
    """A failed completion, a failing job, a stuck submission: alarms go on and off; the stream restarts from its checkpoint."""
    engine, told = Engine(spark, str(tmp_path), clock=Clock()), []
    watch = lambda: engine.watch_alarms(f"{tmp_path}/watch")
    assert engine.complete("nobody", ["x"])["reason"] == "SUBMISSION_NOT_FOUND"
    upload(spark, engine, tmp_path, "X", [("ok.json", report(9, "soap"))])
    engine.complete("X", ["ok.json"])

    def job(documents):
        raise RuntimeError("gone")

    with pytest.raises(RuntimeError):
        engine.coordinate(job=job)
    watch()
    assert engine.alarm_log().count() == 0  # the period isn't over
    for minutes in (6, 6, 15, 6, 30):
        engine.clock.at += timedelta(minutes=minutes)
        engine.monitor()
        watch()  # a query of its own each time
        told.append(engine.alarm_log().count())
    newest = engine.log("metrics").agg(F.max("ts")).first()[0]
    rows = lambda frame: sorted(tuple(r) for r in frame.select("alarm", "at", "fromState", "toState").collect())
    assert rows(engine.alarm_log()) == rows(engine.alarms_until(newest)) and told == sorted(told)
    kinds = {(r["alarm"], r["toState"]) for r in engine.alarm_log().collect()}
    assert {(a, t) for a in ("submission-orchestration-failed", "kb-coordinator-errors") for t in ("ALARM", "OK")} <= kinds
    assert ("submissions-stuck-non-terminal", "ALARM") in kinds and ("documents-stuck-ingesting", "ALARM") not in kinds


def test_one_of_many_creates_an_object(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: objects.create_once(spark, f"{tmp_path}/c/0.commit", f"writer {i}"), range(16)))
    assert won.count(True) == 1 and objects.texts(spark, f"{tmp_path}/c", ".commit", {}) == {"0.commit": f"writer {won.index(True)}"}
    assert [p.name for p in (tmp_path / "c").glob("*") if not p.name.startswith(".")] == ["0.commit"]
    assert objects.texts(spark, f"{tmp_path}/c", ".commit", {"0.commit": "known"}) == {"0.commit": "known"} and objects.texts(spark, f"{tmp_path}/none", "", {}) == {}
    objects.put(spark, f"{tmp_path}/d/a", b"1")
    objects.rename_new(spark, f"{tmp_path}/d/a", f"{tmp_path}/d/b")
    objects.put(spark, f"{tmp_path}/d/a", b"2")
    with pytest.raises(FileExistsError):
        objects.rename_new(spark, f"{tmp_path}/d/a", f"{tmp_path}/d/b")
    assert (tmp_path / "d/b").read_bytes() == b"1"


@pytest.mark.parametrize("first", "XY")
def test_two_engines_claim_equal_bytes(spark, tmp_path, monkeypatch, first):
    """Both have computed their claims before either commits: one owns the content, the other waits and reuses its document.

    The engine of Y has a clock that is behind the one that recorded its files; either may be first.
    """
    import threading
    import time
    from concurrent.futures import ThreadPoolExecutor

    first_done, both = threading.Event(), threading.Barrier(2)
    tries, create = threading.local(), objects.create_once

    def together(*args):
        if not getattr(tries, "made", False):
            tries.made = True
            both.wait(120)
            time.sleep(0 if tries.sid == first else 5)
        return create(*args)

    monkeypatch.setattr(objects, "create_once", together)
    engines = [Engine(spark, str(tmp_path), clock=Clock(), wait=lambda _: first_done.wait(120)) for _ in range(2)]
    for sid in "XY":
        upload(spark, engines[0], tmp_path, sid, [("a", report(1, "soap"))])

    def run(engine, sid):
        tries.sid = sid
        verdict = engine.complete(sid, ["a"])
        first_done.set()
        return verdict

    with ThreadPoolExecutor(2) as pool:
        verdicts = list(pool.map(run, engines, "XY"))
    assert [v["reason"] for v in verdicts] == ["OK", "OK"]
    engine = Engine(spark, str(tmp_path))
    actions = [r["action"] for r in engine.state("audit_log").collect()]
    assert (actions.count("raw_file_claimed"), actions.count("raw_file_claims_conflict"), actions.count("canonical_document_created")) == (1, 1, 1) and "raw_file_reused" in actions
    assert [r["status"] for r in engine.state("raw_files").collect()] == ["RESOLVED"] and len(engine.claim_paths()) == 1
    ids = documents_of(engine)
    assert ids["X"] == ids["Y"] and len(ids["X"]) == 1
    engine.compact("raw_files")
    assert engine.claim_paths() == [] and [r["status"] for r in engine.state("raw_files").collect()] == ["RESOLVED"]


def test_claims_without_a_commit_do_not_count(spark, tmp_path, monkeypatch):
    """A step that dies before its commit leaves nothing behind that others see; one that sees no commit left gives up."""
    engine = Engine(spark, str(tmp_path), clock=Clock())
    upload(spark, engine, tmp_path, "X", [("a", report(1, "soap"))])
    with monkeypatch.context() as m:
        m.setattr(objects, "create_once", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            engine.complete("X", ["a"])
        m.setattr(objects, "create_once", lambda *_: False)
        m.setattr(engine_module, "CLAIM_TRIES", 2)
        with pytest.raises(RuntimeError, match="2 times"):
            engine.complete("X", ["a"])
    assert engine.state("raw_files").count() == 0
    assert engine.complete("X", ["a"])["reason"] == "OK"


def test_objects_expire_by_prefix(spark, tmp_path):
    """Old raw and processed objects go, also with odd names; younger ones and the chunks stay; a lost file leaves its submission open."""
    import os

    start = datetime.now(timezone.utc).replace(microsecond=0)
    clock = Clock()
    clock.at = start
    engine = Engine(spark, str(tmp_path), clock=clock)
    assert engine.expire() == 0
    upload(spark, engine, tmp_path, "X", [("a", report(1, "soap")), ("odd é.json", report(2, "tea"))])
    upload(spark, engine, tmp_path, "Y", [("b", report(3, "ink"))])
    assert engine.complete("X", ["a", "odd é.json"])["reason"] == "OK"
    objects.put(spark, f"{tmp_path}/ingestion/Z/a%20b+c#.json", b"no receipt")
    chunks = engine.chunks().count()
    files = lambda prefix: sorted(p.name for p in (tmp_path / prefix).rglob("*") if p.is_file() and not p.name.startswith((".", "_")))
    assert engine.expire() == 0 and len(files("ingestion")) == 4 and files("processed")
    for name in ("ingestion/X/odd é.json", "ingestion/Y/b", "ingestion/Z/a%20b+c#.json"):
        os.utime(tmp_path / name, (start.timestamp() - 15 * 86400,) * 2)
    clock.at = start + timedelta(days=4)
    processed = len(files("processed"))
    assert engine.expire() == 3 + processed and files("ingestion") == ["a"] and files("processed") == []
    assert engine.expire() == 0 and engine.chunks().count() == chunks > 0
    gone = {r["fields"]["key"] for r in engine.state("audit_log").where("action = 'object_expired'").collect()}
    assert {"ingestion/X/odd é.json", "ingestion/Y/b", "ingestion/Z/a%20b+c#.json"} <= gone and len(gone) == 3 + processed
    assert engine.complete("Y", ["b"])["reason"] == "FILES_UNRESOLVED"
    assert {r["submissionId"]: r["status"] for r in engine.state("submissions").collect()} == {"X": "COMPLETE", "Y": "RECEIVING"}
