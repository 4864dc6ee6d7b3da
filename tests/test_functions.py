"""The renderer, the chunker and version election on small cases worked out by hand."""

from __future__ import annotations

import hashlib
import json
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import keys, markdown, text
from tessera.operators import indexing, readiness, retrieval, versions


def test_rendering_by_the_grammar():
    value = {"report_id": "r1", "tags": ["a", {"k": 1}], "meta": {"x_y": None, "note": "l1\nl2 "}, "segment_id": "s"}
    assert markdown.render(value) == "Report Id: r1\n\nTags:\n  - a\n\n  -:\n    K: 1\n\nMeta:\nX Y: null\n\nNote: |\n  l1\n  l2"


@pytest.mark.parametrize(
    ("value", "expected"),
    [({}, ""), ([], ""), (3, "3"), ("a\r\nb ", "a\nb"), ([1, [2, 3]], "- 1\n\n-:\n  - 2\n\n  - 3"), ({"a": True, "b": 1.0, "c": 1e16}, "A: true\n\nB: 1.0\n\nC: 1e+16"), ({"o'neil r&d": 1}, "O'Neil R&D: 1"), ({"a": []}, "A:")],
)
def test_rendering_of_edges(value, expected):
    assert markdown.render(value) == expected


def test_hash_is_of_the_ascii_envelope():
    envelope = '{"markdownText":"\\u00e9\\n\\u007f","normalizationStrategy":"json_to_markdown_lines_v2"}'
    assert markdown.canonical_hash("é\n\x7f") == "sha256:" + hashlib.sha256(envelope.encode()).hexdigest()


def test_metadata_and_errors():
    row = markdown.normalize(json.dumps({"report_id": " r ", "report_date": "", "source_updated_at": "t", "a": [{"segment_id": 1}, {"segment_id": {"segment_id": 2}}]}).encode())
    assert row[2:9] == ("r", None, "t", "dict", 4, 4, 3)
    assert markdown.normalize(b'{"segment_id": 1, "a": 2}')[5:9] == ("dict", 2, 1, 1)
    assert [markdown.normalize(v)[5:8] for v in (b"[1, {}]", b"3", b"2.5", b'"x"', b"null", b"true")] == [("list", 2, 2)] + [(k, 1, 1) for k in ("int", "float", "str", "NoneType", "bool")]
    assert markdown.normalize('"a\u2028b\\u000bc"'.encode())[11] == 1  # only newlines part lines
    assert markdown.normalize(b'{"report_date": "  ", "source_updated_at": "t"}')[4] is None
    for bad in (b"", b"{", b"\xff", b"\xef\xbb\xbf{}"):
        assert markdown.normalize(bad)[-1]
    assert markdown.normalize(b'{"a": 1, "a": 2}')[0] == "A: 2"


json_values = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=5), x, max_size=3), max_leaves=12)


@settings(max_examples=60, deadline=None)
@given(json_values)
def test_hash_ignores_layout_and_pruned_keys(value):
    a = markdown.normalize(json.dumps(value).encode())
    b = markdown.normalize(json.dumps(value, indent=3, ensure_ascii=False).encode())
    assert a[1] == b[1]
    if isinstance(value, dict):
        assert markdown.normalize(json.dumps(value | {"segment_id": [1]}).encode())[1] == markdown.normalize(json.dumps({k: v for k, v in value.items() if k != "segment_id"}).encode())[1]


def reference_chunks(t: str, most: int) -> list[str]:
    """The chunker in plain steps."""
    out: list[str] = []
    now = ""
    for p in (x.strip() for x in t.strip().split("\n\n")):
        if not p:
            continue
        if len(p) > most:
            out, now = out + [now], ""
            lines = p.splitlines()
            if len(lines) > 1:
                cur = None
                for line in (x.rstrip() for x in lines):
                    if cur is None:
                        cur = line
                    elif len(cur) + 1 + len(line) <= most:
                        cur += "\n" + line
                    else:
                        out, cur = out + [cur], line
                out.append(cur or "")
                out = [x.strip() for x in out]
            else:
                out += [p[i : i + most].strip() for i in range(0, len(p), most)]
        elif now and len(now) + 2 + len(p) <= most:
            now += "\n\n" + p
        else:
            out, now = out + [now], p
    return [x for x in out + [now] if x] or [""]


def test_chunks_agree_with_plain_steps(spark):

    rnd = random.Random(5)
    texts = ["", "   ", "a", "x" * 25, "ab cd\n" * 9, "a\n\nb", "long line " * 6 + "\nshort\n\ntail"]
    texts += ["first line\n  indented two\n  indented three", "aaaaaaaaaa\n \n   b ccccccc", "one\x0b  two two two two\xa0\n three\u2028  four\x85five \x1c", "\xa0 x" * 30, "aaa\n" * 30 + "\n\n  tail\n"]
    texts += ["".join(rnd.choice(["aa", "  b", "\xa0", "\x0b", "\n", "\n  ", "\n\n", "cccccc", "\u2028", "\t"]) for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    texts += ["".join(rnd.choice(["aa", "b ", "\n", "\n\n", "cccccc", "d"]) for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.chunks(F.col("t"), 12).alias("c")).collect()
    for r in rows:
        assert r["c"] == reference_chunks(texts[r["i"]], 12), texts[r["i"]]


def test_normalized_text_agrees_with_the_renderer(spark):
    """Line ends of every kind: the expression and the function that renders give the same text."""
    texts = ["a \x0b\nb\xa0\r\n c\t", "\u2003x\u2003\ny\x85\n", "a\u2028 b \x1c\n", " " * 50 + "a" + " " * 50 + "b", "", " \n "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.normalized(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in sorted(rows)] == [markdown.block(t) for t in texts]


@pytest.mark.parametrize(
    ("turns", "winner"),
    [
        ([("a", "v1", None), ("b", "v2", None)], "b"), ([("a", "v2", None), ("b", "v1", None)], "a"), ([("a", "v2", None), ("b", None, None), ("c", "v1", None)], "c"),
        ([("a", None, "2026"), ("b", "v0", None)], "b"), ([("a", "v0", None), ("b", None, "2026")], "a"), ([("a", "9", None), ("b", "10", None)], "a"), ([("a", "v1", None), ("b", "v1", None)], "b"),
    ],
)
def test_election(spark, turns, winner):
    rows = spark.createDataFrame([("k", d, v, u, i) for i, (d, v, u) in enumerate(turns)], "businessDocumentKey string, documentId string, sourceVersion string, sourceUpdatedAt string, seq long")
    assert versions.elected(rows, "seq").first()["activeDocumentId"] == winner


def active_in_turn(turns):
    now = None
    for document, rank in turns:
        if now is None or now[0] == document or now[1] is None or rank is None or rank >= now[1]:
            now = document, rank
    return now[0]


def test_elections_in_stretches(spark):
    """Lists and stretches of every size against a plain loop: repeated documents with lesser orders, ties, dates, null orders."""
    rnd = random.Random(11)
    rows, want = [], {}
    for k in range(60):
        nulls, documents, ranks = rnd.choice([0, 0, 0.05, 0.3]), rnd.choice([2, 4, 40]), rnd.choice([3, 30])
        turns = []
        for i in range(rnd.choice([1, 2, 7, 30, 90])):
            at = None if rnd.random() < nulls else rnd.randrange(ranks) - (i if k % 3 == 0 else 0)  # a third of the keys falls
            version, date = (None, None) if at is None else (f"v{at + 500}", "x") if rnd.random() < 0.9 else (None, f"{at + 500}")
            turns.append((f"d{rnd.randrange(documents)}", version, date))
        rows += [(f"k{k}", d, v, u, i * i) for i, (d, v, u) in enumerate(turns)]
        want[f"k{k}"] = active_in_turn([(d, ("version", v) if v else ("updated_at", u) if u else None) for d, v, u in turns]), len(turns)
    rnd.shuffle(rows)
    frame = spark.createDataFrame([*rows, (None, "d", "v1", None, 1)], "businessDocumentKey string, documentId string, sourceVersion string, sourceUpdatedAt string, seq long")
    for fold_rows, stretch_rows in ((1000, 1000), (20, 50), (0, 100), (0, 400)):
        found = versions.elected(frame, "seq", fold_rows, stretch_rows)
        assert {r["businessDocumentKey"]: (r["activeDocumentId"], r["candidates"]) for r in found.collect()} == want
    assert versions.elected(frame.limit(0), "seq").collect() == []


def test_outcomes_of_stretches_of_all_lengths():
    """Every way to cut a key's turns, without a session."""
    rnd = random.Random(5)
    for _ in range(400):
        turns = [(rnd.choice("abcd"), None if rnd.random() < 0.08 else ("version", rnd.choice("123456"))) for _ in range(rnd.randint(1, 14))]
        cuts = sorted({0, len(turns), *(rnd.randint(0, len(turns)) for _ in range(rnd.randint(0, 5)))})
        told = pd.concat([versions.outcomes("k", i, turns[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])
        row = versions.through_stretches(told).iloc[0]
        assert (row["activeDocumentId"], row["candidates"]) == (active_in_turn(turns), len(turns)), (turns, cuts)


def test_a_hot_key_is_spread_over_tasks(spark):
    rows = spark.range(4000).select(F.lit("k").alias("businessDocumentKey"), F.concat(F.lit("d"), F.col("id") % 7).alias("documentId"), F.struct(F.lit("version").alias("kind"), F.lpad((9000 - F.col("id")).cast("string"), 5, "0").alias("value")).alias("rank"), F.struct("id").alias("seq"))
    order = ["businessDocumentKey", "seq"]
    sizes = [r["n"] for r in rows.repartitionByRange(8, *order).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 500
    assert tuple(versions.in_stretches(rows, 8).first()) == ("k", "d0", 4000)  # orders fall, so the first document stays, by itself


def test_job_status_table(spark):
    rows = [("STARTING", 0, []), ("COMPLETE", 0, []), ("COMPLETE", 1, []), ("COMPLETE", None, ["x"]), ("FAILED", 0, []), ("odd", 0, None), (None, 0, [])]
    found = spark.createDataFrame(rows, "s string, n long, r array<string>").select(indexing.run_status(F.col("s"), indexing.has_failures(F.col("n"), F.col("r"))).alias("x"))
    assert [r["x"] for r in found.collect()] == ["STARTED", "SUCCEEDED", "FAILED", "FAILED", "FAILED", "FAILED", "FAILED"]


def test_readiness_table(spark):
    subs = spark.createDataFrame([("e", []), ("m", ["d1", "zz"]), ("r", ["d1", "d1"]), ("f", ["d1", "d2"]), ("n", None)], "submissionId string, documentIds array<string>")
    docs = spark.createDataFrame([("d1", "INDEXED"), ("d2", "FAILED")], "documentId string, kbIngestionStatus string")
    found = {r["submissionId"]: (r["status"], r["pending"]) for r in readiness.readiness(readiness.states(subs, docs)).collect()}
    assert found == {"e": ("WAITING_FOR_INDEX", 0), "m": ("WAITING_FOR_INDEX", 1), "r": ("READY", 0), "f": ("FAILED", 0), "n": ("WAITING_FOR_INDEX", 0)}


def test_keys_and_clamps(spark):
    row = spark.range(1).select(
        keys.chunk_key(F.lit("d"), F.lit(12345)), keys.document_id(F.lit("sha256:0123456789abcdef99")), keys.optional(F.lit("\t x ")), keys.optional(F.lit(" \n")),
    ).first()
    assert tuple(row) == ("canonical/d/chunk-12345.md", "doc-0123456789abcdef", "x", None)
    assert [retrieval.clamped(n) for n in (None, -1, 0, 1, 5, 99)] == [5, 1, 1, 1, 5, 10]


def test_documents_by_hash(spark):
    from tessera.operators import attach

    attached = spark.createDataFrame([("s", "d1"), ("s", "d2"), ("t", "d3")], "submissionId string, documentId string")
    documents = spark.createDataFrame([("d1", "h1"), ("d2", "h2"), ("d3", "h1")], "documentId string, canonicalHash string")
    assert [attach.document_of_hash(attached, documents, *x) for x in (("s", "h2"), ("t", "h1"))] == ["d2", "d3"]
    with pytest.raises(ValueError, match="no document"):
        attach.document_of_hash(attached, documents, "t", "h2")
    assert len(keys.client_token("run-" + "x" * 300)) == 256


def test_review_queue_in_order(spark):
    """A message in flight blocks its group; one received five times, deleted or old makes way."""
    from datetime import datetime, timedelta

    from tessera.operators import review

    now = datetime(2026, 5, 20)
    sent = [(1, "a", 300), (2, "a", 200), (3, "b", 100), (4, "b", 90), (5, "c", 80), (6, "c", 70), (7, "d", 60 * 24 * 14), (8, "d", 50), (9, "e", 10)]
    messages = spark.createDataFrame([(i, g, now - timedelta(minutes=m)) for i, g, m in sent], "messageId long, alertType string, sentAt timestamp_ntz")
    receives = [(1, 3600, True), (3, 30, False)] + [(5, 600 + k, False) for k in range(5)] + [(9, 61, False)]
    received = spark.createDataFrame([(i, now - timedelta(seconds=s), d) for i, s, d in receives], "messageId long, receivedAt timestamp_ntz, deleted boolean")
    queue = review.with_receives(messages, received, F.lit(now).cast("timestamp_ntz"))
    assert {r["messageId"]: r["state"] for r in queue.collect()} == {1: "DELETED", 2: "WAITING", 3: "IN_FLIGHT", 4: "WAITING", 5: "DEAD", 6: "WAITING", 7: "EXPIRED", 8: "WAITING", 9: "WAITING"}
    assert {r["alertType"]: (r["messageId"], r["receiveCount"]) for r in review.receivable(queue).collect()} == {"a": (2, 0), "c": (6, 0), "d": (8, 0), "e": (9, 1)}
    assert [r["messageId"] for r in review.dead_letters(queue).collect()] == [5]


def test_keys_of_many_lines_are_titled_once():
    from tessera.functions import markdown

    markdown.title.cache_clear()
    made = markdown.render({"lines": [{"line_number": i, "segment_id": 1} for i in range(500)]})
    assert made.startswith("Lines:\n  -:\n    Line Number: 0\n\n  -:") and made.count("Line Number") == 500
    assert markdown.title.cache_info().misses == 2
    value = {"a": {"segment_id": [{"segment_id": 1}]}, "b": [1, "x", {"segment_id": None}]}
    assert markdown.count_pruned(value) == 3 and markdown.count_pruned("segment_id") == 0
