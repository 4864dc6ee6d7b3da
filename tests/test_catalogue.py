"""Every query of the catalogue against its SQL."""

import os

import pytest
from oracle import differences

from tessera.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert differences(catalogue.queries()[name](spark, sf_dir), catalogue.oracle_sql()[name], sf_dir) == ""


#: Queries over documents and review messages whose rows with nulls are kept.
KEEP = """raw_claims raw_registry canonical_registry canonical_reuse identity_compare extracted_metadata claims_on_registry documents_on_registry documents_by_hash
chunks ragged_chunks normalized_texts chunk_counts chunk_keys paragraph_chunks_all chunk_persistence_check election_without_orders election_in_stretches prompt_context
review_states review_next review_accepted review_of_hot_types""".split()


@pytest.fixture(scope="module")
def with_nulls(spark, sf_dir, tmp_path_factory):
    """The tables with nulls in texts, sources, languages and types."""
    from pyspark.sql import functions as F

    folder = str(tmp_path_factory.mktemp("nulls"))
    gone = lambda c, i, n, r: F.when(F.col(i) % n != r, F.col(c)).alias(c)
    docs = catalogue.read(spark, sf_dir, "documents").withColumns({"text": gone("text", "doc_id", 9, 1), "source": gone("source", "doc_id", 7, 2), "lang": gone("lang", "doc_id", 5, 3)})
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    catalogue.read(spark, sf_dir, "events").withColumn("event_type", gone("event_type", "event_id", 11, 4)).coalesce(1).write.parquet(f"{folder}/events.parquet")
    for name in "region nation customer supplier part orders lineitem embeddings pages benchmark labels conversations".split():
        os.symlink(f"{sf_dir}/{name}.parquet", f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", [n for n in KEEP if n in catalogue.queries()])
def test_rows_with_nulls_are_kept(spark, with_nulls, name):
    found = catalogue.queries()[name](spark, with_nulls)
    assert differences(found, catalogue.oracle_sql()[name], with_nulls) == ""
    if "doc_id" in found.columns and name != "normalized_texts":
        every = catalogue.read(spark, with_nulls, "documents").select("doc_id")
        assert name in ("chunks", "ragged_chunks", "chunk_keys") or every.exceptAll(found.select("doc_id").distinct()).count() == 0


def test_flagship_has_stable_columns(spark, sf_dir):
    found = catalogue.flagship(spark, sf_dir)
    assert found.columns == ["documentId", "chunks", "chars"]
    assert found.count() > 0


def test_runs_and_scopes_over_whole_tables(spark, sf_dir):
    """Every document with a line is in a run; every vector divisible by 100 asks its whole scope."""
    found = catalogue.queries()["run_fanout_all"](spark, sf_dir).where("run_status is not null").collect()
    assert sum(r["documents"] for r in found) == catalogue.read(spark, sf_dir, "lineitem").select("l_orderkey").distinct().count()
    rows = {r["vec_id"]: r["label"] for r in catalogue.read(spark, sf_dir, "embeddings").collect()}
    asked = [(q, v) for q in rows for v in rows if q % 100 == 0 and q != v and rows[q] == rows[v]]
    assert sorted((r["query_id"], r["vec_id"]) for r in catalogue.queries()["scored_pairs_all"](spark, sf_dir).collect()) == sorted(asked) != []


def test_every_text_is_chunked(spark, sf_dir):
    """Texts with long paragraphs and blank ones too."""
    docs = catalogue.read(spark, sf_dir, "documents")
    assert catalogue.queries()["paragraph_chunks_all"](spark, sf_dir).select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
    assert catalogue.queries()["paragraph_chunks_all"](spark, sf_dir).count() == docs.count()


def test_running_values_in_stretches(spark):
    """Places and maxima within hot and null groups, in stretches of a few rows, against plain loops."""
    import random

    from pyspark.sql import functions as F

    from tessera.operators import ordered

    rnd = random.Random(3)
    rows = [(None if rnd.random() < 0.1 else rnd.choice("aaab"), i * i, rnd.choice([None, *range(20)])) for i in range(200)]
    frame = spark.createDataFrame(rows, "g string, seq long, v int")
    place, most, want = {}, {}, {}
    for g, seq, v in rows:
        place[g] = place.get(g, -1) + 1
        most[g] = max((x for x in (most.get(g), v) if x is not None), default=None)
        want[seq] = place[g], most[g]
    for size in (7, 1000):
        found = ordered.running_max(ordered.numbered(frame, "g", "seq", "at", size), "g", "seq", F.col("v"), "most", size)
        assert found.columns == ["g", "seq", "v", "at", "most"]
        assert {r["seq"]: (r["at"], r["most"]) for r in found.collect()} == want
    assert ordered.numbered(frame.limit(0), "g", "seq", "at").collect() == []


@pytest.mark.parametrize("name", ["documents_on_registry", "documents_by_hash"])
def test_variants_are_hashed_once(spark, sf_dir, name):
    """The query's own plan holds no pattern over texts: they were normalised once, before."""
    plan = catalogue.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "documents.parquet" not in plan
