"""Latent semantic vectors against the whole decomposition, on texts that were held out, and in the engine."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import retrieval, semantic


@pytest.fixture
def small(monkeypatch):
    """Fewer terms, so that the whole matrix can be decomposed."""
    monkeypatch.setattr(semantic, "TERMS", 512)
    semantic.term.cache_clear()
    yield
    semantic.term.cache_clear()


def topical(rnd, topic: int, n: int = 30) -> str:
    return " ".join(f"t{topic}w{rnd.integers(40)}" if rnd.random() < 0.6 else f"common{rnd.integers(60)}" for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


def test_subspace_is_that_of_the_whole_matrix(spark, tmp_path, monkeypatch):
    """Tasks run in processes of their own, so the sizes stay as they are here."""
    rnd = np.random.default_rng(1)
    texts = [topical(rnd, i % 6) for i in range(150)] + [None, "", "  --  "]
    frame(spark, texts).repartition(5).write.parquet(str(tmp_path / "texts"))
    model = semantic.learned(spark.read.parquet(str(tmp_path / "texts")), "text", dims=6)
    row, column, count = semantic.counts(texts)
    having = np.bincount(column, minlength=semantic.TERMS)
    assert np.allclose(model.idf, np.where(having > 0, np.log((1 + len(texts)) / (1 + having)), 0))
    terms, whole = semantic.weighted(texts, model.idf)
    right = np.linalg.svd(whole, full_matrices=False)[2][:6]
    # cosines of the angles between both subspaces
    assert np.linalg.svd(right @ model.basis[terms])[1].min() > 0.99
    again = semantic.Model.read(model.table(spark).repartition(3))
    assert np.array_equal(again.basis, model.basis) and np.array_equal(again.idf, model.idf)


def test_held_out_texts_of_a_topic_are_nearer_than_others(spark, tmp_path):
    """Pairs of new texts: those of one topic rank above those of different ones nearly always, also without a shared topical word."""
    rnd = np.random.default_rng(2)
    frame(spark, [topical(rnd, i % 8) for i in range(400)]).write.parquet(str(tmp_path / "texts"))
    model = semantic.learned(spark.read.parquet(str(tmp_path / "texts")), "text", dims=16)
    topics = [i % 8 for i in range(80)]
    new = [topical(rnd, t, 12) for t in topics]

    def area(vectors):
        score = vectors @ vectors.T
        a, b = np.triu_indices(len(new), 1)
        same = np.array(topics)[a] == np.array(topics)[b]
        apart = np.array([not {w for w in new[i].split() if w[0] == "t"} & {w for w in new[j].split() if w[0] == "t"} for i, j in zip(a, b, strict=True)])
        auc = lambda yes, no: float((yes[:, None] > no[None, :]).mean())
        return auc(score[a, b][same], score[a, b][~same]), auc(score[a, b][same & apart], score[a, b][~same])

    whole, apart = area(model.many(new))
    hashed = area(np.array([retrieval.embed(t) for t in new]))
    assert whole > 0.97 and apart > 0.95
    assert whole > hashed[0] and apart > hashed[1] + 0.2


def test_edges(spark):
    nothing = semantic.learned(frame(spark, []), "text", dims=4)
    assert nothing("any words") == [0.0] * 4
    same = semantic.learned(frame(spark, ["one two", "one three", "one two", None]), "text", dims=4)
    assert same(None) == same("") == same("--- _ !") == same("absent") == [0.0] * 4
    assert np.isclose(np.linalg.norm(same("two")), 1) and np.dot(same("Two!"), same("two")) > 0.999
    found = retrieval.embedded(frame(spark, ["one two", None, "one three"]), same, "text").orderBy("id").collect()
    assert [np.allclose(r["embedding"], same(r["text"]), atol=1e-6) for r in found] == [True] * 3
    assert len(same.many(["one two"] * (semantic.BLOCK + 3))) == semantic.BLOCK + 3


def test_counts_and_weights(small):
    row, column, count = semantic.counts(["b a a", None, "A_b-a"])
    got = {(int(r), int(c)): int(n) for r, c, n in zip(row, column, count, strict=True)}
    assert got == {(0, semantic.term("a")): 2, (0, semantic.term("b")): 1, (2, semantic.term("a")): 2, (2, semantic.term("b")): 1}
    terms, weights = semantic.weighted(["b a a", "zz"], np.where(np.arange(512) == semantic.term("zz"), 0.0, 2.0))
    assert np.allclose(np.linalg.norm(weights, axis=1), [1, 0]) and len(terms) == 3


def test_the_engine_learns_and_embeds_anew(spark, tmp_path):
    from test_engine import Clock, upload
    from test_engine import report

    from tessera.plans.engine import Engine

    engine = Engine(spark, f"file://{tmp_path}", clock=Clock(), wait=lambda _: None)
    upload(spark, engine, tmp_path, "s1", [("a.json", report(1, "robots")), ("b.json", report(2, "soil"))])
    engine.complete("s1", ["a.json", "b.json"])
    engine.coordinate()
    before = engine.vectors().count()
    assert before and engine.embedding()[0] is None
    name = engine.learn_embedding(dims=8)
    assert engine.embedding()[0] == name
    rows = engine.vectors().collect()
    assert len(rows) == before and {len(r["embedding"]) for r in rows} == {8}
    other = Engine(spark, f"file://{tmp_path}", clock=Clock(), wait=lambda _: None)
    assert other.embedding()[0] == name
    found = other.query("s1", "robots")
    assert found["retrievalResults"] and found["retrievalResults"][0]["score"] >= found["retrievalResults"][-1]["score"]
    engine.index([r["documentId"] for r in rows])
    assert engine.vectors().count() == before  # nothing is indexed twice
    engine.compact("vectors")
    assert engine.log("vectors").where(F.col("model").isNull()).count() == 0 and engine.vectors().count() == before
