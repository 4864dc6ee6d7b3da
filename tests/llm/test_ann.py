"""Nearest neighbours against all inner products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann


def expected(rows, k: int):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    out = []
    for q, v in good:
        if q % 20 == 0:
            scored = sorted((-(v * x).sum(), i) for i, x in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 64])
def test_neighbours_and_ties(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "VECTOR_BLOCK", block)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    rnd = np.random.default_rng(6)
    rows: list = [(i, rnd.normal(size=24).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]  # copies of one vector
    rows += [(500, None), (501, [0.0] * 24), (502, [float("nan")] * 24), (503, [None] * 24), (None, rows[0][1]), (520, [1.0] * 5), (540, [float("inf")] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(0)).withColumn("score", F.lit("x"))
    got = sorted(tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 20 == 0).collect())
    want = [w for w in expected([r for r in rows if r[0] != 520], 20)]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    hits = len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want})
    assert hits / len(want) > 0.99 and np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-6)


def test_vectors_of_doubles(spark):
    rnd = np.random.default_rng(9)
    rows = [(i, (rnd.normal(size=7) / 3).tolist()) for i in range(90)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r)[:3] for r in sorted(got)] == [w[:3] for w in expected(rows, 20)]


def test_few_and_no_vectors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ann.nearest(frame([]), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.nearest(frame([(20, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).collect() == []
    got = ann.nearest(frame([(20, [1.0, 2.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0])]), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(20, 1, 1, 2.0), (20, 2, 2, 2.0)]


def test_bounds_hold():
    rnd = np.random.default_rng(3)
    vectors, queries = rnd.normal(size=(500, 64)), rnd.normal(size=(40, 64))
    turn = ann.rotation(64)
    codes = ann.Codes.of(vectors, turn)
    low, high = ann.Codes.frombytes(codes.tobytes(), 64, 500).bounds(queries, turn)
    exact = queries @ vectors.T
    assert np.mean((low <= exact) & (exact <= high)) > 0.999
    assert np.mean(high - low) < 0.9 * (exact.max() - exact.min()) * 2
