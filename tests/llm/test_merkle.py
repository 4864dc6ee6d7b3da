"""The manifest against a plain tree."""

from __future__ import annotations

import hashlib

import pytest
from corpus import frame, texts
from pyspark.sql import functions as F

from tessera.llm import merkle


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(leaves: list[str], fanout: int) -> tuple[str, list[str]]:
    """The root, and each leaf's siblings level by level."""
    at, own, level = list(range(len(leaves))), [""] * len(leaves), leaves
    while len(level) > 1:
        for i, a in enumerate(at):
            run = a - a % fanout
            own[i] += "".join(level[run:a] + level[a + 1 : run + fanout])
        at = [a // fanout for a in at]
        level = [digest("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], own


def expected(rows: list[tuple], fanout: int) -> list[tuple]:
    """rows: (id, group, text). (id, leaf, subroot, root, siblings)."""
    none_first = lambda x: (x is not None, x)
    groups = sorted({r[1] for r in rows}, key=lambda g: none_first(g if g is None else g.encode()))
    trees = {}
    for g in groups:
        mine = sorted(((i, leaf(i, t)) for i, h, t in rows if h == g), key=lambda x: (none_first(x[0]), x[1]))
        trees[g] = mine, *plain([x[1] for x in mine], fanout)
    root, upper = plain([trees[g][1] for g in groups], fanout)
    return sorted((((i, h, trees[g][1], root, s + upper[k])) for k, g in enumerate(groups) for (i, h), s in zip(trees[g][0], trees[g][2], strict=True)), key=repr)


def found(frame) -> list[tuple]:
    leaves = frame.withColumn("leaf", merkle.leaf_of(F.col("doc_id"), F.col("text"))).drop("text")
    return leaves


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (2, 2), (3, 2), (8, 4)])
def test_roots_and_proofs(spark, fanout, levels):
    """One group with most rows, one of a single row, a null and an empty one; equal and null ids; rounds of every number."""
    rows = [(i, "en" if n % 3 else [None, "", "de", "zz", "é"][n % 5], t) for n, (i, t) in enumerate(texts())] + [(9, "one", "x"), (5, "en", "a"), (5, "en", "a"), (5, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    made = merkle.manifest(found(docs), fanout=fanout, levels=levels).withColumn("again", merkle.folded(F.col("leaf"), F.col("siblings"), F.col("places")))
    got = made.collect()
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["siblings"]) for r in got), key=repr) == expected(rows, fanout)
    assert all(r["again"] == r["root"] for r in got)
    changed = merkle.folded(F.reverse("leaf"), F.col("siblings"), F.col("places"))
    assert made.where(changed == F.col("root")).count() == 0


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "en", "x")], "doc_id long, lang string, text string")
    row = merkle.manifest(found(docs)).withColumn("again", merkle.folded(F.col("leaf"), F.col("siblings"), F.col("places"))).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["again"] == leaf(1, "x") and row["siblings"] == "" and row["places"] == []
    assert merkle.manifest(found(docs.limit(0))).collect() == []
    assert merkle.root_of([leaf(i) for i in range(70)]) == plain([leaf(i) for i in range(70)], 8)[0]


def test_other_columns_and_clashing_names(spark):
    docs = frame(spark, texts()).withColumn("leaf", merkle.leaf_of(F.col("doc_id"), F.col("text")))
    got = merkle.manifest(docs)
    assert got.columns == [*(c for c in docs.columns if c != "leaf"), "index", "leaf", "subroot", "root", "siblings", "places"]
    assert sorted(map(repr, got.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    with pytest.raises(ValueError, match="root"):
        merkle.manifest(docs.withColumn("root", F.lit(1)))


def test_only_ascii_capitals_are_lowered(spark):
    rows = ["ABC xyz", "ÄÖ ABC İ", "ΣΑΣ A", "", None]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select(merkle.ascii_lower(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in got] == ["abc xyz", "ÄÖ abc İ", "ΣΑΣ a", "", None]
