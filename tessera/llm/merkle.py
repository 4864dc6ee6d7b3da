"""A Merkle manifest of a table: a tree of digests over each group's rows, a tree over the groups, and proofs.

A row's leaf is the SHA-256 of its columns; each `fanout` consecutive digests of a group, in the rows' order, become one,
until one is left: the group's root. The groups' roots, in the groups' order, become the table's root the same way.

1. Leaves are made by Spark's own functions where the rows are read: texts go no further.
2. Rows are sorted by ranges and written; a part's rows of a group are consecutive, so small counts a part and group
   give every row its index in its group.
3. Indices are cut into superblocks of fanout**levels. applyInPandas collapses a superblock by `levels` levels into one
   digest; these are nodes of the next round, until one a group is left. At 4096 to one a round, 10**11 rows take four.
4. From the top down each superblock's nodes get their proofs: the siblings inside it, followed by those of its own root
   further up. So only digests and one path a superblock are shuffled, and only rows carry whole proofs.

A superblock holds fanout**levels rows at most, whatever its group's size, so a group with a third of all rows is as
many tasks as it needs. The driver sees the largest group's size, the number of counts, and the root.

Edge cases: nulls are `-` in a leaf and sort first, as rows and as a group; repeated rows are leaves of their own, side by
side; rows with equal order values are ordered by their leaves, so equal tables have equal roots whatever their rows'
order. A group of one row has its leaf as root, and a table of one group that group's root. An empty table has no root and
no rows. Columns of docs beside those hashed pass through under their names; a clash with the columns made raises an error.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._common import partitions, ready, written

FANOUT = 8
#: Levels that one task collapses: superblocks of 8**4 = 4096 nodes.
LEVELS = 4
#: Counts a part and group up to this many are sent to every executor (about 6 MB); more are joined by shuffle.
SMALL = 100_000
MADE = {"index", "subroot", "root", "siblings", "places"}
CAPITALS, SMALL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(*columns: Column) -> Column:
    """The digest of a row: each column as its UTF-8 length, a colon and its text, or a dash if it is null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL_LETTERS))


def group_key(group: Column) -> Column:
    """A group as a text that isn't null and sorts as the groups do, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def indexed(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """rows (group, ...) with index, their place in their group from 0, and n, its size; and the largest size."""
    spark = rows.sparkSession
    # the last column parts rows that are equal in all others
    salted = rows.withColumn("__salt", F.monotonically_increasing_id())
    sorted_rows = salted.repartitionByRange(partitions(spark), "group", *order, "__salt").sortWithinPartitions("group", *order, "__salt").drop("__salt")
    kept = written(sorted_rows.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).alias("__part")
    counts = kept.groupBy("group", part).agg(F.min("__at").alias("__first"), F.count("*").alias("__n")).checkpoint()
    before = F.coalesce(F.sum("__n").over(W.partitionBy("group").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("group", "__part", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(W.partitionBy("group")).alias("n"))
    n, largest = counts.groupBy("group").agg(F.sum("__n").alias("n"), F.count("*").alias("k")).agg(F.sum("k"), F.max("n")).first()
    offsets = F.broadcast(offsets) if (n or 0) <= SMALL else offsets
    placed = kept.withColumn("__part", part).join(offsets, ["group", "__part"]).withColumn("index", F.col("__at") + F.col("__shift"))
    return placed.drop("__at", "__part", "__shift"), largest or 0


def levels_of(n: int, fanout: int, most: int) -> int:
    """How many levels a superblock collapses whose group has n nodes: `most`, or fewer until one node is left."""
    k, width = 0, 1
    while k < most and width < n:
        k, width = k + 1, width * fanout
    return k


def raised(digests: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The digests of a superblock and those of each level above them."""
    found = [digests]
    for _ in range(levels):
        below = found[-1]
        found.append([hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return found


def proofs_within(found: list[list[str]], fanout: int) -> tuple[list[str], np.ndarray]:
    """For each digest of a superblock its siblings level by level, and (place, size) of its run at each level."""
    n = len(found[0])
    own = [""] * n
    places = np.zeros((n, 2 * (len(found) - 1)), np.int32)
    width = 1
    for k, level in enumerate(found[:-1]):
        others = ["".join(run[:i] + run[i + 1 :]) for a in range(0, len(level), fanout) for run in [level[a : a + fanout]] for i in range(len(run))]
        sizes = [len(level[i - i % fanout : i - i % fanout + fanout]) for i in range(len(level))]
        at = np.arange(n) // width
        own = [a + others[i] for a, i in zip(own, at.tolist(), strict=True)]
        places[:, 2 * k], places[:, 2 * k + 1] = at % fanout, np.array(sizes)[at]
        width *= fanout
    return own, places


def collapsed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One round: (group, index, n, digest) of each superblock's root."""
    block = fanout**levels

    def collapse(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        digests = rows.sort_values("index")["digest"].tolist()
        top = raised(digests, levels_of(n, fanout, levels), fanout)[-1]
        return pd.DataFrame({"group": [key[0]], "index": [int(key[1])], "n": [-(-n // block)], "digest": top})

    grouped = nodes.select("group", "index", "n", "digest").groupBy("group", F.floor(F.col("index") / block).cast("long").alias("block"))
    return written(grouped.applyInPandas(collapse, "group string, index long, n long, digest string"))


def with_proofs(nodes: DataFrame, above: DataFrame, passed: list, fanout: int, levels: int) -> DataFrame:
    """nodes with their proofs. above: (group, index, subroot, siblings, places) of the superblocks' roots.

    passed: fields of nodes that stay beside group, index and digest.
    """
    block = fanout**levels
    names = [f.name for f in passed]

    def prove(rows: pd.DataFrame, root: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index")
        found = raised(rows["digest"].tolist(), levels_of(int(rows["n"].iloc[0]), fanout, levels), fanout)
        own, places = proofs_within(found, fanout)
        further, path = root["siblings"].iloc[0], np.asarray(root["places"].iloc[0], np.int32)
        out = rows[[*names, "group", "index", "digest"]].copy()
        out["subroot"] = root["subroot"].iloc[0] or found[-1][0]
        out["siblings"] = [a + further for a in own]
        out["places"] = list(np.concatenate([places, np.broadcast_to(path, (len(places), len(path)))], axis=1))
        return out

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in passed) + "group string, index long, digest string, subroot string, siblings string, places array<int>"
    taken = nodes.select(*names, "group", "index", "n", "digest")
    return taken.groupBy("group", F.floor(F.col("index") / block).cast("long")).cogroup(above.groupBy("group", "index")).applyInPandas(prove, schema)


def rounds(nodes: DataFrame, largest: int, fanout: int, levels: int) -> list[DataFrame]:
    """The nodes of every round, the last with one a group."""
    found = [nodes]
    while largest > 1:
        found.append(collapsed(found[-1], fanout, levels))
        largest = -(-largest // fanout**levels)
    return found


def manifest(docs: DataFrame, leaf: str = "leaf", group: str = "lang", order: tuple[str, ...] = ("doc_id",), fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """docs (with their leaves) with index, subroot, root and the proof of every row.

    siblings: the digests beside the row's own, level by level, left to right, as hexadecimal text; places: its place in its
    run and the run's size, level by level. `folded` makes a root of them.
    """
    ready(docs.sparkSession)
    if clash := set(docs.columns) & MADE:
        raise ValueError(f"docs may not have columns named {', '.join(sorted(clash))}")
    names = {c: f"c{k}" for k, c in enumerate(docs.columns) if c != leaf}
    rows = written(docs.select(*(F.col(f"`{c}`").alias(k) for c, k in names.items()), group_key(F.col(group)).alias("group"), F.col(leaf).alias("digest")))
    leaves, largest = indexed(rows, *(names[c] for c in order), "digest")
    passed = [f for f in rows.schema if f.name in names.values()]
    trees = rounds(leaves, largest, fanout, levels)
    tops, most = indexed(trees[-1].select(F.lit("").alias("group"), F.col("group").alias("of"), "digest"), "of")
    upper = rounds(tops, most, fanout, levels)
    root = upper[-1].select("digest").first()
    root = root["digest"] if root else None
    none = [F.lit("").alias("siblings"), F.array().cast("array<int>").alias("places")]
    above = upper[-1].select("group", "index", F.lit("").alias("subroot"), *none)
    for nodes in reversed(upper[1:-1]):
        above = with_proofs(nodes, above, [], fanout, levels).select("group", "index", F.lit("").alias("subroot"), "siblings", "places")
    if len(upper) > 1:
        above = with_proofs(upper[0], above, [f for f in tops.schema if f.name == "of"], fanout, levels).select(F.col("of").alias("group"), F.col("digest").alias("subroot"), "siblings", "places")
    else:
        above = tops.select(F.col("of").alias("group"), F.col("digest").alias("subroot"), *none)
    above = written(above.withColumn("index", F.lit(0).cast("long")))
    for nodes in reversed(trees[1:-1]):
        above = written(with_proofs(nodes, above, [], fanout, levels).select("group", "index", "subroot", "siblings", "places"))
    if len(trees) > 1:
        found = with_proofs(trees[0], above, passed, fanout, levels)
    else:
        found = trees[0].join(above.drop("index"), "group")
    return found.select(*(F.col(k).alias(c) for c, k in names.items()), "index", F.col("digest").alias(leaf), "subroot", F.lit(root).alias("root"), "siblings", "places")


def folded(leaf: Column, siblings: Column, places: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    digest, siblings = 64, siblings.cast("binary")
    start = F.struct(leaf.alias("digest"), F.lit(0).alias("at"))

    def step(state: Column, k: Column) -> Column:
        place, size = F.get(places, 2 * k), F.get(places, 2 * k + 1)
        left = F.substring(siblings, digest * state["at"] + 1, digest * place)
        right = F.substring(siblings, digest * (state["at"] + place) + 1, digest * (size - 1 - place))
        return F.struct(F.sha2(F.concat(left, state["digest"].cast("binary"), right), 256).alias("digest"), (state["at"] + size - 1).alias("at"))

    return F.when(F.size(places) > 0, F.aggregate(F.sequence(F.lit(0), F.floor(F.size(places) / 2).cast("int") - 1), start, step)["digest"]).otherwise(leaf)


def root_of(roots: list[str], fanout: int = FANOUT) -> str:
    """The root over a few digests: what a reader of two manifests' subroots checks by hand."""
    return reduce(lambda level, _: raised(level, 1, fanout)[-1], range(levels_of(len(roots), fanout, 64)), roots)[0]
