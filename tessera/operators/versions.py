"""One active document for each business key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_folder, workers_find_library

#: Candidates of a key that are folded as one list in a task; a key with more of them is cut into stretches.
FOLD_ROWS = 1 << 14
#: Candidates of a stretch, about.
STRETCH_ROWS = 1 << 17

def order_value(version: Column, updated_at: Column) -> Column:
    """(kind, value), compared as text: any version outranks any date; null without either."""
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    return F.when(version.isNotNull(), pair("version", version)).when(updated_at.isNotNull(), pair("updated_at", updated_at))


def compatible(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(True))


def elected(candidates: DataFrame, sequence: str, fold_rows: int = FOLD_ROWS, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """(businessDocumentKey, activeDocumentId, candidates): each candidate in turn against the active one.

    It takes over if there is none, if it is the same document, if either order is null, or if its order is not less.
    Null orders and the same document's lesser ones make that no plain maximum (v2, null, v1 ends with v1). Keys with up
    to fold_rows candidates are folded in a list each, all others in stretches; the results are the same. Candidates
    with equal sequences stand by document and order. Keys that are null have no election, and candidates without a
    document no part in one.
    """
    rows = candidates.where("businessDocumentKey is not null and documentId is not null").select(
        "businessDocumentKey", F.col(sequence).alias("seq"), "documentId", order_value(F.col("sourceVersion"), F.col("sourceUpdatedAt")).alias("rank")
    )
    hot = rows.groupBy("businessDocumentKey").agg(F.count("*").alias("n")).where(F.col("n") > fold_rows)
    many = hot.agg(F.sum("n")).first()[0]
    if not many:
        return folded(rows)
    large = rows.join(hot.select("businessDocumentKey"), "businessDocumentKey", "left_semi")
    small = rows.join(hot.select("businessDocumentKey"), "businessDocumentKey", "left_anti")
    return folded(small).unionByName(in_stretches(large, -(-many // stretch_rows)))


def folded(rows: DataFrame) -> DataFrame:
    lists = rows.groupBy("businessDocumentKey").agg(F.array_sort(F.collect_list(F.struct("seq", "documentId", "rank"))).alias("turns"))
    none = F.struct(F.lit(None).cast("string").alias("documentId"), F.lit(None).cast("struct<kind:string,value:string>").alias("rank"))
    wins = lambda now, x: now.documentId.isNull() | (now.documentId == x.documentId) | now["rank"].isNull() | x["rank"].isNull() | (x["rank"] >= now["rank"])
    step = lambda now, x: F.when(wins(now, x), F.struct(x.documentId.alias("documentId"), x["rank"].alias("rank"))).otherwise(now)
    return lists.select("businessDocumentKey", F.aggregate("turns", none, step).documentId.alias("activeDocumentId"), F.size("turns").cast("long").alias("candidates"))


def in_stretches(rows: DataFrame, parts: int) -> DataFrame:
    """The election of keys whose candidates lie in many tasks, each with a range of the order.

    Whatever comes into a stretch, its last null order takes over, and so does the last of its largest orders behind
    that. So a stretch has one outcome, except for an active document with a larger order than all of it: that stays,
    unless the document itself is in the stretch, and then the outcome hangs on its first place there. A stretch tells its
    largest order, its outcome, and the outcomes for its documents; of these only the documents matter that some stretch
    ends with. What is left is a few rows a stretch, gone through in order for each key.
    """
    checkpoint_folder(workers_find_library(rows.sparkSession))
    order = ["businessDocumentKey", "seq", "documentId", "kind", "value"]
    flat = rows.select("businessDocumentKey", "seq", "documentId", F.col("rank.kind").alias("kind"), F.col("rank.value").alias("value"))
    placed = flat.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("businessDocumentKey", "documentId", "kind", "value")
    told = placed.mapInPandas(stretch_outcomes, STRETCH).checkpoint()
    ends = told.select("businessDocumentKey", F.col("ends").alias("document")).distinct()
    asked = told.where("document is not null").join(ends, ["businessDocumentKey", "document"], "left_semi")
    both = told.where("document is null").unionByName(asked)
    return both.groupBy("businessDocumentKey").applyInPandas(through_stretches, "businessDocumentKey string, activeDocumentId string, candidates long")


#: Of a stretch: rows with a null document tell its largest order (null: whatever comes in, its outcome is the same), its
#: outcome and its size; the others the outcome where that document is active before, with an order above the largest.
STRETCH = "businessDocumentKey string, part int, document string, ends string, ends_kind string, ends_value string, most_kind string, most_value string, n long"


def stretch_outcomes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, now, turns = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for key, document, kind, value in zip(*(batch[c] for c in ("businessDocumentKey", "documentId", "kind", "value"))):
            if key != now and turns:
                yield outcomes(now, part, turns)
                turns = []
            now = key
            turns.append((document, None if pd.isna(kind) else (kind, value)))
    if turns:
        yield outcomes(now, part, turns)


def outcomes(key: str, part: int, turns: list[tuple[str, tuple[str, str] | None]]) -> pd.DataFrame:
    """From the last null order on, backwards: who is active at the end if a candidate takes over at its place."""
    after = next((i + 1 for i in range(len(turns) - 1, -1, -1) if turns[i][1] is None), 0)
    end, first, larger = {}, {}, []  # larger: places of orders that nothing between has reached, nearest last
    for i in range(len(turns) - 1, after - 1, -1):
        document, rank = turns[i]
        while larger and turns[larger[-1]][1] < rank:
            larger.pop()
        following = min((p for p in (larger[-1] if larger else None, first.get(document)) if p is not None), default=None)
        end[i] = i if following is None else end[following]
        larger.append(i)
        first[document] = i
    # the next place takes over from a null order, as from nothing
    last = turns[end[after] if after < len(turns) else after - 1]
    most = max((r for _, r in turns), default=None) if not after else None
    rows = [(key, part, None, last[0], *(last[1] or (None, None)), *(most or (None, None)), len(turns))]
    if not after:
        rows += [(key, part, document, turns[end[i]][0], *turns[end[i]][1], None, None, 0) for document, i in first.items()]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in STRETCH.split(", ")])


def through_stretches(told: pd.DataFrame) -> pd.DataFrame:
    """Goes through a key's stretches in order with the active document."""
    told = told.astype(object).where(told.notna(), None)
    stretches = sorted((r for r in told.itertuples(index=False) if r.document is None), key=lambda r: r.part)
    asked = {(r.part, r.document): r for r in told.itertuples(index=False) if r.document is not None}
    document = rank = None
    for s in stretches:
        won = s
        if rank is not None and s.most_kind is not None and rank > (s.most_kind, s.most_value):
            won = asked.get((s.part, document))
        if won is not None:
            document, rank = won.ends, None if won.ends_kind is None else (won.ends_kind, won.ends_value)
    return pd.DataFrame([(told["businessDocumentKey"].iloc[0], document, sum(s.n for s in stretches))], columns=["businessDocumentKey", "activeDocumentId", "candidates"])


def elected_by_order(candidates: DataFrame, sequence: str) -> DataFrame:
    """The same where every order is known: a plain aggregate that combines before the shuffle."""
    rank = order_value(F.col("sourceVersion"), F.col("sourceUpdatedAt"))
    return candidates.where("businessDocumentKey is not null").groupBy("businessDocumentKey").agg(
        F.max_by("documentId", F.struct(rank, F.col(sequence))).alias("activeDocumentId"), F.count("*").alias("candidates")
    )


def renewed(documents: DataFrame, updates: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """documents with the metadata of the files that turned out to be them, in their order, as far as the business key fits.

    A document has the first business key that it gets. A file fits if it has that key or none; what a fitting file has
    replaces what there was. All aggregates: a document that a third of all files are is no task of its own.
    """
    turn = F.struct(*order)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), turn)).alias(f"__{c}")
    first = updates.where("businessDocumentKey is not null").groupBy("documentId").agg(F.min_by("businessDocumentKey", turn).alias("__first"))
    owners = documents.select("documentId", "businessDocumentKey").join(first, "documentId").select("documentId", F.coalesce("businessDocumentKey", "__first").alias("__owner"))
    rows = updates.select("documentId", "businessDocumentKey", "sourceVersion", "sourceUpdatedAt", *order).join(owners, "documentId", "left")
    fitting = rows.where(compatible(F.col("businessDocumentKey"), F.col("__owner"))).groupBy("documentId").agg(F.max("__owner").alias("__businessDocumentKey"), last("sourceVersion"), last("sourceUpdatedAt"))
    names = ("businessDocumentKey", "sourceVersion", "sourceUpdatedAt")
    both = documents.join(fitting, "documentId", "left")
    kept = F.coalesce("businessDocumentKey", "__businessDocumentKey")
    return both.withColumns({"businessDocumentKey": kept} | {c: F.coalesce(f"__{c}", c) for c in names[1:]}).drop(*(f"__{c}" for c in names))


def flagged(documents: DataFrame, active: DataFrame) -> DataFrame:
    """documents with isActive: the winner's predecessors lose it; rows without a business key have false."""
    winners = active.select("businessDocumentKey", "activeDocumentId")
    return documents.drop("isActive").join(winners, "businessDocumentKey", "left").withColumn("isActive", F.coalesce(F.col("documentId") == F.col("activeDocumentId"), F.lit(False))).drop("activeDocumentId")


def versions_of(documents: DataFrame, business_key: str) -> DataFrame:
    return documents.where(F.col("businessDocumentKey") == business_key)
