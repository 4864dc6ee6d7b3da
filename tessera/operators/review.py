"""The manual review queue over its log: groups in order, receives, dead letters, expiry and equal contents.

messages: (messageId, alertType, sentAt, ...); receives: (messageId, receivedAt, deleted). A group is an alert type. A
message is out of the queue once it is deleted, was received MOST_RECEIVES times, or is RETENTION_DAYS old. The first
message of a group that is still in it may be received, unless its last receive is less than VISIBLE_SECONDS old; what
stands behind it waits. All steps are aggregates by message and by group, so a hot group combines before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REVIEW_FIELDS
from . import ordered

MOST_RECEIVES, VISIBLE_SECONDS, RETENTION_DAYS, DEDUP_MINUTES = 5, 60, 14, 5


def as_messages(alerts: DataFrame, now: Column) -> DataFrame:
    """Alerts as messages: their body is the JSON of the fields that they have, in the order of their names."""
    typed = alerts.select(*((F.col(n) if n in alerts.columns else F.lit(None)).cast(kind).alias(n) for n, kind in REVIEW_FIELDS.items()))
    # an empty list is part of a body, so only nulls are left out
    return typed.withColumn("body", F.to_json(F.struct(*sorted(REVIEW_FIELDS)))).withColumns({"sentAt": now, "messageId": F.uuid()})


def with_receives(messages: DataFrame, receives: DataFrame, now: Column) -> DataFrame:
    """messages with receiveCount and state: DELETED, DEAD, EXPIRED, IN_FLIGHT or WAITING."""
    seen = receives.groupBy("messageId").agg(F.count("*").alias("receiveCount"), F.max("receivedAt").alias("__last"), F.max(F.coalesce("deleted", F.lit(False))).alias("__deleted"))
    both = messages.join(seen, "messageId", "left").withColumn("receiveCount", F.coalesce("receiveCount", F.lit(0)))
    hidden = F.col("__last") + F.make_dt_interval(secs=F.lit(VISIBLE_SECONDS)) > now
    state = (
        F.when(F.col("__deleted"), "DELETED").when(F.col("sentAt") + F.make_dt_interval(F.lit(RETENTION_DAYS)) <= now, "EXPIRED")
        .when(hidden, "IN_FLIGHT").when(F.col("receiveCount") >= MOST_RECEIVES, "DEAD").otherwise("WAITING")
    )
    return both.withColumn("state", state).drop("__last", "__deleted")


def receivable(queue: DataFrame, order: tuple[str, ...] = ("sentAt", "messageId")) -> DataFrame:
    """The message of each group that may be received now. queue: what with_receives gives."""
    held = queue.where("state in ('WAITING', 'IN_FLIGHT')")
    first = held.groupBy("alertType").agg(F.min(F.struct(*order, "state", "receiveCount")).alias("first"))
    return first.where("first.state = 'WAITING'").select("alertType", "first.messageId", "first.receiveCount")


def dead_letters(queue: DataFrame) -> DataFrame:
    return queue.where("state = 'DEAD'")


#: Different times of one content that one task walks through.
STRETCH = 1 << 16
#: Later than any time in microseconds.
NEVER = np.iinfo(np.int64).max


def ends(at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """What a stretch of times makes of the first time that it may accept: (bounds, last accepted).

    A first time up to bounds[i], and beyond bounds[i - 1], leads to last[i]; beyond the last bound nothing is accepted.
    """
    after = np.searchsorted(at, at + span)  # the next one accepted after each
    last = at.copy()
    for i in range(len(at) - 1, -1, -1):
        if after[i] < len(at):
            last[i] = last[after[i]]
    keep = np.r_[last[1:] != last[:-1], True]
    return at[keep], last[keep]


def walked(at: np.ndarray, first: int, span: int) -> np.ndarray:
    """Places of the times that are accepted, from the first time that may be."""
    out, i = [], int(np.searchsorted(at, first))
    while i < len(at):
        out.append(i)
        i = int(np.searchsorted(at, at[i] + span))
    return np.array(out, np.int64)


def accepted(messages: DataFrame, content: Column, minutes: float = DEDUP_MINUTES, stretch: int | None = None) -> DataFrame:
    """Messages without those that repeat their group's content within the minutes after an accepted one.

    An accepted message silences its content from itself on, and a silenced one silences nothing: each decision hangs on
    the one before. Of equal times the smallest messageId counts. A content with more than `stretch` different times is cut
    into stretches of time; each says where it ends for whatever first time it may accept, these rows alone are gone
    through in order, and then every stretch walks from its own first time. Other contents are dealt out together. A
    null content or group is one like any other; messages without a time are dropped.
    """
    size, span = stretch or STRETCH, int(minutes * 60e6)
    micros = F.unix_micros(F.col("sentAt").cast("timestamp"))
    keyed = messages.select("messageId", F.xxhash64("alertType", F.sha2(content.cast("string"), 256)).alias("k"), F.struct("alertType", F.sha2(content.cast("string"), 256).alias("c")).alias("said"), micros.alias("at")).where("at is not null")
    times = keyed.groupBy("k", "said", "at").agg(F.min("messageId").alias("messageId")).checkpoint()
    hot = times.groupBy("k", "said").agg(F.count("*").alias("n")).where(F.col("n") > size).select("k", "said", F.lit(True).alias("hot"))
    # at most as many as stretches fit into all rows
    dealt = times.join(F.broadcast(hot), [times["k"] == hot["k"], times["said"].eqNullSafe(hot["said"])], "left").select(times["*"], F.coalesce("hot", F.lit(False)).alias("hot"))
    few = dealt.where("not hot")
    n = max(1, -(-few.count() // size))

    def walk_all(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["k", "c", "at"], kind="stable")
        at, kept = rows["at"].to_numpy(), []
        edge = np.flatnonzero(np.r_[True, (rows["k"].to_numpy()[1:] != rows["k"].to_numpy()[:-1]) | (rows["c"].to_numpy()[1:] != rows["c"].to_numpy()[:-1]), True])
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            kept.append(i + walked(at[i:j], at[i], span) if j - i > 1 else np.array([i]))
        return rows.iloc[np.concatenate(kept)][["messageId"]]

    kind = messages.schema["messageId"].dataType.simpleString()
    flat = few.select("k", F.to_json("said").alias("c"), "at", "messageId", F.pmod("k", F.lit(n)).alias("part"))
    chosen = flat.groupBy("part").applyInPandas(walk_all, f"messageId {kind}")
    many = dealt.where("hot")
    if not many.isEmpty():
        cut = ordered.stretched(many.select("k", F.to_json("said").alias("c"), "at", "messageId"), "at", size).withColumnRenamed("__part", "part").checkpoint()

        def end(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            bounds, last = ends(np.sort(rows["at"].to_numpy()), span)
            return pd.DataFrame({"k": [key[0]], "c": [key[1]], "part": [key[2]], "bounds": [bounds], "last": [last]})

        def carry(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows, first, now = rows.sort_values("part"), [], -NEVER
            for bounds, last in zip(rows["bounds"], rows["last"], strict=True):
                first.append(now)
                i = int(np.searchsorted(bounds, now))
                now = int(last[i]) + span if i < len(bounds) else now
            return pd.DataFrame({"k": rows["k"], "c": rows["c"], "part": rows["part"], "first": first})

        def walk(rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("at")
            return rows.iloc[walked(rows["at"].to_numpy(), int(entry["first"].iloc[0]), span)][["messageId"]]

        stretches = cut.groupBy("k", "c", "part").applyInPandas(end, "k long, c string, part long, bounds array<long>, last array<long>")
        entries = stretches.groupBy("k", "c").applyInPandas(carry, "k long, c string, part long, first long")
        chosen = chosen.unionByName(cut.groupBy("k", "c", "part").cogroup(entries.groupBy("k", "c", "part")).applyInPandas(walk, f"messageId {kind}"))
    return messages.join(chosen, "messageId", "left_semi")
