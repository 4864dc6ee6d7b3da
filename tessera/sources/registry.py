"""Registries as views over append-only logs.

Parquet has no MERGE, and none is needed: a registry is the latest row of each key. Log rows carry a sequence column
(an event time, or a batch number and a place in it) that orders the writes of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a snapshot's bucket, and most buckets of one.
BUCKET_ROWS, MOST_BUCKETS = 1 << 18, 4096
#: Keys that are written into a filter; more of them are joined.
LISTED_KEYS = 1000


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("compression", "zstd").parquet(path)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_bucketed(rows: DataFrame, key: str, buckets: int, path: str, mode: str = "errorifexists") -> None:
    """Rows in a folder a bucket of their key, each bucket's sorted by it, so that Parquet's statistics tell its pages apart."""
    placed = rows.withColumn("bucket", bucket_of(F.col(key), buckets))
    placed.repartition("bucket").sortWithinPartitions("bucket", key).write.mode(mode).partitionBy("bucket").parquet(path)


def of_keys(bucketed: DataFrame, key: str, keys: list | DataFrame, buckets: int) -> DataFrame:
    """The rows of some keys, from their buckets' folders alone. keys: a list, or a frame with the key column.

    A long list or a frame is joined by bucket and key; where it is small enough to be broadcast, the buckets that it
    has are known before files are read.
    """
    if isinstance(keys, list) and len(keys) <= LISTED_KEYS:  # the buckets are constants to the planner
        return bucketed.where(F.col("bucket").isin(*(bucket_of(F.lit(k), buckets) for k in keys)) & F.col(key).isin(keys)).drop("bucket")
    frame = bucketed.sparkSession.createDataFrame([(k,) for k in keys], f"`{key}` string") if isinstance(keys, list) else keys.select(key)
    asked = frame.distinct().withColumn("bucket", bucket_of(F.col(key), buckets))
    return bucketed.join(asked, ["bucket", key], "left_semi").drop("bucket")


def latest_state(log: DataFrame, key: str, sequence: str) -> DataFrame:
    """The last row written for each key: an aggregate, so copies of a hot key shrink before the shuffle."""
    others = [c for c in log.columns if c != key]
    last = log.groupBy(key).agg(F.max_by(F.struct(*others), F.col(sequence)).alias("last"))
    return last.select(key, *(F.col("last")[c].alias(c) for c in others))


def insert_if_absent(new: DataFrame, registry: DataFrame, key: str, order: Column) -> tuple[DataFrame, DataFrame]:
    """(inserted, refused): within the batch the first row of a key wins, and only if the registry lacks the key.

    The first is an aggregate that combines before the shuffle, so a key that comes a million times is no task of its
    own. Rows of a key with equal orders are told apart by their number, so `new` must be rows at rest: a table or what
    was written of one.
    """
    turn = F.struct(order.alias("turn"), F.col("__row").alias("row"))
    known = registry.select(F.col(key), F.lit(True).alias("__known")).distinct()
    rows = new.withColumn("__row", F.monotonically_increasing_id())
    # the first row travels with its order, so that rows are dealt out once
    others = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*others), turn).alias("__least"))
    inserted = first.join(known, key, "left_anti").select(*(F.col(c) if c == key else F.col("__least")[c].alias(c) for c in new.columns))
    least = first.join(known, key, "left").where("__known is null").select(F.col("__least.__row").alias("__row"), F.lit(True).alias("__in"))
    marked = rows.join(least, "__row", "left")
    return inserted, marked.where("__in is null").drop("__row", "__in")


def upsert(registry: DataFrame, changes: DataFrame, key: str, sequence: str) -> DataFrame:
    """The registry with changed rows in place of old ones."""
    return latest_state(registry.unionByName(changes, allowMissingColumns=True), key, sequence)


def lookup(registry: DataFrame, key: str, value) -> DataFrame:
    return registry.where(F.col(key) == F.lit(value))


def scan_filtered(registry: DataFrame, condition: Column, most: int | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Filter with an early stop; the order makes the limit deterministic."""
    found = registry.where(condition)
    found = found.orderBy(*order) if order else found
    return found.limit(most) if most is not None else found


def from_attributes(items: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Items whose values stand under type tags ({S}, {N}, {BOOL}, {NULL}, {L}) as typed columns. fields: name to Spark type."""
    out = []
    for name, kind in fields.items():
        value = F.col(name)
        if kind == "array<string>":
            out.append(F.transform(value["L"], lambda x: x["S"]).alias(name))
        else:
            tag = {"string": "S", "boolean": "BOOL"}.get(kind, "N")
            out.append(value[tag].cast(kind).alias(name))
    return items.select(*out)
