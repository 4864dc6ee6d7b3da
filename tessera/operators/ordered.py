"""Running values within a group in an order, without a task that holds a whole group.

Rows are cut into stretches of a numeric sequence column with about `size` rows each over all groups; what a stretch
carries over to the later ones is one row a group and stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SIZE = 1 << 16


def stretched(rows: DataFrame, sequence: str, size: int | None = None) -> DataFrame:
    """rows with __part, the stretch of their sequence number."""
    low, high, n = rows.agg(F.min(sequence), F.max(sequence), F.count("*")).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) * (size or SIZE) // max(1, n)))
    return rows.withColumn("__part", F.floor((F.col(sequence) - F.lit(low or 0)) / F.lit(width)))


def carried(held: DataFrame, value: Column, name: str) -> DataFrame:
    """One row a group and stretch: a value over the group's earlier stretches."""
    before = W.partitionBy("__group").orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    return held.select("__group", "__of", value.over(before).alias(name))


def with_carried(rows: DataFrame, group: str, held: DataFrame) -> DataFrame:
    both = rows.join(held, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__of")))
    return both.drop("__part", "__group", "__of")


def numbered(rows: DataFrame, group: str, sequence: str, name: str, size: int | None = None) -> DataFrame:
    """rows with their place in their group, from 0."""
    cut = stretched(rows, sequence, size)
    held = cut.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__of")).agg(F.count("*").alias("__n"))
    placed = cut.withColumn("__place", F.row_number().over(W.partitionBy(group, "__part").orderBy(sequence)) - 1)
    both = with_carried(placed, group, carried(held, F.sum("__n"), "__before"))
    return both.withColumn(name, F.coalesce("__before", F.lit(0)) + F.col("__place")).drop("__place", "__before")


def running_max(rows: DataFrame, group: str, sequence: str, value: Column, name: str, size: int | None = None) -> DataFrame:
    """rows with the largest value of their group so far, their own included; nulls don't count."""
    cut = stretched(rows.withColumn("__value", value), sequence, size)
    held = cut.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__of")).agg(F.max("__value").alias("__most"))
    own = W.partitionBy(group, "__part").orderBy(sequence).rowsBetween(W.unboundedPreceding, 0)
    both = with_carried(cut.withColumn("__here", F.max("__value").over(own)), group, carried(held, F.max("__most"), "__before"))
    return both.withColumn(name, F.greatest("__before", "__here")).drop("__value", "__here", "__before")
