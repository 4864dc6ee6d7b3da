"""Exact duplicates: claims of raw content and reuse of canonical documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys

CLAIMED, REUSED, IN_PROGRESS = "raw_file_claimed", "raw_file_reused", "raw_file_in_progress"


def hashed(files: DataFrame, content: str) -> DataFrame:
    return files.withColumn("rawFileHash", keys.content_hash(F.col(content)))


def with_first(rows: DataFrame, key: str, order: tuple[str, ...], few: bool = False) -> DataFrame:
    """rows with __first: whether a row is its key's first. An aggregate and a join, which Spark can split for a hot key.

    few: the keys are few enough to be sent to all executors, so that rows stay where they are.
    """
    turn = F.struct(*order)
    first = rows.groupBy(F.col(key).alias("__key")).agg(F.min(turn).alias("__least"))
    return rows.join(F.broadcast(first) if few else first, F.col(key).eqNullSafe(F.col("__key"))).withColumn("__first", turn.eqNullSafe(F.col("__least"))).drop("__key", "__least")


def claims(files: DataFrame, registry: DataFrame, order: tuple[str, ...], retry_failed: bool = False, few: bool = False) -> DataFrame:
    """Adds ownershipClaimed, action and the registry's documentId.

    files should hold hashes and pointers, not contents: the first row of each unknown hash claims it (the order must
    tell rows apart). A hash that is
    RESOLVED is reused; any other known hash stays in progress (FAILED too, unless retry_failed). few: as in with_first.
    """
    known = registry.select("rawFileHash", F.col("status").alias("rawFileStatus"), F.nullif("documentId", F.lit("")).alias("documentId"), F.nullif("canonicalHash", F.lit("")).alias("canonicalHash"))
    free = F.col("rawFileStatus").isNull() | (F.lit(retry_failed) & (F.col("rawFileStatus") == "FAILED"))
    placed = with_first(files.join(known, "rawFileHash", "left"), "rawFileHash", order, few)
    claimed = free & F.col("__first")
    action = F.when(claimed, CLAIMED).when(free | (F.col("rawFileStatus") == "RESOLVED"), REUSED).otherwise(IN_PROGRESS)
    return placed.withColumns({"ownershipClaimed": claimed, "action": action}).drop("__first")


def seen(files: DataFrame, at: str) -> DataFrame:
    """(rawFileHash, firstSeenAt, lastSeenAt, deliveries)."""
    return files.groupBy("rawFileHash").agg(F.min(at).alias("firstSeenAt"), F.max(at).alias("lastSeenAt"), F.count("*").alias("deliveries"))


def resolved(processed: DataFrame, registry: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Adds documentId and created: the first row of a canonical hash that the registry lacks makes its document."""
    known = registry.select("canonicalHash", F.col("documentId").alias("__known")).dropDuplicates(["canonicalHash"])
    placed = with_first(processed.join(known, "canonicalHash", "left"), "canonicalHash", order)
    made = F.col("__known").isNull() & F.col("__first")
    return placed.withColumns({"documentId": F.coalesce("__known", keys.document_id(F.col("canonicalHash"))), "created": made}).drop("__known", "__first")


def collisions(documents: DataFrame) -> DataFrame:
    """Document ids (64 bits of the hash) that stand for more than one canonical hash."""
    return documents.groupBy("documentId").agg(F.min("canonicalHash").alias("least"), F.max("canonicalHash").alias("most")).where("least <> most")
