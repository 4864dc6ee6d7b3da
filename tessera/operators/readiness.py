"""Readiness of submissions from the states of their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def states(submissions: DataFrame, documents: DataFrame) -> DataFrame:
    """(submissionId, documentId, status): ids once each; status null for a document that the registry lacks, or no id."""
    ids = submissions.select("submissionId", F.explode_outer(F.array_distinct("documentIds")).alias("documentId"))
    return ids.join(documents.select("documentId", F.col("kbIngestionStatus").alias("status")), "documentId", "left").select("submissionId", "documentId", "status")


def readiness(states: DataFrame) -> DataFrame:
    """(submissionId, status, indexed, failed, pending, documents): a missing document is pending, an empty list waits."""
    some, status = F.col("documentId").isNotNull(), F.coalesce("status", F.lit("UNKNOWN"))
    counted = states.groupBy("submissionId").agg(
        F.count_if(some & (status == "INDEXED")).alias("indexed"), F.count_if(some & (status == "FAILED")).alias("failed"),
        F.count_if(some & ~status.isin("INDEXED", "FAILED")).alias("pending"), F.count_if(some).alias("documents"),
    )
    said = F.when(F.col("failed") > 0, "FAILED").when((F.col("documents") > 0) & (F.col("pending") == 0), "READY").otherwise("WAITING_FOR_INDEX")
    return counted.withColumn("status", said)


def summaries(states: DataFrame) -> DataFrame:
    """(submissionId, documents): ordered (documentId, status) pairs, MISSING for an unknown document."""
    pair = F.struct("documentId", F.coalesce("status", F.lit("MISSING")).alias("status"))
    return states.where("documentId is not null").groupBy("submissionId").agg(F.array_sort(F.collect_list(pair)).alias("documents"))
