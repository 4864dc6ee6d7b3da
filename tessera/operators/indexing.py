"""Index runs: pending documents in batches, and what a job's answer means for run and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import shortened
from ..schemas import JOB_RUNNING

BATCH = 10
NO_OPERATION = "Active ingestion run is missing kbOperationId."


def pending(documents: DataFrame, most: int = BATCH) -> DataFrame:
    return documents.where("kbIngestionStatus = 'PENDING_INGESTION'").orderBy("createdAt", "documentId").limit(most)


def active_run(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'STARTED'").orderBy("startedAt", "ingestionRunId").limit(1)


def has_failures(failed: Column, reasons: Column) -> Column:
    return (F.coalesce(failed, F.lit(0)) > 0) | (F.coalesce(F.size(reasons), F.lit(0)) > 0)


def error_summary(reasons: Column) -> Column:
    return F.nullif(shortened(F.array_join(reasons, " | ")), F.lit(""))


def run_status(job_status: Column, failures: Column) -> Column:
    """A running job leaves its run STARTED; only a complete job without failures succeeds."""
    return F.when(job_status.isin(*JOB_RUNNING), "STARTED").when((job_status == "COMPLETE") & ~failures, "SUCCEEDED").otherwise("FAILED")


def document_status(run: Column) -> Column:
    return F.when(run == "SUCCEEDED", "INDEXED").when(run == "FAILED", "FAILED").otherwise("INGESTING")


def fanned_out(documents: DataFrame, runs: DataFrame) -> DataFrame:
    """documents with the outcome of the runs (ingestionRunId, status, documentIds, errorSummary) that name them."""
    of = runs.select(F.explode("documentIds").alias("documentId"), "ingestionRunId", F.col("status").alias("run"), "errorSummary")
    both = documents.join(of, "documentId", "left")
    changed, done = F.col("run").isNotNull(), F.col("run") == "SUCCEEDED"
    ended = changed & (F.col("run") != "STARTED")
    return both.withColumns(
        {
            "kbIngestionStatus": F.when(changed, document_status(F.col("run"))).otherwise(F.col("kbIngestionStatus")),
            "pendingIngestionRunId": F.when(ended, F.lit(None)).when(changed, F.col("ingestionRunId")).otherwise(F.col("pendingIngestionRunId")),
            "lastSuccessfulIngestionRunId": F.when(changed & done, F.col("ingestionRunId")).otherwise(F.col("lastSuccessfulIngestionRunId")),
            # a failed run that gives no reason leaves the last error as it was
            "lastIngestionError": F.when(changed & done, F.lit(None)).when(ended, F.coalesce("errorSummary", "lastIngestionError")).otherwise(F.col("lastIngestionError")),
        }
    ).drop("ingestionRunId", "run", "errorSummary")
