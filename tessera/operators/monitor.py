"""Operational analytics: counts, stale and failed items, alerts, metrics and alarms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import minutes_since
from ..schemas import OPEN_SUBMISSION
from . import ordered

STALE_MINUTES, METRIC_BATCH, PERIOD = 15, 20, "5 minutes"


def count_by_status(items: DataFrame, status: str) -> DataFrame:
    """(status, n): a missing status and a null one both count as UNKNOWN."""
    return items.groupBy(F.coalesce(F.col(status).cast("string"), F.lit("UNKNOWN")).alias("status")).agg(F.count("*").alias("n"))


def older(ts: str, now: Column, minutes: int = STALE_MINUTES) -> Column:
    return minutes_since(F.col(ts), now) >= minutes


def stale_submissions(submissions: DataFrame, now: Column, minutes: int = STALE_MINUTES) -> DataFrame:
    return submissions.where(F.col("status").isin(*OPEN_SUBMISSION) & older("updatedAt", now, minutes))


def stuck_documents(documents: DataFrame, now: Column, minutes: int = STALE_MINUTES) -> DataFrame:
    return documents.where((F.col("kbIngestionStatus") == "INGESTING") & older("updatedAt", now, minutes))


def callback_failures(submissions: DataFrame) -> DataFrame:
    return submissions.where("callbackStatus = 'FAILED'")


def alerts(**kinds: DataFrame) -> DataFrame:
    """All alerts in one frame: the kinds' columns differ, missing ones are null."""
    named = [rows.withColumn("alertType", F.lit(kind)) for kind, rows in kinds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def submission_alerts(submissions: DataFrame, documents: DataFrame, now: Column, environment: str) -> DataFrame:
    """What one pass sends to manual review, with the fields of each kind."""
    stuck = stuck_documents(documents, now).select("documentId", "kbIngestionStatus", "pendingIngestionRunId", "updatedAt", "canonicalHash")
    linked = F.coalesce("documentIds", F.array().cast("array<string>")).alias("documentIds")
    found = alerts(
        submission_stuck_non_terminal=stale_submissions(submissions, now).select("submissionId", "status", "updatedAt", linked),
        document_stuck_ingesting=stuck,
        callback_failed=callback_failures(submissions).select("submissionId", "callbackStatus", "callbackFailureReason", "updatedAt", linked),
    )
    return found.withColumn("environment", F.lit(environment))


def status_metrics(counts: DataFrame, name: str, environment: str, ts: Column) -> DataFrame:
    """(name, dimensions, ts, value): statuses that don't occur give none."""
    dims = F.create_map(F.lit("Environment"), F.lit(environment), F.lit("Status"), F.col("status"))
    return counts.select(F.lit(name).alias("name"), dims.alias("dimensions"), ts.alias("ts"), F.col("n").cast("double").alias("value"))


#: The counters of a pass and the kind of alert each counts (None: all that were queued).
COUNTERS = {
    "DocumentsStuckInIngesting": "document_stuck_ingesting", "SubmissionsStuckNonTerminal": "submission_stuck_non_terminal",
    "CallbackFailureCount": "callback_failed", "ManualReviewItemsQueued": None,
}


def counters(alerts: DataFrame, environment: str, ts: Column, queued: bool = True) -> DataFrame:
    """(name, dimensions, ts, value): one row a counter, 0 where nothing is found. queued: whether alerts go to a queue at all."""
    kind = F.col("alertType")
    values = alerts.agg(*(F.count_if(kind == k if k else F.lit(queued)).cast("double").alias(name) for name, k in COUNTERS.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in COUNTERS))).alias("m")
    return values.select(rows).select("m.name", F.create_map(F.lit("Environment"), F.lit(environment)).alias("dimensions"), ts.alias("ts"), "m.value")


def metrics(submissions: DataFrame, runs: DataFrame, alerts: DataFrame, environment: str, ts: Column) -> DataFrame:
    """All metrics of one pass: submissions and index runs by status, and the counters."""
    by_status = [status_metrics(count_by_status(rows, "status"), name, environment, ts) for name, rows in (("SubmissionCount", submissions), ("IngestionRunCount", runs))]
    return by_status[0].unionByName(by_status[1]).unionByName(counters(alerts, environment, ts))


def metric_batches(metrics: DataFrame, order: tuple[str, ...], size: int = METRIC_BATCH) -> DataFrame:
    """Adds batch: consecutive rows by `size`. The metrics of one pass are few, a row a status; see grouped_batches."""
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order))
    return metrics.withColumn("batch", F.floor((place - 1) / size))


def grouped_batches(metrics: DataFrame, group: str, sequence: str, size: int = METRIC_BATCH) -> DataFrame:
    """The same within each group, in the order of a number, for any number of rows."""
    return ordered.numbered(metrics, group, sequence, "__at").withColumn("batch", F.floor(F.col("__at") / size)).drop("__at")


def bucket(ts: Column, period: str = PERIOD) -> Column:
    return F.window(ts, period).start


def alarms(metrics: DataFrame, threshold: float = 1, statistic: str = "sum", period: str = PERIOD) -> DataFrame:
    """(name, bucket, value, inAlarm): periods without data have no row and don't breach."""
    value = {"sum": F.sum, "max": F.max}[statistic]("value")
    return metrics.groupBy("name", bucket(F.col("ts"), period).alias("bucket")).agg(value.alias("value")).withColumn("inAlarm", F.col("value") >= threshold)


def dashboard(metrics: DataFrame, statuses: list[str], period: str = PERIOD) -> DataFrame:
    """(bucket, a column for each status): the period's maximum, 0 where there is none."""
    wide = metrics.groupBy(bucket(F.col("ts"), period).alias("bucket")).pivot("status", statuses).agg(F.max("value"))
    return wide.na.fill(0.0, statuses)
