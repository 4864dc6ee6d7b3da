"""Receipts: upload events to the file set of each submission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys


def unnested(events: DataFrame) -> DataFrame:
    """One row a record of each event: bucket, decoded key, event name, sequencer."""
    records = events.select(*[c for c in events.columns if c != "Records"], F.explode("Records").alias("r"))
    return records.select(
        *[c for c in records.columns if c != "r"],
        F.col("r.s3.bucket.name").alias("bucket"), keys.decoded(F.col("r.s3.object.key")).alias("key"),
        F.col("r.eventName").alias("eventName"), F.col("r.s3.object.sequencer").alias("sequencer"),
    )


def classified(records: DataFrame, key: str = "key") -> DataFrame:
    """Adds submissionId, fileId and action: recorded, ignored (another prefix) or malformed (its own row, not a failed batch)."""
    k = F.col(key)
    sid, fid = keys.submission_of(k), keys.file_of(k)
    action = F.when(~keys.is_upload(k), "ignored").when(sid.isNull() | fid.isNull(), "malformed").otherwise("recorded")
    return records.withColumns({"submissionId": F.when(keys.is_upload(k), sid), "fileId": F.when(keys.is_upload(k), fid), "action": action})


def first_receipts(receipts: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The first delivery of each file; later ones change nothing."""
    return receipts.groupBy("submissionId", "fileId").agg(F.min(F.struct(*order)).alias("arrived"), F.count("*").alias("deliveries"))


def submissions(receipts: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(submissionId, receivedFileCount, fileIds in order of arrival, duplicatesIgnored)."""
    first = first_receipts(receipts, order)
    return first.groupBy("submissionId").agg(
        F.count("*").alias("receivedFileCount"),
        F.transform(F.array_sort(F.collect_list(F.struct("arrived", "fileId"))), lambda x: x["fileId"]).alias("fileIds"),
        (F.sum("deliveries") - F.count("*")).alias("duplicatesIgnored"),
    )
