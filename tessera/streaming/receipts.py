"""Receipts as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import receipts
from ..schemas import UPLOAD_EVENT


def upload_events(spark: SparkSession, path: str, schema: StructType = UPLOAD_EVENT, files_per_batch: int = 1000) -> DataFrame:
    """Events that arrive as JSON files below a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A table's files as a stream, with the schema that they have.

    A table may be one file, which a stream takes as a pattern only; the last character in brackets makes it one.
    """
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def recorded(events: DataFrame) -> DataFrame:
    """Well-formed receipts, each (submission, file) once for all time: the registry has no horizon."""
    rows = receipts.classified(receipts.unnested(events)).where("action = 'recorded'")
    return rows.dropDuplicates(["submissionId", "fileId"])


def recorded_within(events: DataFrame, ts: str, horizon: str) -> DataFrame:
    """The same with bounded state: deliveries repeated later than the horizon come through again."""
    rows = receipts.classified(receipts.unnested(events)).where("action = 'recorded'")
    return rows.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(["submissionId", "fileId"])


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Takes all that has arrived, batch by batch, and stops. each(batch, id) must be idempotent by id."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def scheduled(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str = "5 minutes") -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
