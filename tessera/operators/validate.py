"""Validation of received against expected file sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OK, NOT_FOUND, MISSING = "OK", "SUBMISSION_NOT_FOUND", "MISSING_FILES"


def validated(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """requests: (submissionId, expectedFileIds). Adds isValid, reason, missingFileIds (in order, repeats kept), actualFileIds."""
    known = registry.select("submissionId", F.coalesce("fileIds", F.array().cast("array<string>")).alias("actualFileIds"), F.lit(True).alias("known"))
    both = requests.join(known, "submissionId", "left").withColumn("actualFileIds", F.coalesce("actualFileIds", F.array().cast("array<string>")))
    missing = F.filter("expectedFileIds", lambda x: ~F.array_contains("actualFileIds", x))
    reason = F.when(F.col("known").isNull(), NOT_FOUND).when(F.size("missingFileIds") > 0, MISSING).otherwise(OK)
    return both.withColumn("missingFileIds", missing).withColumn("reason", reason).withColumn("isValid", F.col("reason") == OK).drop("known")
