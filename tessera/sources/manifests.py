"""Submission manifests and the fixture files they describe."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MANIFEST


def manifests(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """(label, submissionId, files): an id that is given wins over a template. A manifest without files raises."""
    read = spark.read.schema(MANIFEST).option("multiLine", "true").json(path)
    named = F.coalesce(F.nullif(F.col("submissionId"), F.lit("")), F.replace(F.col("submissionIdTemplate"), F.lit("{run_id}"), F.lit(run_id)))
    files = F.when(F.coalesce(F.size("files"), F.lit(0)) > 0, F.col("files")).otherwise(F.raise_error(F.concat(F.lit("manifest has no files: "), F.coalesce("label", F.lit("?")))))
    return read.select("label", named.alias("submissionId"), files.alias("files"))


def changed(value, fields: dict | None):
    """An object with fields set; they keep their place, new ones come last."""
    if not isinstance(value, dict):
        raise ValueError("only a JSON object's top-level fields can be changed")
    return value | (fields or {})


#: What a fixture's transform makes of its parsed source: compact, or indented with changed fields.
TRANSFORMS = {
    "compact_json": lambda value, _: json.dumps(value, ensure_ascii=False, separators=(",", ":")),
    "update_top_level_fields": lambda value, transform: json.dumps(changed(value, transform.get("fields")), ensure_ascii=False, indent=2) + "\n",
}


def file_bytes(source: bytes, transform: dict | None) -> bytes:
    """A fixture's bytes: as they are ("verbatim", or no type), or as its transform makes them."""
    kind = (transform or {}).get("type", "verbatim")
    if kind == "verbatim":
        return source
    if kind not in TRANSFORMS:
        raise ValueError(f"unknown transform {kind}")
    return TRANSFORMS[kind](json.loads(source), transform).encode()
