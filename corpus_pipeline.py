"""The corpus pipeline: each stage works on all that the one before it kept, and its result is written before the next.

Quality filter, near-duplicate removal, benchmark decontamination, masking of personal data, packing. run() keeps
the stages' results as Parquet in the folder that spark.checkpoint.dir names, so a lost executor costs no finished
stage; a result goes when the next one is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.llm._common import ready, remove, tables_removed

STAGES = [
    ("quality classifier", stages.quality_classifier),
    ("simhash near-dedup", stages.simhash_near_dedup),
    ("benchmark decontamination", stages.decontamination),
    ("personal data", stages.personal_data),
    ("packing", stages.lexical_packing),
]

#: SQL cannot express the classifier, the field or the packing; tests/llm compares the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        with tables_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
