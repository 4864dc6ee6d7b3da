"""Stages of a corpus pipeline: each takes documents and gives what is left of them, in the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, packing, pii, quality, simhash
from ._common import ready, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MASK = "<{}>"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. A null or empty text is judged by the model's bias; ids don't matter."""
    others = tuple(c for c in COLUMNS if c != "doc_id")
    scored = quality.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels", "doc_id", "quality"), passed=others)
    return scored.where("predicted = 1").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id. A group is what links reach, each
    verified as an exact Jaccard similarity of distinct five-word shingles of 0.8 or more.

    Null, empty and blank texts are copies of each other. Rows are told apart as rows: one that shares its id with a
    removed row, or has none, goes only if it is a copy itself. An empty table stays empty.
    """
    ready(spark)
    return simhash.first_of_each(docs.select(*COLUMNS), **simhash.NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, row by row, whatever their ids; null and empty texts stay."""
    return decontaminate.without(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; n_chars follows. Null and empty texts stay as they are."""
    masked = pii.scan(docs.select(*COLUMNS), passed=("lang", "source"), mask=MASK)
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source", F.length("masked").cast("long").alias("n_chars"))


def lexical_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences: one row a piece. A null or empty text is its end id alone; no text, no piece."""
    return packing.pack(docs.select("doc_id", "text"))
