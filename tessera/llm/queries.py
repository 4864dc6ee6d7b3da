"""The queries of this package over the given tables, under the names that __spark_entry__.py registers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bwt_dedup, decontaminate, merkle, packing, periodic_runs, pii, quality, signature_tree, simhash, sql, substring_tree, token_counts, url_filter
from ._common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_substring_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_tree.remove(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url")).drop("score")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")


def op10_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, columns = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"), ("doc_id", "source", "lang", "n_chars")
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(changed, merkle.leaf_of(*map(F.col, columns), merkle.ascii_lower(F.col("text"))))
    leaves = docs.select("doc_id", "lang", merkle.leaf_of(*map(F.col, columns), F.col("text")).alias("leaf"), tampered.alias("tampered"))
    found = merkle.manifest(leaves).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("siblings"), F.col("places")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents", "doc_id", "text"))).withColumn("best", periodic_runs.longest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.near_sets(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
