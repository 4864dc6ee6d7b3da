"""Small corpora with the awkward cases that every operator must handle."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, block string, key string, score double, row long"
WORDS = "the of and river stone quiet lamp paper green under seven makes light corner winter bread glass maybe often table".split()


def words(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) * (rnd.random() < 0.3) for _ in range(n))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): copies, near copies, shared passages, nulls, empty and blank texts, a long text, repeated rows."""
    rnd = random.Random(seed)
    out: list[tuple[int | None, str | None]] = [(i, words(rnd, rnd.randint(1, 160))) for i in range(40)]
    passage, base = words(rnd, 60), words(rnd, 200)
    out += [(40 + i, f"{words(rnd, 20)} {passage}\n{words(rnd, 15)}") for i in range(6)]
    out += [(50 + i, base) for i in range(5)]
    out += [(60 + i, base.replace(base.split()[7 * i], f"changed{i}", 1)) for i in range(5)]
    out += [(70, None), (71, ""), (72, " \t\n"), (73, words(rnd, 20_000)), (None, "a row without an id " * 12), (None, None), (74, "é ü ß 日本語 “quoted” 🙂 " * 9)]
    out += [(75, "la " * 120), (76, "la " * 120), (77, "x" * 300), (78, "x" * 90)]
    out += [(5, out[5][1]), (6, "the same id with another text")]
    rnd.shuffle(out)
    return out


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """The rows as documents with columns whose names operators might use themselves."""
    return spark.createDataFrame([(i, t, None, None, None, -1, "b", "k", None, 0) for i, t in rows], SCHEMA).repartition(3)


def tables(spark: SparkSession, folder: str, rows: list, labels: list, benchmark: list) -> str:
    """The rows as a folder of tables."""
    frame(spark, rows).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return folder


def normal(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
