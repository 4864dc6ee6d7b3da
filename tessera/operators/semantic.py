"""Latent semantic vectors of texts: an embedding model that is learned from the corpus itself.

Words fall into TERMS hashed terms. A text's terms are weighted by (1 + ln count) * ln((1 + texts) / (1 + texts with the
term)) and scaled to unit length; the right singular vectors of the matrix of all texts, found by randomised subspace
iteration, are the model. Each pass over the texts multiplies the matrix and its transpose by a thin one in the tasks,
adds the products up by term over the cluster, and gives the driver TERMS rows of `dims` + OVERSAMPLE numbers, however
many texts there are. All texts count, none are sampled.

Edge cases: null, empty and wordless texts, and texts of terms that the corpus lacks, are zero vectors; so is every text
of a model that was learned from nothing. A corpus of lower rank than `dims` leaves the remaining components zero.
Texts that are repeated count each time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TERMS, DIMENSIONS, OVERSAMPLE, PASSES = 1 << 14, 256, 16, 3
#: Texts that are multiplied at once, and the tasks a core over which the texts are summed up.
BLOCK, TASKS = 256, 4
_WORD = re.compile(r"[^\W_]+")
MODEL = "term int, idf double, vector array<float>"


@lru_cache(1 << 16)
def term(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % TERMS


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of every term in every text, by text and then by term."""
    found = [[term(w) for w in _WORD.findall(t.lower())] if t else [] for t in texts]
    spot = np.repeat(np.arange(len(found)), [len(x) for x in found]) * TERMS + np.array([i for x in found for i in x], np.int64)
    spot, count = np.unique(spot, return_counts=True)
    return spot // TERMS, spot % TERMS, count


def weighted(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the terms that occur, their weights as a matrix of texts by terms); rows of length one, or zero."""
    row, column, count = counts(texts)
    terms, place = np.unique(column, return_inverse=True)
    out = np.zeros((len(texts), len(terms)))
    out[row, place] = (1 + np.log(count)) * idf[column]
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return terms, np.divide(out, size, out=out, where=size > 0)


class Model:
    """idf: a number a term. basis: TERMS rows of `dims` numbers. Called with a text, gives its vector."""

    def __init__(self, idf: np.ndarray, basis: np.ndarray):
        self.idf, self.basis = idf, basis.astype(np.float32)

    def many(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), self.basis.shape[1]), np.float32)
        for at in range(0, len(texts), BLOCK):
            terms, weights = weighted(texts[at : at + BLOCK], self.idf)
            found = weights @ self.basis[terms]
            size = np.linalg.norm(found, axis=1, keepdims=True)
            out[at : at + BLOCK] = np.divide(found, size, out=np.zeros_like(found), where=size > 1e-9)
        return out

    def __call__(self, text: str | None) -> list[float]:
        return self.many([text])[0].tolist()

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, float(self.idf[i]), v.tolist()) for i, v in enumerate(self.basis)], MODEL)

    @classmethod
    def read(cls, table: DataFrame) -> Model:
        """From what `table` gave, in any order."""
        rows = table.orderBy("term").toArrow()
        vectors = rows.column("vector").combine_chunks()
        return cls(rows.column("idf").to_numpy(), vectors.flatten().to_numpy().reshape(len(vectors), -1))


def texts_with_term(texts: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """(texts, those that have each term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)  # the last: texts
        for batch in batches:
            words = batch.column(0).to_pylist()
            total[:TERMS] += np.bincount(counts(words)[1], minlength=TERMS)
            total[TERMS] += len(words)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["term", "n"])

    out = np.zeros(TERMS + 1, np.int64)
    for r in texts.select(column).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return int(out[TERMS]), out[:TERMS]


def product(texts: DataFrame, column: str, idf: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """transpose(A) * A * thin for the matrix A of all texts' weights."""
    spark, width = texts.sparkSession, thin.shape[1]
    shared = spark.sparkContext.broadcast((idf, thin))
    schema = "term int, sum binary"

    def rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[i].tobytes() for i in some], pa.binary())], ["term", "sum"])

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, thin = shared.value
        total = np.zeros((TERMS, width))
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                terms, weights = weighted(batch.column(0).slice(at, BLOCK).to_pylist(), idf)
                total[terms] += weights.T @ (weights @ thin[terms])
        yield from rows(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS, width))  # one row a term, however many tasks sent some
        for batch in batches:
            which = batch.column(0).to_numpy()
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), float).reshape(-1, width)
            np.add.at(total, which, values)
        yield from rows(total)

    parts = texts.select(column).mapInArrow(multiplied, schema)
    out = np.zeros((TERMS, width))
    for r in parts.repartition("term").mapInArrow(added, schema).toLocalIterator():
        out[r["term"]] = np.frombuffer(r["sum"], float)
    shared.unpersist()
    return out


def learned(texts: DataFrame, column: str, dims: int = DIMENSIONS, seed: int = 7) -> Model:
    """The model of all texts. They are read PASSES + 1 times, so they should be rows at rest."""
    tasks = TASKS * texts.sparkSession.sparkContext.defaultParallelism
    texts = texts.coalesce(tasks)  # each task sends its sums once, so fewer tasks send less
    n, having = texts_with_term(texts, column)
    idf = np.where(having > 0, np.log((1 + n) / (1 + having)), 0.0)
    thin = np.linalg.qr(np.random.default_rng(seed).standard_normal((TERMS, dims + OVERSAMPLE)))[0]
    for left in range(PASSES - 1, -1, -1):
        found = product(texts, column, idf, thin)
        if left:
            thin = np.linalg.qr(found)[0]
    value, turn = np.linalg.eigh((small := thin.T @ found) / 2 + small.T / 2)
    best = np.argsort(-value, kind="stable")[:dims]
    basis = thin @ turn[:, best]
    basis[:, value[best] <= 1e-9 * max(value.max(), 1e-300)] = 0
    return Model(idf, basis)
