"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Each block of vectors is centred, rotated by a fixed random orthogonal matrix and kept as one sign bit a dimension
(packed), with two correction scalars a vector: its distance to the centre and the inner product of its unit
residual with its code. For a query these give an unbiased estimate of the inner product and a bound on its error;
vectors whose upper bound reaches the running k-th best lower bound are reranked exactly, in double precision.

Codes are built once, where a block of vectors is put together, and travel with it; vectors travel in the type they
have in the table. All queries meet all vectors, block by block: a task owns a block of queries and one share ("lane")
of the vector blocks, which stream past it in order, so it holds one block of each. Vectors are sent once for each
QUERY_BLOCK queries. A task returns one row a query; there are as many lanes as keep the cores busy, so what meets in
the last step is lanes * k entries a query whatever the size of the table.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, as query or candidate;
neither do rows with a null id or, beside the commonest, vectors of another length. A query without other vectors
returns no row. Ties go to the smaller id. Equal rows are candidates of their own; a row is never its own neighbour
(rows are told apart by id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import partitions, ready

QUERY_BLOCK, VECTOR_BLOCK = 4096, 4096
#: Queries that one vectorised step takes.
STEP = 32
#: Tasks for each core, at the least, where there are vectors enough.
TASKS = 4
#: Standard errors that the bound spans; a miss needs an estimate further off than this.
SIGMAS = 4.0


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20240601).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


class Codes:
    """The one-bit index of one block of vectors."""

    def __init__(self, center: np.ndarray, radius: np.ndarray, fit: np.ndarray, bits: np.ndarray):
        self.center, self.radius, self.fit, self.bits, self.dims = center, radius, fit, bits, len(center)

    @classmethod
    def of(cls, vectors: np.ndarray, turn: np.ndarray) -> Codes:
        center = vectors.mean(0)
        residual = vectors - center
        radius = np.linalg.norm(residual, axis=1)
        unit = np.divide(residual, radius[:, None], out=np.zeros_like(residual), where=radius[:, None] > 0) @ turn.T
        return cls(center, radius, np.abs(unit).sum(1) / np.sqrt(vectors.shape[1]), np.packbits(unit > 0, axis=1))  # fit: <code, unit residual>

    def tobytes(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.center, self.radius, self.fit, self.bits))

    @classmethod
    def frombytes(cls, blob: bytes, dims: int, n: int) -> Codes:
        numbers = np.frombuffer(blob, np.float64, dims + 2 * n)
        return cls(numbers[:dims], numbers[dims : dims + n], numbers[dims + n :], np.frombuffer(blob, np.uint8, offset=8 * len(numbers)).reshape(n, -1))

    def bounds(self, query: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products of each query with each vector."""
        turned = query @ turn.T
        size = np.linalg.norm(query, axis=1)
        # sums of the query over each possible byte of a code: a code's inner product is then one lookup a byte
        padded = np.zeros((len(query), self.bits.shape[1] * 8))
        padded[:, : self.dims] = turned
        patterns = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
        sums = np.zeros((len(self.bits), len(query)))
        for k in range(self.bits.shape[1]):
            sums += (patterns @ padded[:, 8 * k : 8 * k + 8].T)[self.bits[:, k]]
        signed = (2 * sums.T - turned.sum(1, keepdims=True)) / np.sqrt(self.dims)
        fit = np.maximum(self.fit, 1e-9)
        off = np.sqrt(np.maximum(0, 1 - fit * fit)) / fit * SIGMAS / np.sqrt(max(1, self.dims - 1))
        at_center = (query @ self.center)[:, None]
        estimate = at_center + self.radius * signed / fit
        slack = self.radius * off * size[:, None] + 1e-9 * (1 + np.abs(estimate))
        return estimate - slack, estimate + slack


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    n = scores.shape[1]
    return np.partition(scores, n - k, axis=1)[:, n - k] if n >= k else np.full(len(scores), -np.inf)


class Best:
    """The k best of each query so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, codes: Codes, turn: np.ndarray) -> None:
        """Reranks the vectors that the codes' bounds leave: first by products as the machine sums them, then exactly what may be among the k best."""
        reach = np.linalg.norm(vectors, axis=1).max(initial=0.0) * 1e-12  # more than any two orders of summing differ
        for i in range(0, len(self.ids), STEP):
            queries, least = self.vectors[i : i + STEP], self.least[i : i + STEP]
            low, high = codes.bounds(queries, turn)
            own = self.ids[i : i + STEP, None] == ids[None, :]
            low[own] = -np.inf
            keep = (high >= np.maximum(kth_best(low, self.k), least)[:, None]) & ~own
            rough = np.where(keep, queries @ vectors.T, -np.inf)
            off = reach * np.linalg.norm(queries, axis=1)
            keep &= rough >= (np.maximum(kth_best(rough, self.k), least) - off)[:, None]
            for r in np.flatnonzero(keep.any(1)).tolist():
                q, at = i + r, np.flatnonzero(keep[r])
                exact = np.cumsum(vectors[at] * self.vectors[q], axis=1)[:, -1]  # summed in the components' order
                score, vec = np.concatenate([self.found[q][0], exact]), np.concatenate([self.found[q][1], ids[at]])
                order = np.lexsort((vec, -score))[: self.k]
                self.found[q] = score[order], vec[order]
                if len(order) == self.k:
                    self.least[q] = score[order[-1]]

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids), pa.array([f[1] for f in self.found], pa.list_(pa.int64())), pa.array([f[0] for f in self.found], pa.list_(pa.float64()))],
            ["query_id", "vec", "score"],
        )


def matrix(blob: bytes, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(blob, kind).reshape(-1, dims).astype(np.float64)


def packed(batches: Iterator[pa.RecordBatch], dims: int, kind_of: str) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (kind, block) to one row a block: ids, vectors and, of vectors, their codes as bytes."""
    turn, held, now = rotation(dims), [], None

    def out():
        ids, blob = np.concatenate([h[0] for h in held]), b"".join(h[1] for h in held)
        codes = Codes.of(matrix(blob, dims, kind_of), turn).tobytes() if now[0] else None
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), blob, codes))], ["kind", "block", "ids", "vectors", "codes"])

    for batch in batches:
        if not len(batch):
            continue
        kind, block, ids = (batch.column(k).to_numpy() for k in (0, 1, 2))
        values = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(kind_of).reshape(len(batch), -1)
        cuts = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (block[1:] != block[:-1])])
        for a, b in zip(cuts, np.r_[cuts[1:], len(ids)], strict=True):
            if now != (kind[a], block[a]):
                if held:
                    yield out()
                held, now = [], (kind[a], block[a])
            held.append((ids[a:b], values[a:b].tobytes()))
    if held:
        yield out()


def nearest(table: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of the largest inner product with each row where is_query holds."""
    spark = ready(table.sparkSession)
    narrow = table.schema[vector_column].dataType.simpleString() == "array<float>"
    kind_of, vector = ("<f4", F.col(vector_column)) if narrow else ("<f8", F.col(vector_column).cast("array<double>"))
    sound = F.col(id_column).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = table.where(sound).select(F.col(id_column).cast("long").alias("id"), vector.alias("v"), is_query.alias("q"))
    shapes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"), F.count_if("q").alias("queries")).orderBy(F.desc("n"), "dims").limit(1).collect()
    if not shapes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, n, queries = shapes[0]["dims"], shapes[0]["n"], shapes[0]["queries"]
    rows = rows.where(F.size("v") == dims)
    vector_blocks, query_blocks = -(-n // VECTOR_BLOCK), max(1, -(-queries // QUERY_BLOCK))
    lanes = max(1, min(vector_blocks, -(-TASKS * spark.sparkContext.defaultParallelism // query_blocks)))
    spread = F.xxhash64("id")
    dealt = rows.select(F.lit(1).cast("long").alias("kind"), F.pmod(spread, F.lit(vector_blocks)).alias("block"), "id", "v").unionByName(
        rows.where("q").select(F.lit(0).cast("long").alias("kind"), F.pmod(spread, F.lit(query_blocks)).alias("block"), "id", "v")
    )
    blocks = dealt.repartition("kind", "block").sortWithinPartitions("kind", "block").mapInArrow(lambda batches: packed(batches, dims, kind_of), "kind long, block long, ids binary, vectors binary, codes binary")
    every = F.sequence(F.lit(0), F.lit(query_blocks - 1))
    met = (
        blocks.withColumn("lane", F.explode(F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.lit(lanes - 1))).otherwise(F.array(F.pmod("block", F.lit(lanes)).cast("int")))))
        .withColumn("own", F.explode(F.when(F.col("kind") == 0, F.array(F.col("block").cast("int"))).otherwise(every)))
        .repartition(max(1, min(partitions(spark), 4 * query_blocks * lanes)), "own", "lane")
        .sortWithinPartitions("own", "lane", "kind", "block")
        .select("own", "lane", "kind", "ids", "vectors", "codes")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, best, now = rotation(dims), None, None
        for batch in batches:
            for own, lane, kind, ids, vectors, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, vectors = np.frombuffer(ids, np.int64), matrix(vectors, dims, kind_of)
                if kind == 0:
                    if best:
                        yield best.rows()
                    best, now = Best(ids, vectors, k), (own, lane)
                elif best and now == (own, lane):
                    best.meet(ids, vectors, Codes.frombytes(codes, dims, len(ids)), turn)
        if best:
            yield best.rows()

    found = met.mapInArrow(search, "query_id long, vec array<long>, score array<double>")
    merged = found.groupBy("query_id").agg(F.flatten(F.collect_list(F.arrays_zip(F.transform("score", lambda x: -x).alias("away"), F.col("vec")))).alias("all"))
    top = merged.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("at", "hit"))
    return top.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec").alias("vec_id"), (-F.col("hit.away")).alias("score"))
