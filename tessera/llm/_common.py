"""Helpers shared by the corpus operators: table access, Arrow text buffers and vectorised word hashing.

Everything here works on whole Arrow buffers: a column of texts is one array of UTF-8 bytes and one
array of row offsets, so the per-row cost in Python is paid once a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_folder, workers_find_library

#: Multiplier of the polynomial hash of grams (odd, so it has an inverse modulo 2**64).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Text bytes that one vectorised step works on. Bounds a worker's memory, not the input.
STEP_BYTES = 1 << 21

#: True at the bytes that part words: space and tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Values that one step of a pass over a whole block takes, so that what it makes stays in the processor's cache.
CACHED = 1 << 15
#: Spans longer than this are hashed and compared one by one.
LONG = 512
#: Masks of the first 0 to 8 bytes of a little-endian number.
HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_powers: dict[str, np.ndarray] = {}
_tables: list[str] = []


def ready(spark: SparkSession) -> SparkSession:
    """Python workers find this package, and the shared checkpoint folder is set."""
    checkpoint_folder(workers_find_library(spark))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Reads one table; only the named columns reach the scan."""
    frame = ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def written(frame: DataFrame) -> DataFrame:
    """A frame as a table in the shared folder: lineage ends there, and a reader takes only the columns it needs.

    The folder stays, unless the caller writes what it makes of the table within tables_removed.
    """
    spark = ready(frame.sparkSession)
    folder = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    _tables.append(folder)
    frame.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def tables_removed(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the tables written within it; what was made of them must be written by then."""
    before = len(_tables)
    yield
    for path in _tables[before:]:
        remove(spark, path)
    del _tables[before:]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(frame: DataFrame, column: str = "text") -> int:
    """Bytes of text in the whole table: one pass that sizes the blocks of the block operators."""
    return int(frame.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        empty = pa.scalar(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "", column.type)
        column = pc.fill_null(column, empty)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows with about `most` bytes each; a larger row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    have = len(_powers.get("up", ()))
    if have < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the low bits of a polynomial hash over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def gram_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each `size` neighbouring values, from prefix sums. Different grams may share it."""
    out = np.empty(len(values) - size + 1, np.uint64)
    up, down = powers(CACHED + size + 1)
    total = np.zeros(CACHED + size, np.uint64)
    for i in range(0, len(out), CACHED):
        some = values[i : i + CACHED + size - 1].astype(np.uint64)
        n = len(some)
        some += np.uint64(1)
        some *= up[:n]
        np.cumsum(some, out=total[1 : n + 1])
        out[i : i + CACHED] = mix((total[size : n + 1] - total[: n - size + 1]) * down[: n - size + 1])
    return out


class Bytes:
    """Bytes whose spans are hashed and compared eight at a time."""

    def __init__(self, data: np.ndarray):
        self.data = np.zeros(len(data) + 8, np.uint8)
        self.data[: len(data)] = data
        self.words = np.ndarray(len(data) + 1, "<u8", self.data, 0, (1,))  # the eight bytes from each place on

    def hashes(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span; spans of one length up to eight have different ones."""
        h = mix(lengths.astype(np.uint64) + np.uint64(1))
        at = np.flatnonzero((lengths > 0) & (lengths <= LONG))
        k = 0
        while len(at):
            left = lengths[at] - k
            h[at] = mix(h[at] ^ (self.words[starts[at] + k] & HEAD[np.minimum(left, 8)]))
            at, k = at[left > 8], k + 8
        for i in np.flatnonzero(lengths > LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.data[starts[i] : starts[i] + lengths[i]].tobytes(), 7)
        return h

    def match(self, starts: np.ndarray, other: Bytes, there: np.ndarray, room: np.ndarray) -> np.ndarray:
        """How many bytes from each place on are those of `other`, `room` at most."""
        out = room.copy()
        at, k = np.flatnonzero(room > 0), 0
        while len(at):
            apart = self.words[starts[at] + k] ^ other.words[there[at] + k]
            hit = apart != 0
            some = apart[hit]
            out[at[hit]] = np.minimum(out[at[hit]], k + (np.bitwise_count((some & (~some + np.uint64(1))) - np.uint64(1)) >> 3))
            k += 8
            at = at[~hit]
            at = at[room[at] > k]
        return out

    def same(self, starts: np.ndarray, other: Bytes, there: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether each span has the same bytes as one of the same length in `other`."""
        out = np.ones(len(starts), bool)
        at = np.flatnonzero((lengths > 0) & (lengths <= LONG))
        k = 0
        while len(at):
            left = lengths[at] - k
            hit = ((self.words[starts[at] + k] ^ other.words[there[at] + k]) & HEAD[np.minimum(left, 8)]) == 0
            out[at[~hit]] = False
            at, k = at[hit & (left > 8)], k + 8
        for i in np.flatnonzero(lengths > LONG).tolist():
            out[i] = np.array_equal(self.data[starts[i] : starts[i] + lengths[i]], other.data[there[i] : there[i] + lengths[i]])
        return out


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first span of each content, and which of them each span equals: hashes find equals, bytes decide."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held, lengths = Bytes(data), ends - starts
    _, first, of = np.unique(held.hashes(starts, lengths), return_index=True, return_inverse=True)
    model = first[of]
    equal = (lengths == lengths[model]) & held.same(starts, held, starts[model], np.minimum(lengths, lengths[model]))
    others: dict[bytes, int] = {}
    more = []
    for i in np.flatnonzero(~equal).tolist():  # another content with the same hash
        content = data[starts[i] : ends[i]].tobytes()
        if content not in others:
            others[content] = len(first) + len(more)
            more.append(i)
        of[i] = others[content]
    return np.r_[first, np.array(more, np.int64)], of


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the row each is in; words never cross rows."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    solid = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, in steps of bounded size."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + STEP_BYTES, "right")))
        a = starts[i]
        out[i:j] = Bytes(data[a : ends[j - 1]]).hashes(starts[i:j] - a, ends[i:j] - starts[i:j])
        i = j
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of many ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)
