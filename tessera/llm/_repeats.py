"""Finding repeated windows of a corpus without shipping its windows: the plan that both substring operators share.

Texts are dealt into blocks of about BLOCK bytes by a hash of the whole row. A unit is a byte or a word; a window is
`size` units.

1. Each window's least `gram`-unit hash marks an anchor. Equal windows have equal anchors, so a window can only repeat
   if its anchor's gram does; about 2 / (size - gram + 2) of the units are anchors. A block sends the 32-bit keys of
   its grams, each once, to buckets.
2. A bucket tells each block which of its keys other blocks have too.
3. A block sends, for each anchor whose key repeats, the stretch of text that the anchor's windows cover: equal
   stretches once. This is all the text that is shuffled beside the blocks themselves.
4. A bucket merges equal stretches, byte by byte, and gives them to the operator's own index in slices of whole keys.
   The index alone says which windows are hit; the bucket tells each block.
5. A block marks the units of its hit windows.

The blocks' exchange is one shuffle that all three passes over the text reuse. A key that every document holds is one
entry a block from step 1 on, so no bucket gets a row for each document.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import CACHED, distinct_spans, gram_hashes, partitions, ragged, ready, text_bytes, utf8

BLOCK, KEY_BUCKET, STRETCH_BUCKET = 2 << 20, 16 << 20, 2 << 20
#: Blocks that one task of the exchange has at most, on average.
TASK_BLOCKS = 16
#: Bytes of stretches that go to the index at once; a key with more goes alone.
SLICE = 1 << 20


def least_of(a: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every `width` neighbours."""
    out = np.empty(len(a) - width + 1, a.dtype)
    for i in range(0, len(out), CACHED):
        part, have = a[i : i + CACHED + width - 1], 1
        while have < width:
            step = min(have, width - have)
            part = pick(part[:-step], part[step:])
            have += step
        out[i : i + CACHED] = part
    return out


class Units:
    """The units of a block: a hash of each (for grams only), its row, and its bounds in the bytes of `data`.

    Equal stretches of units have equal bytes: `data` is the block's text for units of one byte, else words joined by
    one space.
    """

    def __init__(self, hashes: np.ndarray, rows: np.ndarray, starts: np.ndarray | None, ends: np.ndarray | None, data: np.ndarray):
        self.hashes, self.rows, self.starts, self.ends, self.data = hashes, rows, starts, ends, data

    def bounds(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the stretches of units a..b-1."""
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])


class Anchors:
    """Anchors of a block: their places and keys."""

    def __init__(self, units: Units, size: int, gram: int):
        n, self.span = len(units.hashes), size - gram + 1
        self.at, self.key = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.least = self.hash = np.zeros(0, np.uint64)
        if n < size:
            return
        g = gram_hashes(units.hashes, gram) >> np.uint64(1)
        g += np.uint64(1)
        whole = units.rows[: n - size + 1] == units.rows[size - 1 :]
        self.least = np.where(whole, least_of(g, self.span, np.minimum), 0)  # of each window that is in one row
        held = np.zeros(len(g) + self.span - 1, np.uint64)
        held[self.span - 1 : self.span - 1 + len(self.least)] = self.least
        self.at = np.flatnonzero(least_of(held, self.span, np.maximum) == g)
        self.hash = g[self.at]
        self.key = (self.hash >> np.uint64(16)).astype(np.uint32)

    def ranges(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of those anchors that are some window's own: which they are, and the first and last start of their windows.

        A window's own anchor is the first place of its least hash. some: whole keys, in order of place.
        """
        at, mine = self.at[some], self.hash[some]
        order = np.lexsort((at, mine))
        before = np.full(len(some), -1)  # the place before with the same hash
        before[order[1:]] = np.where(mine[order[1:]] == mine[order[:-1]], at[order[:-1]], -1)
        low, high = np.full(len(some), -1), np.full(len(some), -2)
        back = np.arange(self.span) - self.span + 1
        for i in range(0, len(some), 4096):
            start = at[i : i + 4096, None] + back
            own = self.least[np.minimum(np.maximum(start, 0), len(self.least) - 1)] == mine[i : i + 4096, None]
            own &= (start > before[i : i + 4096, None]) & (start >= 0) & (start < len(self.least))
            first, last = own.argmax(1), self.span - 1 - own[:, ::-1].argmax(1)
            some_own = own[np.arange(len(own)), first]
            low[i : i + 4096] = np.where(some_own, start[:, 0] + first, -1)
            high[i : i + 4096] = np.where(some_own, start[:, 0] + last, -2)
        found = np.flatnonzero(low >= 0)
        return some[found], low[found], high[found]


class Entries:
    """The different stretches of a block's repeated anchors."""

    def __init__(self, units: Units, size: int, gram: int, repeated: np.ndarray, weights: np.ndarray, add: np.ufunc):
        anchors = Anchors(units, size, gram)
        kinds, place, count = np.unique(anchors.key, return_inverse=True, return_counts=True)
        take = ((count > 1) | np.isin(kinds, repeated, assume_unique=True))[place]
        which, self.low, high = anchors.ranges(np.flatnonzero(take))
        key = anchors.key[which]
        self.length = high - self.low + 1
        a, b = units.bounds(self.low, high + size)
        first, self.entry = distinct_spans(units.data, a, b)
        self.key, self.windows, self.begin, self.end = key[first], self.length[first], a[first], b[first]
        own = weights[units.rows[self.low]] if len(self.low) else np.zeros(0, np.int64)
        self.own = own
        order = np.argsort(self.entry, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(self.entry[order]) != 0]) if len(order) else order
        self.weight = add.reduceat(own[order], at) if len(order) else own


class Found:
    """What a bucket holds: the different stretches of all blocks, with their weights added."""

    def __init__(self, table: pa.Table, add: np.ufunc):
        table = table.sort_by("block")
        self.blocks = table.column("block").to_numpy()
        get = lambda name, kind: [np.frombuffer(b, kind) for b in table.column(name).to_pylist()]
        keys, lengths, windows = get("keys", np.uint32), get("lengths", np.uint32), get("windows", np.uint32)
        self.sizes = np.array([len(k) for k in keys])
        self.own = np.concatenate(get("weights", np.int64))
        length = np.concatenate(lengths).astype(np.int64)
        sizes = [int(x.sum()) for x in lengths]
        self.text = np.concatenate([np.frombuffer(pa.decompress(b, n, "zstd", asbytes=True), np.uint8) for b, n in zip(table.column("text").to_pylist(), sizes, strict=True)])
        end = np.cumsum(length)
        first, self.entry = distinct_spans(self.text, end - length, end)
        order = np.argsort(self.entry, kind="stable")
        self.weight = add.reduceat(self.own[order], np.flatnonzero(np.r_[True, np.diff(self.entry[order]) != 0]))
        self.key, self.begin, self.end = np.concatenate(keys)[first], (end - length)[first], end[first]
        self.windows = np.concatenate(windows)[first].astype(np.int64)

    def values(self, index: Callable) -> tuple[np.ndarray, np.ndarray]:
        """The index's value for each window of each stretch; and where each stretch's windows begin."""
        at = np.cumsum(self.windows) - self.windows
        out = np.zeros(int(self.windows.sum()), np.int64)
        length = self.end - self.begin
        order = np.argsort(self.key, kind="stable")
        key = self.key[order]
        last = np.flatnonzero(np.r_[key[1:] != key[:-1], True]) + 1 if len(key) else np.zeros(0, np.int64)
        reach, i = np.cumsum(length[order])[last - 1], 0  # stretches and bytes up to each key's end
        while i < len(last):  # whole keys together
            j = max(i + 1, int(np.searchsorted(reach, (reach[i - 1] if i else 0) + SLICE, "right")))
            some = order[(last[i - 1] if i else 0) : last[j - 1]]
            text = self.text[ragged(self.begin[some], length[some])]
            out[ragged(at[some], self.windows[some])] = index(text, length[some], self.key[some], self.weight[some])
            i = j
        return out, at


def scan(
    docs: DataFrame, id_column: str, text_column: str, size: int, gram: int,
    units_of: Callable, weights_of: Callable, add: np.ufunc, index: Callable, hit: Callable, whole: Callable, finish: Callable, schema: str,
) -> DataFrame:
    """Runs the plan.

    units_of(data, offsets) gives the units; weights_of(ids) a weight for each row, add joins the weights of equal
    stretches; index(text, lengths, keys, weights) gives a value for each window of each of many different stretches;
    hit(value, entry's weight over all blocks, own weight) says which windows of a block's entry are hit, whole(own,
    entry's) which occurrences are hit in their block already; finish(ids, data, offsets, units, hit starts) gives the
    block's rows.
    """
    spark = ready(docs.sparkSession)
    total = text_bytes(docs, text_column)
    blocks, key_buckets, stretch_buckets = (max(1, -(-total // x)) for x in (BLOCK, KEY_BUCKET, STRETCH_BUCKET))
    n = max(partitions(spark), -(-blocks // TASK_BLOCKS))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))).repartition(n, "block")

    def sent(buckets: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The places that go to each bucket."""
        if not len(buckets):
            return []
        order = np.argsort(buckets, kind="stable")
        kinds, first = np.unique(buckets[order], return_index=True)
        return list(zip(kinds.tolist(), np.split(order, first[1:]), strict=True))

    def keys_of(key: tuple, table: pa.Table) -> pa.Table:
        data, offsets = utf8(table.column("text"))
        keys = np.unique(Anchors(units_of(data, offsets), size, gram).key)
        out = sent(keys % key_buckets)
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int64()), "block": pa.array([key[0].as_py()] * len(out), pa.int64()), "keys": pa.array([keys[at].tobytes() for _, at in out], pa.binary())})

    def repeated(key: tuple, table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(b, np.uint32) for b in table.column("keys").to_pylist()]
        kinds, count = np.unique(np.concatenate(lists), return_counts=True)
        several = kinds[count > 1]
        answer = [x[np.isin(x, several, assume_unique=True)].tobytes() for x in lists]
        return pa.table({"block": table.column("block"), "bucket": pa.array([-1] * len(lists), pa.int64()), "answer": pa.array(answer, pa.binary())})

    def entries_of(mine: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, Units, Entries]:
        data, offsets = utf8(mine.column("text"))
        units = units_of(data, offsets)
        known = answers.filter(pc.less(answers.column("bucket"), 0)).column("answer").to_pylist()
        keys = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(b, np.uint32) for b in known)])
        return data, offsets, units, Entries(units, size, gram, keys, weights_of(mine.column("id")), add)

    def stretches(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, units, e = entries_of(mine, answers)
        out = sent(e.key % stretch_buckets)
        blob = lambda values, kind: pa.array([values[at].astype(kind).tobytes() for _, at in out], pa.binary())
        length = e.end - e.begin
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in out], pa.int64()), "block": pa.array([key[0].as_py()] * len(out), pa.int64()),
                "keys": blob(e.key, np.uint32), "lengths": blob(length, np.uint32), "windows": blob(e.windows, np.uint32), "weights": blob(e.weight, np.int64),
                "text": pa.array([pa.compress(units.data[ragged(e.begin[at], length[at])].tobytes(), "zstd", asbytes=True) for _, at in out], pa.binary()),
            }
        )

    def resolve(key: tuple, table: pa.Table) -> pa.Table:
        found = Found(table, add)
        values, at = found.values(index)
        answers, k = [], 0
        for n_entries in found.sizes.tolist():
            e = found.entry[k : k + n_entries]
            lengths = found.windows[e]
            told = hit(values[ragged(at[e], lengths)], np.repeat(found.weight[e], lengths), np.repeat(found.own[k : k + n_entries], lengths))
            answers.append(np.packbits(told).tobytes())
            k += n_entries
        return pa.table({"block": pa.array(found.blocks, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(answers), pa.int64()), "answer": pa.array(answers, pa.binary())})

    def marked(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return finish(mine.column("id"), *utf8(mine.column("text")), units_of(*utf8(mine.column("text"))), np.zeros(0, np.int64))
        data, offsets, units, e = entries_of(mine, answers)
        at = np.cumsum(e.windows) - e.windows
        hits = np.zeros(int(e.windows.sum()), bool)
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("answer").to_pylist(), strict=True))
        for bucket, some in sent(e.key % stretch_buckets):
            where = ragged(at[some], e.windows[some])
            hits[where] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(where)).astype(bool)
        flags = hits[ragged(at[e.entry], e.length)] | np.repeat(whole(e.own, e.weight[e.entry]), e.length)
        return finish(mine.column("id"), data, offsets, units, ragged(e.low, e.length)[flags])

    answer = "block long, bucket long, answer binary"
    keys = dealt.groupBy("block").applyInArrow(keys_of, "bucket long, block long, keys binary")
    known = keys.groupBy("bucket").applyInArrow(repeated, answer).repartition(n, "block")
    sent_on = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(stretches, "bucket long, block long, keys binary, lengths binary, windows binary, weights binary, text binary")
    resolved = sent_on.groupBy("bucket").applyInArrow(resolve, answer)
    answers = known.unionByName(resolved).repartition(n, "block")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(marked, schema)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Units covered by the windows that begin at `starts`."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:-1]) > 0
