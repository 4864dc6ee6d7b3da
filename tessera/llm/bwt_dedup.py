"""Byte-level dedup with a run-length index.

The stretches that may repeat (see _repeats) meet by anchor key and are indexed by a run-compressed Burrows-Wheeler
transform: of each run of equal characters only its character, its place, the samples at its two ends and the thresholds
between runs of one character are kept; and of each set of suffixes that share a window, where it is and the
smallest document in it. Stretches of larger documents are streamed against it: read from their ends, each step either
follows the run it is in or jumps to the nearer sampled run end, which gives for every place a suffix with its longest
match. A match of a window's length marks the window if the set it falls into has a smaller document than its own.

A byte goes if it is covered by a window that also starts in a document with a smaller id; strings are judged on the
input. Edge cases: null and empty texts have no bytes. Rows with equal ids are one document's and don't remove each
other's windows. A null id counts as larger than any: its row loses what occurs under any id, and removes nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _repeats
from ._common import Bytes, ragged
from ._repeats import Units

SIZE, GRAM = 50, 24
#: Bytes that one run-length index is built over.
INDEX_BYTES = 2 << 20
LAST = np.iinfo(np.int64).max


def suffix_order(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of many strings by group and content (each ends where it ends, ties by place), and the end of each place's string."""
    n = len(text)
    end = np.repeat(starts + lengths, lengths)
    place = np.arange(n)
    present = np.bincount(text, minlength=256) > 0
    code = np.cumsum(present)[text].astype(np.uint64)  # from 1; 0 stands behind a string's end
    bits = int(present.sum()).bit_length()
    padded = np.zeros(n + 64, np.uint64)
    padded[:n] = code
    room = end - place
    have = (63 - int(groups.max(initial=0)).bit_length()) // bits
    key = np.repeat(groups, lengths).astype(np.uint64)
    for i in range(have):
        key = (key << np.uint64(bits)) | np.where(room > i, padded[i : n + i], 0)
    rank = np.zeros(n + 1, np.uint64)
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        ranked = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]])
        rank[order] = ranked
        if ranked[-1] == n or have >= int(lengths.max()):
            break
        wide = int(ranked[-1]).bit_length()
        key = rank[:n].copy()
        times = max(2, 64 // wide)  # ranks that one key can hold: each sort multiplies the order's depth
        for i in range(1, times):
            key = (key << np.uint64(wide)) | np.where(room > i * have, rank[np.minimum(place + i * have, n)], 0)
        have *= times
    return order, end


class RunLengthIndex:
    """The transform of many strings, each in a group of its own alphabet, in runs; samples and thresholds at runs' ends.

    A character is its group and its byte, so only strings of the same group match. Suffixes that share their first
    `size` characters are a set; of each the place and the least weight are kept.
    """

    def __init__(self, text: np.ndarray, lengths: np.ndarray, groups: np.ndarray, weights: np.ndarray, size: int):
        starts = np.cumsum(lengths) - lengths
        order, self.end = suffix_order(text, starts, lengths, groups)
        self.text = Bytes(text)
        n = len(text)
        symbol = np.repeat(groups, lengths) * 256 + text
        before = np.full(n, -1, np.int64)
        before[1:] = symbol[:-1]
        before[starts] = -1
        last = before[order]
        self.at = np.flatnonzero(np.r_[True, (last[1:] != last[:-1]) | (last[1:] < 0)])  # where runs begin
        self.size = np.diff(np.r_[self.at, n])
        self.head, self.tail = order[self.at], order[self.at + self.size - 1]  # the samples
        leading = symbol[order]
        first = np.flatnonzero(np.r_[True, leading[1:] != leading[:-1]])
        self.symbols, self.starts_of, self.first_sample = leading[first], first, order[first]  # in order, as suffixes are
        self.char = np.searchsorted(self.symbols, last[self.at])  # a string's beginning has -1
        self.char[last[self.at] < 0] = -1
        # runs of each character one after another: where their characters stand among the suffixes, and the thresholds
        self.by_char = np.argsort(self.char, kind="stable")
        self.by_char = self.by_char[np.searchsorted(self.char[self.by_char], 0) :]
        chars = self.char[self.by_char]
        self.spot = chars * (len(self.at) + 1) + self.by_char
        sizes = self.size[self.by_char]
        reach = np.cumsum(sizes) - sizes
        fresh = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]]) if len(chars) else chars
        base = np.repeat(reach[fresh], np.diff(np.r_[fresh, len(chars)]))
        self.leads_to = np.full(len(self.at), -1, np.int64)
        ending = np.bincount(np.searchsorted(self.symbols, symbol[starts + lengths - 1]), minlength=len(first))  # before an empty suffix
        self.leads_to[self.by_char] = (first + ending)[chars] + reach - base
        common = np.zeros(n + 1, np.int64)  # with the suffix before
        if n > 1:
            room = np.minimum(self.end[order[1:]] - order[1:], self.end[order[:-1]] - order[:-1])
            room[leading[1:] != leading[:-1]] = 0
            common[1:n] = self.text.match(order[1:], self.text, order[:-1], room)
        first_of_set = np.flatnonzero(common[:n] < size)
        many = np.diff(np.r_[first_of_set, n])
        least = np.minimum.reduceat(np.repeat(weights, lengths)[order], first_of_set)
        whole = (self.end[order] - order)[first_of_set] >= size
        self.set_at, self.set_size, self.set_least = (x[whole] for x in (first_of_set, many, least))
        self.threshold = np.zeros(len(chars), np.int64)  # before each run but a character's first
        late = np.flatnonzero(np.r_[False, chars[1:] == chars[:-1]]) if len(chars) else chars
        if len(late):
            spans = np.empty(2 * len(late), np.int64)
            spans[::2] = (self.at + self.size)[self.by_char[late - 1]]
            spans[1::2] = self.at[self.by_char[late]] + 1
            self.threshold[late] = np.minimum.reduceat(common * (n + 1) + np.arange(n + 1), spans)[::2] % (n + 1)

    def stream(self, text: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of strings that are streamed a suffix with its longest match: its place in order and in text (-1: none)."""
        starts = np.cumsum(lengths) - lengths
        symbol = np.repeat(groups, lengths) * 256 + text
        char = np.searchsorted(self.symbols, symbol)
        char[self.symbols[np.minimum(char, len(self.symbols) - 1)] != symbol] = -1
        pointer, spot = np.full(len(text), -1, np.int64), np.full(len(text), -1, np.int64)
        turn = np.argsort(-lengths, kind="stable")  # the longest first: those still to read are the first ones
        place = (starts + lengths - 1)[turn]
        left = lengths[turn]
        # each begins in its group's first run: any place will do where nothing has matched yet
        home = np.searchsorted(self.symbols, groups[turn] * 256)
        run_of = np.searchsorted(self.at, self.first_of(home), "right") - 1
        start, sample = self.at[run_of], self.head[run_of]
        now, where = start.copy(), sample.copy()
        many = len(turn)
        while many:
            c = char[place[:many]]
            run = np.searchsorted(self.at, now[:many], "right") - 1
            step = self.leads_to[run] + now[:many] - self.at[run]
            to = where[:many] - 1
            off = np.flatnonzero((self.char[run] != c) & (c >= 0))
            step[off], to[off] = self.starts_of[c[off]], self.first_sample[c[off]]  # where no run has the character
            if len(off) and len(self.spot):
                want, q = c[off], now[off]
                k = np.searchsorted(self.spot, want * (len(self.at) + 1) + run[off])
                inner = np.minimum(k, len(self.spot) - 1)
                above, below = self.by_char[k - 1], self.by_char[inner]
                has_above = (k > 0) & (self.char[above] == want)
                has_below = (k < len(self.spot)) & (self.char[below] == want)
                up = has_above & (~has_below | (q < self.threshold[inner]))
                down = has_below & ~up
                step[off[up]], to[off[up]] = (self.leads_to + self.size)[above[up]] - 1, self.tail[above[up]] - 1
                step[off[down]], to[off[down]] = self.leads_to[below[down]], self.head[below[down]] - 1
            gone = c < 0
            pointer[place[:many]] = np.where(gone, -1, to)
            spot[place[:many]] = np.where(gone, -1, step)
            now[:many], where[:many] = np.where(gone, start[:many], step), np.where(gone, sample[:many], to)
            place[:many] -= 1
            left[:many] -= 1
            many = int(np.searchsorted(-left, 0))
        return spot, pointer

    def statistics(self, text: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """For each place of strings that are streamed the length of its longest match in the index."""
        pointer = self.stream(text, lengths, groups)[1]
        out, found = np.zeros(len(text), np.int64), np.flatnonzero(pointer >= 0)
        own = np.repeat(np.cumsum(lengths), lengths)[found] - found
        out[found] = Bytes(text).match(found, self.text, pointer[found], np.minimum(own, self.end[pointer[found]] - pointer[found]))
        return out

    def in_smaller(self, text: np.ndarray, lengths: np.ndarray, groups: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
        """Places of streamed strings whose next `size` characters an indexed string with a smaller weight holds."""
        spot, pointer = self.stream(text, lengths, groups)
        at = np.flatnonzero((spot >= 0) & (np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text)) >= size))
        of = np.searchsorted(self.set_at, spot[at], "right") - 1
        near = (of >= 0) & (spot[at] < (self.set_at + self.set_size)[of]) & (self.set_least[of] < np.repeat(weights, lengths)[at]) if len(self.set_at) else np.zeros(len(at), bool)
        at = at[near]
        return at[Bytes(text).match(at, self.text, pointer[at], np.full(len(at), size)) >= size]

    def first_of(self, symbols: np.ndarray) -> np.ndarray:
        """Where the suffixes that begin with a symbol begin."""
        return self.starts_of[np.minimum(symbols, len(self.symbols) - 1)]


def index(size: int):
    def in_smaller(text: np.ndarray, lengths: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each window of each string, in their order, whether a string of its key with a smaller weight holds it."""
        at = np.cumsum(lengths) - lengths
        order = np.lexsort((weights, keys))
        key, weight = keys[order], weights[order]
        fresh = np.r_[True, key[1:] != key[:-1]]
        kind = np.empty(len(order), np.int64)  # the key's number
        kind[order] = np.cumsum(fresh) - 1
        step = np.cumsum(fresh | np.r_[True, weight[1:] != weight[:-1]])
        rank = np.empty(len(order), np.int64)  # the weight's place among its key's
        rank[order] = step - np.maximum.accumulate(np.where(fresh, step, 0))
        several = (np.bincount(kind, weights=rank > 0)[kind] > 0)[order]
        some, later = order[several], order[several & (rank[order] > 0)]
        hit = np.zeros(len(text), bool)
        reach, i = np.cumsum(lengths[some]), 0
        while i < len(some):  # whole strings, as many as one index takes; larger documents of their keys are streamed
            j = max(i + 1, int(np.searchsorted(reach, (reach[i - 1] if i else 0) + INDEX_BYTES, "right")))
            kinds, own = np.unique(kind[some[i:j]], return_inverse=True)
            built = RunLengthIndex(text[ragged(at[some[i:j]], lengths[some[i:j]])], lengths[some[i:j]], own, weights[some[i:j]], size)
            a, b = np.searchsorted(kind[later], kinds[0]), np.searchsorted(kind[later], kinds[-1], "right")
            read = np.r_[0, np.cumsum(lengths[later[a:b]])]
            while a < b:
                k = max(1, int(np.searchsorted(read, read[0] + INDEX_BYTES, "right")) - 1)
                part = later[a : a + k]
                where = ragged(at[part], lengths[part])
                hit[where[built.in_smaller(text[where], lengths[part], np.searchsorted(kinds, kind[part]), weights[part], size)]] = True
                a, read = a + k, read[k:]
            i = j
        inner = np.arange(len(text)) + size <= np.repeat(at + lengths, lengths)
        return hit[inner].astype(np.int64)

    return in_smaller


def units_of(data: np.ndarray, offsets: np.ndarray) -> Units:
    return Units(data, np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets)), None, None, data)


def weights_of(ids: pa.ChunkedArray) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids.to_pylist()], np.int64)


def remove(docs: DataFrame, size: int = SIZE, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row. Ids are integers."""

    def finish(ids, data, offsets, units, starts) -> pa.Table:
        gone = _repeats.covered(starts, size, len(data))
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        inner = offsets[:-1][np.diff(offsets) > 0]
        first[inner] = gone[inner]
        total = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][offsets]).astype(np.int64)
        kept = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.table({id_column: ids, "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": total(gone), "n_spans": total(first), "kept_sha256": pa.array(kept, pa.string())})

    kind = docs.schema[id_column].dataType.simpleString()
    return _repeats.scan(
        docs, id_column, text_column, size, gram, units_of, weights_of, np.minimum, index(size),
        hit=lambda found, least, own: (found > 0) | (least < own), whole=lambda own, least: own > least, finish=finish,
        schema=f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )
