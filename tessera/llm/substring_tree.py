"""Substring dedup over words with prefix-partitioned suffix trees.

The suffixes of the stretches that may repeat (see _repeats) are split by variable-length prefixes: a prefix with more
than GROUP suffixes is lengthened by a word, short ones are taken together, so each group fits in memory. A group's
subtree is grown top-down: the suffixes of every node are parted by their next words, and nodes with a single leaf are
done. Its internal nodes of the window's depth are the repeats; a window's occurrences are the weights of the leaves
below its node.

A word goes if it is covered by a window whose word sequence also starts anywhere else, same document included;
windows are judged on the input. Edge cases: null, empty and blank texts have no words. Ids play no part, so null
and equal ids are like any other; a repeated row is another occurrence. Words are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _repeats
from ._common import distinct_spans, ragged, word_hashes, word_spans
from ._repeats import Units

SIZE, GRAM = 35, 8
#: Suffixes that one subtree holds.
GROUP = 1 << 16


def prefix_groups(words: np.ndarray, suffixes: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """The suffixes in groups of whole prefixes, and how many words all of a group's suffixes share."""
    wait = [(suffixes, 0)]
    while wait:
        some, depth = wait.pop()
        if len(some) <= GROUP or depth == size:
            yield some, depth
            continue
        some = some[np.argsort(words[some + depth], kind="stable")]
        word = words[some + depth]
        last = np.flatnonzero(np.r_[word[1:] != word[:-1], True]) + 1
        i = 0
        while i < len(last):
            begin = last[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(last, begin + GROUP, "right")))
            wait.append((some[begin : last[j - 1]], depth + (j == i + 1)))
            i = j


def deep_nodes(words: np.ndarray, suffixes: np.ndarray, depth: int, size: int) -> np.ndarray:
    """For each suffix of a group the internal node at depth `size` above it; -1 where it is the only leaf there."""
    node, live = np.zeros(len(suffixes), np.uint64), np.arange(len(suffixes))
    wide = max(1, int(words.max(initial=0)).bit_length())
    while depth < size and len(live):
        many = min(size - depth, (64 - len(live).bit_length()) // wide)  # words that part the nodes at once
        key = node[live]
        for i in range(many):
            key = (key << np.uint64(wide)) | words[suffixes[live] + depth + i].astype(np.uint64)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        leaves = np.diff(np.r_[first, len(key)])
        inner = leaves > 1
        live = live[order[np.repeat(inner, leaves)]]
        node[live] = np.repeat(np.arange(int(inner.sum()), dtype=np.uint64), leaves[inner])
        depth += many
    out = np.full(len(suffixes), -1)
    out[live] = node[live]
    return out


def index(size: int):
    def occurrences(text: np.ndarray, lengths: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each window of each stretch, in their order, the occurrences of its word sequence."""
        starts, ends, rows = word_spans(text, np.r_[0, np.cumsum(lengths)])
        words = distinct_spans(text, starts, ends)[1].astype(np.uint32)
        last = np.cumsum(np.bincount(rows, minlength=len(lengths)))[rows]
        suffixes = np.flatnonzero(np.arange(len(rows)) + size <= last)
        out = weights[rows]
        for some, depth in prefix_groups(words, suffixes, size):
            node = deep_nodes(words, some, depth, size)
            below, node = some[node >= 0], node[node >= 0]
            total = np.zeros(int(node.max(initial=-1)) + 1, np.int64)
            np.add.at(total, node, weights[rows[below]])
            out[below] = total[node]
        return out[suffixes]

    return occurrences


def units_of(data: np.ndarray, offsets: np.ndarray) -> Units:
    """Words, joined by one space: windows are word sequences whatever white space the text has between the words."""
    starts, ends, rows = word_spans(data, offsets)
    hashes, lengths = word_hashes(data, starts, ends), ends - starts + 1
    joined = data[np.minimum(ragged(starts, lengths), max(0, len(data) - 1))] if len(starts) else np.zeros(0, np.uint8)
    after = np.cumsum(lengths)
    joined[after - 1] = 32
    return Units(hashes, rows.astype(np.int32), after - lengths, after - 1, joined)


def remove(docs: DataFrame, size: int = SIZE, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row."""

    def finish(ids, data, offsets, units, starts) -> pa.Table:
        rows = len(offsets) - 1
        gone = _repeats.covered(starts, size, len(units.hashes))
        keep = np.flatnonzero(~gone)
        length = units.ends[keep] - units.starts[keep] + 1  # with a blank after each word
        joined = units.data[ragged(units.starts[keep], length)]
        after = np.cumsum(length)
        bounds = np.r_[0, after][np.searchsorted(units.rows[keep], np.arange(rows + 1))]
        kept = [hashlib.sha256(joined[a : max(a, b - 1)].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        count = lambda of: np.bincount(of, minlength=rows).astype(np.int64)
        return pa.table({id_column: ids, "n_words": count(units.rows), "n_removed": count(units.rows[gone]), "kept_sha256": pa.array(kept, pa.string())})

    kind = docs.schema[id_column].dataType.simpleString()
    return _repeats.scan(
        docs, id_column, text_column, size, gram, units_of, lambda ids: np.ones(len(ids), np.int64), np.add, index(size),
        hit=lambda total, weight, own: total > 1, whole=lambda own, weight: weight > 1, finish=finish,
        schema=f"`{id_column}` {kind}, n_words long, n_removed long, kept_sha256 string",
    )
