"""Substring dedup over words and bytes against plain counting."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import corpus
import numpy as np
import pytest

from tessera.llm import _common, _repeats, bwt_dedup, substring_tree

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_expected(rows, size: int) -> list[tuple]:
    lists = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    seen = Counter(tuple(w[k : k + size]) for _, w in lists for k in range(len(w) - size + 1))
    out = []
    for i, w in lists:
        gone = bytearray(len(w))
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = b"\1" * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return corpus.normal(out)


def bytes_expected(rows, size: int) -> list[tuple]:
    raw = [(i, (t or "").encode()) for i, t in rows]
    least: dict[bytes, float] = {}
    for i, t in raw:
        for k in range(len(t) - size + 1):
            key = t[k : k + size]
            least[key] = min(least.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if least[t[k : k + size]] < (float("inf") if i is None else i):
                gone[k : k + size] = b"\1" * size
        out.append((i, len(t), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return corpus.normal(out)


@pytest.mark.parametrize("block", [None, 3000])
def test_words_against_counting(spark, monkeypatch, block):
    if block:  # many blocks and buckets, several slices of one bucket
        for name in ("BLOCK", "KEY_BUCKET", "STRETCH_BUCKET", "SLICE"):
            monkeypatch.setattr(_repeats, name, block)
    rows = corpus.texts()
    assert corpus.normal(substring_tree.remove(corpus.frame(spark, rows)).collect()) == words_expected(rows, 35)


@pytest.mark.parametrize("block", [None, 5000])
def test_bytes_against_counting(spark, monkeypatch, block):
    if block:
        for name in ("BLOCK", "KEY_BUCKET", "STRETCH_BUCKET", "SLICE"):
            monkeypatch.setattr(_repeats, name, block)
    rows = corpus.texts(2)
    assert corpus.normal(bwt_dedup.remove(corpus.frame(spark, rows)).collect()) == bytes_expected(rows, 50)


@pytest.mark.parametrize("remove", [substring_tree.remove, bwt_dedup.remove])
def test_empty_tables(spark, remove):
    assert remove(corpus.frame(spark, [])).collect() == []
    assert [r["n_removed"] for r in remove(corpus.frame(spark, [(1, None), (1, "")])).collect()] == [0, 0]


def found_of(texts: list[bytes], weights, units, size: int):
    """A bucket with one block that holds the texts under one key."""
    import pyarrow as pa

    blob = lambda values, kind: [np.array(values, kind).tobytes()]
    return pa.table({"block": [1], "keys": blob([5] * len(texts), np.uint32), "lengths": blob([len(t) for t in texts], np.uint32), "windows": blob([u - size + 1 for u in units], np.uint32), "weights": blob(weights, np.int64), "text": [pa.compress(b"".join(texts), "zstd", asbytes=True)]})


def hot_key(of) -> tuple[list[bytes], list[int]]:
    rnd = np.random.default_rng(3)
    words = [f"w{k} " for k in range(3)]
    texts = sorted({"".join(rnd.choice(words, 60)) if i % 2 else "".join(words * 20)[: 150 + i] for i in range(30)})
    found = [(t.encode(), u) for t in texts for u in [of(t.encode())]]
    return [t for t, u in found if u >= 50], [u for _, u in found if u >= 50]


def test_the_tree_alone_counts_words(monkeypatch):
    """Stretches of one key, in subtrees of a few suffixes as in one, against counting."""
    texts, units = hot_key(lambda t: len(WORD.findall(t)))
    weights, size = list(range(1, len(texts) + 1)), 35
    seen: Counter = Counter()
    lists = [WORD.findall(t) for t in texts]
    for w, n in zip(lists, weights, strict=True):
        for k in range(len(w) - size + 1):
            seen[tuple(w[k : k + size])] += n
    for group in (1 << 16, 4):
        monkeypatch.setattr(substring_tree, "GROUP", group)
        found = _repeats.Found(found_of(texts, weights, units, size), np.add)
        values, at = found.values(substring_tree.index(size))
        place = {bytes(found.text[a:b]): k for k, (a, b) in enumerate(zip(found.begin, found.end, strict=True))}
        for t, w in zip(texts, lists, strict=True):
            k = place[t]
            assert values[at[k] : at[k] + found.windows[k]].tolist() == [seen[tuple(w[i : i + size])] for i in range(len(w) - size + 1)]


def test_the_index_alone_finds_smaller_documents(monkeypatch):
    texts, units = hot_key(len)
    weights, size = [7, 3, 3, 9] * len(texts), 50
    weights = weights[: len(texts)]
    for most in (1 << 20, 300):
        monkeypatch.setattr(bwt_dedup, "INDEX_BYTES", most)
        found = _repeats.Found(found_of(texts, weights, units, size), np.minimum)
        values, at = found.values(bwt_dedup.index(size))
        place = {bytes(found.text[a:b]): k for k, (a, b) in enumerate(zip(found.begin, found.end, strict=True))}
        for t, own in zip(texts, weights, strict=True):
            k = place[t]
            wanted = [int(any(t[i : i + size] in x and w < own for x, w in zip(texts, weights, strict=True))) for i in range(len(t) - size + 1)]
            assert values[at[k] : at[k] + found.windows[k]].tolist() == wanted


def test_streamed_statistics_are_longest_matches():
    rnd = np.random.default_rng(4)
    for _ in range(40):
        cut = lambda n: (rnd.integers(97, 97 + letters, int(n.sum())).astype(np.uint8), n)
        letters = int(rnd.integers(1, 4))
        text, lengths = cut(rnd.integers(1, 30, rnd.integers(1, 12)))
        groups = np.unique(rnd.integers(0, 3, len(lengths)), return_inverse=True)[1]
        other, sizes = cut(rnd.integers(1, 30, 8))
        own = rnd.integers(0, groups.max() + 1, 8)
        index = bwt_dedup.RunLengthIndex(text, lengths, groups, lengths, 4)
        assert len(index.at) == len(index.head) == len(index.leads_to) <= len(text)
        held = [(g, text[e - n : e].tobytes()) for g, n, e in zip(groups, lengths, np.cumsum(lengths), strict=True)]
        wanted = []
        for g, n, e in zip(own, sizes, np.cumsum(sizes), strict=True):
            s = other[e - n : e].tobytes()
            wanted += [max((k for k in range(n - i + 1) if any(h == g and s[i : i + k] in t for h, t in held)), default=0) for i in range(n)]
        assert index.statistics(other, sizes, own).tolist() == wanted
        found = index.in_smaller(other, sizes, own, np.full(8, 20), 4).tolist()
        assert found == [e - n + i for g, n, e in zip(own, sizes, np.cumsum(sizes), strict=True) for s in [other[e - n : e].tobytes()] for i in range(n - 3) if any(h == g and len(t) < 20 and s[i : i + 4] in t for h, t in held)]


def test_runs_shrink_repetitive_texts():
    text = np.frombuffer((b"the same line again and again " * 4)[:100] * 50, np.uint8)
    index = bwt_dedup.RunLengthIndex(text, np.full(50, 100), np.zeros(50, np.int64), np.arange(50), 50)
    assert len(index.at) < len(text) / 10  # the strings' beginnings, and few others


def thue_morse(n: int, pair: str) -> str:
    return "".join(pair[bin(i).count("1") & 1] for i in range(n))


def test_words_built_to_share_a_hash(spark):
    """Complementary Thue-Morse words have equal polynomial hashes modulo any power of two."""
    for pair in ("ab", "xy"):
        words, other = thue_morse(2048, pair), thue_morse(2048, pair[::-1])
        head, tail = [f"a{k}" for k in range(20)], [f"b{k}" for k in range(20)]
        rows = [(i, " ".join([*head, w, *tail])) for i, w in enumerate((words, other, words[:1024] + "z", other[:1024] + "z"))]
        assert corpus.normal(substring_tree.remove(corpus.frame(spark, rows)).collect()) == words_expected(rows, 35)


def test_spans_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(_common.Bytes, "hashes", lambda self, starts, lengths: (lengths % 2).astype(np.uint64))
    data = np.frombuffer(b"one two six one two ten one", np.uint8)
    starts, ends, _ = _common.word_spans(data, np.array([0, len(data)]))
    first, of = _common.distinct_spans(data, starts, ends)
    assert [data[starts[first[k]] : ends[first[k]]].tobytes() for k in of] == WORD.findall(data.tobytes()) and len(first) == 4


def test_texts_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(_repeats, "BLOCK", 2000)
    import random

    long = corpus.words(random.Random(9), 3000)
    rows = [(1, long), (2, long[500:9000]), (3, None), (4, "short")]
    assert corpus.normal(substring_tree.remove(corpus.frame(spark, rows)).collect()) == words_expected(rows, 35)
    assert corpus.normal(bwt_dedup.remove(corpus.frame(spark, rows)).collect()) == bytes_expected(rows, 50)


def test_rewrapped_copies_of_a_hot_passage(monkeypatch):
    """Equal words with other white space between them repeat, in groups of stretches beyond one index too."""
    import random

    import pyarrow as pa

    rnd = random.Random(21)
    passage = corpus.words(rnd, 62).split()
    wrap = lambda words: "".join(w + rnd.choice([" ", "\n", "  ", "\t", " \r\n"]) for w in words)
    texts = [f"{corpus.words(rnd, 40)} {wrap(passage)} {corpus.words(rnd, 40)}".encode() for _ in range(60)]
    rows = []
    for block, text in enumerate(texts):  # each text is a block, as in scan
        data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        units = substring_tree.units_of(data, offsets)
        keys = _repeats.Anchors(units, 35, 8).key
        e = _repeats.Entries(units, 35, 8, keys, np.ones(1, np.int64), np.add)
        sent = getattr(units, "data", data)
        stretches = [sent[a:b].tobytes() for a, b in zip(e.begin, e.end, strict=True)]
        blob = lambda values, kind: np.array(values, kind).tobytes()
        rows.append({"block": block, "keys": blob(e.key, np.uint32), "lengths": blob([len(x) for x in stretches], np.uint32), "windows": blob(e.windows, np.uint32), "weights": blob(e.weight, np.int64), "text": pa.compress(b"".join(stretches), "zstd", asbytes=True)})
    windows = [tuple(w[k : k + 35]) for t in texts for w in [WORD.findall(t)] for k in range(len(w) - 34)]
    seen = Counter(windows)
    for size in (1 << 20, 1000):
        monkeypatch.setattr(_repeats, "SLICE", size)
        found = _repeats.Found(pa.Table.from_pylist(rows), np.add)
        values, at = found.values(substring_tree.index(35))
        hits = sum(int((values[at[k] : at[k] + found.windows[k]] > 1).sum()) * int(np.sum(found.entry == k)) for k in range(len(at)))
        assert hits == sum(seen[w] > 1 for w in windows) >= 60 * (62 - 35 + 1)


def test_every_window_has_one_anchor():
    """The ranges of all anchors hold each window within a row once; its anchor is the first place of its least hash."""
    rnd = np.random.default_rng(12)
    for trial in range(30):
        lengths = rnd.integers(0, 60, 8)
        data = rnd.integers(97, 97 + rnd.integers(1, 4), int(lengths.sum())).astype(np.uint8)
        units = bwt_dedup.units_of(data, np.r_[0, np.cumsum(lengths)])
        size, gram = 12, 5
        anchors = _repeats.Anchors(units, size, gram)
        which, low, high = anchors.ranges(np.arange(len(anchors.at)))
        found = {int(s): int(anchors.at[w]) for w, a, b in zip(which, low, high, strict=True) for s in range(a, b + 1)}
        assert sum(high - low + 1) == len(found)
        hashes = _common.gram_hashes(data, gram) >> np.uint64(1) if len(data) >= gram else []
        ends = np.repeat(np.cumsum(lengths), lengths)
        wanted = {s: s + int(np.argmin(hashes[s : s + size - gram + 1])) for s in range(len(data)) if s + size <= ends[s]}
        assert found == wanted


def test_passes_in_steps(monkeypatch):
    rnd = np.random.default_rng(1)
    values = rnd.integers(0, 1 << 60, 1000).astype(np.uint64)
    whole = _common.gram_hashes(values, 8), _repeats.least_of(values, 27, np.minimum)
    for module in (_common, _repeats):
        monkeypatch.setattr(module, "CACHED", 64)
    assert (_common.gram_hashes(values, 8) == whole[0]).all() and (_repeats.least_of(values, 27, np.minimum) == whole[1]).all()
    assert whole[1].tolist() == [values[i : i + 27].min() for i in range(974)]
