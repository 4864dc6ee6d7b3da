"""Periodic runs against plain loops."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from corpus import frame, texts

from tessera.llm import periodic_runs


def plain_runs(words: list, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """Every period's stretches of equal words that far apart; a stretch stays under its smallest period."""
    found, ids = {}, np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    for q in range(1, len(words) // times + 1):
        edges = np.diff(np.r_[0, (ids[:-q] == ids[q:]).astype(int), 0])
        for i, j in zip(np.flatnonzero(edges > 0).tolist(), np.flatnonzero(edges < 0).tolist(), strict=True):
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
    return sorted((a, n, q) for (a, n), q in found.items())


def collapsed(words: list, runs) -> str:
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(i: int | None, words: list[str]) -> list[str]:
    h = 1 if i is None else zlib.crc32(str(i).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (9, 3)])
def test_runs_of_small_alphabets(least, times):
    rnd = random.Random(least)
    for _ in range(150):
        docs = []
        for _ in range(rnd.randint(1, 5)):
            words = [rnd.choice("ab" if rnd.random() < 0.5 else "abcdefgh") for _ in range(rnd.randint(0, 50))]
            a, p = rnd.randint(0, 50), rnd.randint(1, 6)
            docs.append([words[a + (i - a) % p] if a + p < len(words) and a <= i < a + 30 else w for i, w in enumerate(words)])
        joined = [" ".join(d) for d in docs]
        data, offsets = np.frombuffer("".join(joined).encode(), np.uint8), np.cumsum([0, *map(len, joined)])
        sizes, row, found, kept = periodic_runs.analysed(data, offsets, least, times)
        assert sizes.tolist() == [len(d) for d in docs]
        for k, words in enumerate(docs):
            want = plain_runs(words, least, times)
            assert [tuple(found[:, c].tolist()) for c in np.flatnonzero(row == k)] == want
            assert kept[k].decode() == collapsed(words, want)


def test_pairs_in_small_steps(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 3)
    words = list("abcabcabcabcaxyxyxyxyxyxyxaaaaaaa")
    ids = np.array([ord(c) for c in words])
    got = periodic_runs.runs_of(ids, np.zeros(len(ids), np.int64), 1)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == plain_runs(words)


def test_whole_texts_with_planted_runs(spark):
    """Nulls, blanks, a long text, repeated rows and ids, other columns kept."""
    rows = [*texts(), (500, "na " * 5000), (501, "one two three " * 900 + "end")]
    got = periodic_runs.runs(periodic_runs.with_planted_runs(frame(spark, rows))).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() >= {"id", "block", "row", "lang"} and got[0]["block"] == "b"
    want = []
    for i, t in rows:
        words = planted(i, re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        runs = plain_runs(words)
        want.append((i, len(words), runs, collapsed(words, runs)))
    key = lambda r: repr(r)
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=key) == sorted(want, key=key)
    assert sum(bool(w[2]) for w in want) > 5


def test_empty_table_and_clashing_names(spark):
    docs = frame(spark, []).select("doc_id", "text")
    assert periodic_runs.runs(docs).columns == ["doc_id", "n_words", "runs", "collapsed"] and periodic_runs.runs(docs).collect() == []
    with pytest.raises(ValueError, match="runs"):
        periodic_runs.runs(docs.withColumn("runs", docs["doc_id"]))
