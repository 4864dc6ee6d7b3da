"""Fingerprints and groups against plain code."""

from __future__ import annotations

import re

import corpus
import numpy as np
import xxhash

from tessera.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, size: int = 4) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, radius: int = 4) -> list[tuple]:
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                group[root(i)] = root(j)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return corpus.normal((i, f"{p:016x}", least.get(root(k))) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True)))


def test_groups_against_plain_code(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    rows = corpus.texts(3)
    assert corpus.normal(simhash.near_duplicates(corpus.frame(spark, rows)).collect()) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(corpus.frame(spark, [])).collect() == []


def test_tiles_return_a_forest():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 1 << 63, 1, dtype=np.uint64)
    near = np.unique(base ^ (np.uint64(1) << rnd.integers(0, 64, 300, dtype=np.uint64)))
    nodes = np.arange(len(near))
    tile = simhash.Tile(nodes, near[:, None], np.zeros(len(near), np.int32))
    u, v = simhash.linked(tile, tile, 4)
    assert len(u) == len(near) - 1 and len(set(v.tolist())) == 1
    halves = [simhash.Tile(nodes[k::2], near[k::2, None], np.zeros(len(near[k::2]), np.int32)) for k in (0, 1)]
    u, v = simhash.linked(*halves, 4)
    assert len(u) == len(near) - 1 and len(set(v.tolist())) == 1


def test_no_pair_of_tiles_loses_a_link():
    """Random fingerprints of all population counts, in one tile and in two, against all pairs."""
    rnd = np.random.default_rng(6)
    prints = np.unique(np.concatenate([rnd.integers(0, 1 << 20, 300), rnd.integers(0, 1 << 63, 100)]).astype(np.uint64))
    size = rnd.integers(1, 30, len(prints)).astype(np.int32)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    for similar in (None, (4, 5)):
        link = apart <= 4
        if similar:
            link &= 5 * np.minimum(size[:, None], size[None, :]) >= 4 * np.maximum(size[:, None], size[None, :])
        label = np.arange(len(prints))
        simhash.settle(label, *np.nonzero(link))
        tile = simhash.Tile(np.arange(len(prints)), prints[:, None], size)
        u, v = simhash.linked(tile, tile, 4, similar)
        found = np.arange(len(prints))
        simhash.settle(found, u, v)
        assert found.tolist() == label.tolist()


def test_a_hot_star_is_spread(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FAIR", 10)
    edges = spark.createDataFrame([(i, 0) for i in range(1, 300)] + [(i + 1000, i) for i in range(50)] + [(5001, 5000)], "u long, v long")
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert found == {i: 0 for i in [*range(1, 300), *range(1000, 1050)]} | {5001: 5000}
    rows = spark.createDataFrame([(k % 7 if k % 3 else 1, k) for k in range(300)], "k int, x int")
    by_key = rows.groupBy("k").count().withColumnRenamed("count", "n").withColumn("y", rows["k"] * 2)
    got = simhash.spread_join(rows, by_key, ["k"], 300, 150)
    assert sorted((r["x"], r["y"]) for r in got.collect()) == sorted((r["x"], 2 * r["k"]) for r in rows.collect())


def test_near_pairs_of_long_fingerprints():
    rnd = np.random.default_rng(8)
    a = rnd.integers(0, 1 << 63, (50, 4), dtype=np.uint64)
    b = np.concatenate([a[:20] ^ (rnd.integers(0, 1 << 12, (20, 4), dtype=np.uint64)), ~a[:3], a[3:6]])
    apart = np.array([[sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(p, q, strict=True)) for q in b] for p in a])
    assert sorted(zip(*simhash.near_pairs(a, b, 24), strict=True)) == sorted(zip(*np.nonzero(apart <= 24), strict=True))


def test_tiles_that_meet():
    rnd = np.random.default_rng(5)
    sizes = {int(p): int(n) for p, n in zip(rnd.integers(0, 65, 30), rnd.integers(1, 40, 30), strict=True)}
    for radius in (0, 4, 70):
        first, many, low, high = simhash.tiling(sizes, 64, radius, 16)
        for p in range(65):
            for q in range(p, min(65, p + radius + 1)):
                assert low[q] <= first[p] and first[q] + many[q] - 1 <= high[p]


def test_long_fingerprints_find_near_copies(spark):
    """Pairs from far to near by five-word Jaccard similarity: those from 0.83 are linked, those up to 0.3 are not."""
    import random

    rnd, rows, similar = random.Random(4), [], {}
    cut = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)}
    for k in range(120):
        w = [f"{rnd.choice(corpus.WORDS)}{rnd.randint(0, 999)}" for _ in range(rnd.randint(80, 300))]
        rate = rnd.choice([0.003, 0.01, 0.02, 0.3])
        v = [x if rnd.random() > rate else x + "q" for x in w]
        a, b = " ".join(w), " ".join(v)
        rows += [(2 * k, a), (2 * k + 1, b)]
        similar[2 * k + 1] = len(cut(a) & cut(b)) / len(cut(a) | cut(b))
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(corpus.frame(spark, rows), **simhash.NEAR).collect()}
    high, low = [i for i, s in similar.items() if s >= 0.83], [i for i, s in similar.items() if s <= 0.3]
    assert len(high) > 20 and len(low) > 10
    assert sum(found[i] == i - 1 for i in high) >= 0.97 * len(high) and all(found[i] == i for i in low)
    assert all(found[2 * k] == 2 * k for k in range(120))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(1001, 1000)], "u long, v long")
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert all(found[i] == 0 for i in range(1, 201)) and found[1001] == 1000


def plain_groups(rows, size: int = 5) -> dict:
    """The smallest id of each row's group by exact Jaccard similarity of distinct shingles of 0.8 or more."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return {i: rows[root(k)][0] for k, (i, _) in enumerate(rows)}


def templates(pairs: list[float], each: int) -> list[tuple[int, str]]:
    """Groups of texts with a common part, so that two of a group have about the given similarity; short texts too."""
    import random

    rnd, rows = random.Random(12), []
    word = lambda: f"{rnd.choice(corpus.WORDS)}{rnd.randint(0, 999)}"
    for similarity in pairs:
        common = 2 * similarity / (1 + similarity)
        base = [word() for _ in range(120)]
        for _ in range(each):
            own = [word() for _ in range(round(120 * (1 - common)))]
            rows.append((len(rows), " ".join(base[: 120 - len(own)] + own)))
    short = [word() for _ in range(9)]
    rows += [(len(rows) + k, " ".join(t)) for k, t in enumerate([short, short[:8], short[1:], short[:7], short + [word()]])]
    rows += [(len(rows), "la " * 90 + "one two three four five six"), (len(rows) + 1, "la " * 90 + "seven eight nine ten eleven twelve")]
    return rows


def test_groups_below_the_similarity_stay_apart(spark, monkeypatch):
    """Template groups at 0.5 to 0.79, where chance links of fingerprints join everything, and near copies at 0.85."""
    rows = templates([0.5, 0.6, 0.7, 0.76, 0.79, 0.85], 40)
    want = plain_groups(rows)
    assert len(set(want.values())) > 150 and len({want[i] for i in range(200, 240)}) < 5
    for part in (4096, 16):  # whole groups in one task, and pairs of parts
        monkeypatch.setattr(simhash, "TILE", part)
        monkeypatch.setattr(simhash, "PART_ROWS", part)
        assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(corpus.frame(spark, rows), **simhash.NEAR).collect()} == want


def test_parts_of_a_group_meet_by_size(spark, monkeypatch):
    """A chain of texts that grow by a word each is one group; its parts hold neighbouring sizes only."""
    monkeypatch.setattr(simhash, "PART_ROWS", 8)
    base = [f"word{k}" for k in range(120)]
    rows = [(n, " ".join(base[:n])) for n in range(8, 120)]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(corpus.frame(spark, rows), **simhash.NEAR).collect()}
    assert found == plain_groups(rows)


def test_one_row_of_each_group_stays(spark):
    base = " ".join(f"word{k}" for k in range(60))
    rows = [(5, base), (5, "a text of its own under the same id " * 3), (7, base), (None, base + " more"), (None, "no id and no copy of anything at all here"), (None, None), (9, "")]
    kept = simhash.first_of_each(corpus.frame(spark, rows), **simhash.NEAR)
    assert kept.columns == corpus.frame(spark, rows).columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert corpus.normal(found) == corpus.normal([r for k, r in enumerate(rows) if k not in (2, 3, 5)])


def test_a_text_of_many_shingles_is_summed_in_parts(spark):
    """Over 2**18 shingles in one text: the split path gives the same fingerprint as plain code."""
    import random

    rnd = random.Random(2)
    rows = [(1, " ".join(rnd.choice(corpus.WORDS) for _ in range((1 << 18) + 5000))), (2, "a short one beside it")]
    found = {r["doc_id"]: r["fingerprint"] for r in simhash.near_duplicates(corpus.frame(spark, rows)).collect()}
    assert found == {i: f"{fingerprint(t):016x}" for i, t in rows}


def test_labels_of_earlier_links_stay_joined():
    """Links settled in several calls give what one call gives."""
    rnd = np.random.default_rng(5)
    for _ in range(200):
        n = int(rnd.integers(2, 40))
        u, v = rnd.integers(0, n, (2, int(rnd.integers(1, 40))))
        label, once = np.arange(n), np.arange(n)
        simhash.settle(once, u, v)
        for i in range(len(u)):
            simhash.settle(label, u[i : i + 1], v[i : i + 1])
        assert label.tolist() == once.tolist()
    label = np.arange(6)
    for a, b in (([5], [4]), ([5, 4], [2, 0])):
        simhash.settle(label, np.array(a), np.array(b))
    assert label.tolist() == [0, 1, 0, 3, 0, 0]


def test_similar_sets_are_found_without_comparing_all(spark, monkeypatch):
    """No tiles of all fingerprints are made where sets are verified, and only texts that share rare shingles are candidates."""
    import random

    def tiles(*_):
        raise AssertionError("all fingerprints are compared")

    seen, verify = [], simhash.verified_links
    monkeypatch.setattr(simhash, "links", tiles)
    monkeypatch.setattr(simhash, "verified_links", lambda candidates, *rest: (seen.append(candidates.count()), verify(candidates, *rest))[1])
    rnd = random.Random(3)
    text = lambda n: [f"{rnd.choice(corpus.WORDS)}{rnd.randint(0, 999)}" for _ in range(n)]
    rows = [(k, " ".join(text(rnd.choice([3, 30, 200])))) for k in range(150)]
    for k in range(0, 30):  # near copies, one word appended or changed
        w = rows[k][1].split()
        rows.append((1000 + k, " ".join([*w, "more"] if k % 2 else [*w[:-1], "other"])))
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(corpus.frame(spark, rows), **simhash.NEAR).collect()}
    assert found == plain_groups(rows)
    assert len(set(found.values())) < len(rows) and seen[0] <= 60
