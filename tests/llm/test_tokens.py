"""Token counts and packing against the library on whole texts."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import corpus
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing, token_counts
from tessera.llm._tokens import Encoder, encoder

PARTS = ["'", "s", "S", " ", "\n", "t", "re", "'ll", "'s", "'S", " '", "''", "9", "12", ".", "!", "é", "É", "x", "  ", "\t", " \n", "'ve", "d", "'d", "\r\n", "ß", "×", "|", "+1"]


@pytest.mark.parametrize(("name", "spaced"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_encode_as_in_their_text(name, spaced):
    enc, rnd = encoder(name, spaced), random.Random(7)
    found = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    got = enc.ids([enc.safe(t) for t in found])
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(found, add_special_tokens=False)]


@pytest.mark.parametrize(("name", "spaced"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_built_to_share_a_hash(name, spaced):
    """Complementary Thue-Morse pieces have equal polynomial hashes modulo any power of two."""
    enc, rnd = encoder(name, spaced), random.Random(3)
    enc.reset()
    turn = lambda n, pair: "".join(pair[bin(i).count("1") & 1] for i in range(n))
    found = []
    for n in (1024, 2048):
        for _ in range(4):
            pair = rnd.sample("abcdefghijklmnopqrstuvwxyz", 2)
            found += [f"a {turn(n, pair)} b", f"a {turn(n, pair[::-1])} b"]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    wanted = [e.ids for e in library.encode_batch(found, add_special_tokens=False)]
    assert [g.tolist() for g in enc.ids([enc.safe(t) for t in found])] == wanted
    assert token_counts.count_tokens(encoder("word_bpe_49k.json", False), found) == [len(e.ids) for e in Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode_batch(found, add_special_tokens=False)]


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    from tessera.llm._common import Bytes

    monkeypatch.setattr(Bytes, "hashes", lambda self, starts, lengths: (lengths % 3).astype(np.uint64))
    enc = Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    found = [t for _, t in corpus.texts(8) if t and enc.safe(t)][:12]
    for _ in range(2):  # unknown pieces, then known ones
        assert [g.tolist() for g in enc.ids([enc.safe(t) for t in found])] == [e.ids for e in enc.library.encode_batch(found, add_special_tokens=False)]


def test_unsafe_texts_are_told_apart():
    enc = encoder("word_bpe_49k.json", False)
    assert [enc.safe(t) is None for t in ("plain é", "<|endoftext|>", "“x”", "a\x00b", "nbsp\xa0", "²")] == [False, True, True, True, True, True]


@pytest.mark.parametrize(("chunk", "overlap"), [(32, 4), (200, 16), (1 << 14, 256)])
def test_spliced_counts(chunk, overlap):
    enc = encoder("word_bpe_49k.json", False)
    texts = [t or "" for _, t in corpus.texts(4)] + ["a" * 700 + " é’ “x” 日本語 " * 50, "<|endoftext|> hi " * 40, "e\u0301 " * 200, "z" * 5000]
    assert token_counts.count_tokens(enc, texts, chunk, overlap) == [len(e.ids) for e in enc.library.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_a_table(spark):
    rows = corpus.texts(5)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    expected = corpus.normal((i, len((t or "").encode()), k, k > 2048) for (i, t), k in zip(rows, n, strict=True))
    assert corpus.normal(token_counts.counts(corpus.frame(spark, rows)).collect()) == expected
    assert token_counts.counts(corpus.frame(spark, [])).collect() == []


def check_packed(rows, found, window: int = 1024) -> int:
    """Every id of every row in one piece; returns the padding."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted: dict = defaultdict(list)
    for i, t in rows:
        wanted[i].append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    pieces: dict = defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
    for i, lists in wanted.items():
        assert sum(p["length"] for p in pieces[i]) == sum(map(len, lists))
        for p in pieces[i]:
            assert any(len(ids) == p["doc_tokens"] and crc(ids[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] for ids in lists)
        if len(lists) == 1:
            at = 0
            for p in sorted(pieces[i], key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
    padding, sequences = 0, defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append(r)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padding += window - at
    return padding


def test_packing_holds_every_token_once(spark, monkeypatch):
    rows = corpus.texts(6)
    assert check_packed(rows, packing.pack(corpus.frame(spark, rows)).collect()) < 1024
    assert packing.pack(corpus.frame(spark, [])).collect() == []


def test_neighbours_share_words():
    topics = [np.arange(100 * t, 100 * t + 100) for t in range(6)]
    rnd = np.random.default_rng(1)
    docs = [rnd.choice(topics[i % 6], 200) for i in range(60)]
    idf = np.full(1000, 1.0)
    mixed = [len({d % 6 for d, _, _ in content}) for content in packing.fill(docs, idf, 200.0, 1024)]
    assert np.mean(mixed) < 2.2


def plain_fill(docs: list[list[int]], idf, mean: float, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows by plain BM25 over few documents: the longest seeds, the best neighbours that fit, the best that doesn't is cut."""

    def score(q: int, d: int) -> float:
        tf = {t: docs[d].count(t) for t in set(docs[d])}
        norm = packing.K1 * (1 - packing.B + packing.B * len(docs[d]) / mean)
        return sum(idf[t] * tf[t] * (packing.K1 + 1) / (tf[t] + norm) for t in set(docs[q]) if t in tf)

    unused, out, seed, begin = set(range(len(docs))), [], None, 0
    longest = lambda: min(unused, key=lambda d: (-len(docs[d]), d))
    while unused or seed is not None:
        if seed is None:
            seed, begin = longest(), 0
            unused.discard(seed)
        now, room, of = [(seed, begin, len(docs[seed]))], window - (len(docs[seed]) - begin), seed
        seed = None
        near = sorted((d for d in unused if score(of, d) > 0), key=lambda d: (-score(of, d), d)) if room else []
        for d in near:
            if len(docs[d]) <= room:
                now.append((d, 0, len(docs[d])))
                room -= len(docs[d])
                unused.discard(d)
        left = [d for d in near if d in unused]
        while room and unused:
            d = left[0] if left else longest()
            unused.discard(d)
            now.append((d, 0, min(room, len(docs[d]))))
            if len(docs[d]) > room:
                seed, begin = d, room
            room -= now[-1][2]
        out.append(now)
    return out


def test_windows_against_plain_retrieval():
    rnd = np.random.default_rng(7)
    for trial in range(40):
        topics = [rnd.choice(60, 12, replace=False) for _ in range(4)]
        docs = [rnd.choice(topics[rnd.integers(0, 4)], rnd.integers(1, 60)) for _ in range(rnd.integers(1, 30))]
        idf, mean = rnd.random(60) + 0.1, float(np.mean([len(d) for d in docs]))
        assert list(packing.fill(docs, idf, mean, 64)) == plain_fill([d.tolist() for d in docs], idf, mean, 64), trial


def test_rankings_are_walked_in_order():
    score = np.random.default_rng(3).integers(0, 40, 500) / 7
    found = np.concatenate(list(packing.ranked(score)))
    assert (np.diff(score[found]) <= 0).all() and sorted(found.tolist()) == np.flatnonzero(score > 0).tolist()


def test_huge_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "STEP_BYTES", 400)
    enc = encoder("byte_bpe_50k.json", True)
    texts = [t or "" for _, t in corpus.texts(8)][:30]
    assert [x.tolist() for x in packing.encode(enc, texts)] == [[*e.ids, 0] for e in enc.library.encode_batch(texts, add_special_tokens=False)]


def shared_windows(spark, families: int, each: int = 4) -> float:
    """How many texts of small families share a sequence with another one of their family."""
    rnd, rows = random.Random(families), []
    common = [f"{w}{k}" for w in corpus.WORDS for k in range(40)]
    for f in range(families):
        own = ["".join(rnd.choice("bcdfgklmnprstv") + rnd.choice("aeiou") for _ in range(4)) for _ in range(25)]
        rows += [(f * each + k, " ".join(rnd.choice(own if rnd.random() < 0.6 else common) for _ in range(60))) for k in range(each)]
    rnd.shuffle(rows)
    held = defaultdict(set)
    for r in packing.pack(corpus.frame(spark, rows)).collect():
        held[r["doc_id"]].add(r["sequence_id"])
    family = lambda i: set().union(*(held[j] for j in range(i // each * each, i // each * each + each) if j != i))
    return sum(bool(held[i] & family(i)) for i in held) / len(held)


def test_related_texts_share_windows_at_every_size(spark, monkeypatch):
    """A shard holds about 80 texts; with 1, 4 and 16 shards and more related texts meet as often."""
    monkeypatch.setattr(packing, "SHARD_TOKENS", 16_000)
    found = [shared_windows(spark, n) for n in (20, 80, 320)]
    print("related texts that share a window, by size:", [round(x, 2) for x in found])
    assert min(found) > 0.5 and found[-1] > 0.6 * found[0]


def test_large_keys_are_dealt_on():
    """Copies and one common rare term fill no shard beyond its size, and every remainder has one shard."""
    rnd = np.random.default_rng(3)
    docs = [np.r_[5, rnd.integers(10, 200, 19)] for _ in range(400)] + [np.arange(20)] * 400
    df = np.full(200, 500)
    df[5] = 2  # by far the rarest
    idf = np.log1p((801 - df) / (df + 0.5))
    deal = packing.Dealing(packing.orders(df, idf), 1000)
    ids, at = np.concatenate(docs), np.arange(0, 16_000, 20)
    first, second = deal.keys(ids, at)
    deal.first(np.bincount(first, weights=np.full(800, 20), minlength=200).astype(np.int64))
    part = deal.part(first, second)
    deal.second(np.bincount(part[part >= 0], minlength=int(deal.parts.sum())) * 20)
    shard = deal.shard_of(first, second, np.arange(800))
    assert (shard >= 0).all() and np.bincount(shard).max() * 20 <= 2000 and len(np.unique(shard)) >= 16


def test_all_terms_of_a_seed_count():
    """A seed with many rare terms of its own finds the texts that share its other terms."""
    rare = np.arange(1000, 1030)
    docs = [np.r_[rare, np.arange(0, 20), np.full(60, 999)]] + [np.r_[np.arange(100 * (i % 5), 100 * (i % 5) + 20), np.full(80, 999)] for i in range(1, 100)]
    idf = np.full(1100, 2.0)
    idf[rare], idf[999] = 7.0, 0.01
    assert {d % 5 for d, _, _ in next(packing.fill(docs, idf, 100.0, 500))} == {0}


def test_short_texts_fill_windows_down_the_ranking():
    """51 texts of 20 tokens fit a window: the ranking is walked on beyond its first step."""
    docs = [np.arange(50 * (i % 3), 50 * (i % 3) + 20) for i in range(300)]
    content = list(packing.fill(docs, np.full(200, 1.0), 20.0, 1024))
    assert sum(len({d % 3 for d, _, _ in c}) == 1 for c in content) >= len(content) - 3
