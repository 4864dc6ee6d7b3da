"""Lexical retrieval packing: windows filled with a seed document and its BM25 neighbours.

Each text becomes token ids and an end id. Its full windows stand alone; what remains (shorter than a window) is
packed. Remainders are dealt by content into shards of about SHARD_TOKENS tokens, each with an inverted index of its
own over token ids; document frequencies and the mean length come from all remainders of the corpus. In a shard the
longest unused remainder seeds a window and the best-scoring unused neighbours are added whole while they fit; the best
one left is cut to fill the window to the end, and what it has left seeds the next window. Only where no unused
remainder of the shard shares a term with the seed the longest unused one takes its place. So only a shard's last window
is padded.

Dealing: a remainder's key is its term that comes first in one random order of all terms, rare ones sooner (weighted
minhash: two remainders have the same key with the weighted Jaccard similarity of their terms, whatever the corpus'
size). Neighbouring keys fill a shard. A key too large for that is dealt by a second such key; what is too large still
holds remainders alike in both and is dealt evenly by row, so memory is bounded.

Edge cases: null and empty texts are the end id alone. Null ids and repeated rows are packed like any other row; every
row's pieces carry its id. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import STEP_BYTES, mix, ready, utf8
from ._tokens import Encoder, encoder

VOCABULARY, END = "byte_bpe_50k.json", 0
WINDOW = 1024
#: BM25's saturation and length weights.
K1, B = 1.2, 0.75
SHARD_TOKENS = 1 << 20
#: A term comes first among others in proportion to its idf to this power. Neighbours that a step of the walk down a ranking takes first.
RARE, STEP = 3, 32
#: Windows after which used documents leave the index.
DROP = 64
PIECE = "id {}, start long, length long, ids_crc32 long, doc_tokens long"

_PART = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def parts(text: str) -> Iterator[str]:
    """A huge text in parts that encode as they do in it: a blank between two letters always begins a piece."""
    at = 0
    while len(text) - at > STEP_BYTES // 2:
        m = _PART.search(text, at + STEP_BYTES // 4)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode(enc: Encoder, texts: list[str]) -> list[np.ndarray]:
    """Token ids with the end id."""
    pieces, owner = [], []
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for i, text in enumerate(texts):
        raw = enc.safe(text)
        if raw is None:
            out[i].append(enc.slow_ids(text))
        else:
            for p in parts(text) if len(text) > STEP_BYTES // 2 else (text,):
                pieces.append(raw if p is text else enc.safe(p))
                owner.append(i)
    at = 0
    while at < len(pieces):
        upto, size = at, 0
        while upto < len(pieces) and (upto == at or size + len(pieces[upto]) <= STEP_BYTES):
            size += len(pieces[upto])
            upto += 1
        for i, ids in zip(owner[at:upto], enc.ids(pieces[at:upto]), strict=True):
            out[i].append(ids)
        at = upto
    end = np.array([END], np.int32)
    return [np.concatenate([*o, end]) for o in out]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenise(docs: DataFrame, vocabulary: str, window: int, id_column: str, text_column: str) -> DataFrame:
    """Pieces: full windows without ids, and each text's remainder with its ids as little-endian bytes."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, spaced=True)
        for batch in batches:
            column, at = batch.column(1), 0
            while at < len(batch):
                texts, size, begin = [], 0, at
                while at < len(batch) and size <= STEP_BYTES // 2:
                    texts.append(column[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                rows: list[tuple] = []
                for i, ids in enumerate(encode(enc, texts)):
                    n = len(ids)
                    whole = n // window * window
                    rows += [(begin + i, s, window, crc(ids[s : s + window]), n, None) for s in range(0, whole, window)]
                    if whole < n:
                        rows.append((begin + i, whole, n - whole, None, n, ids[whole:].astype("<u2" if enc.library.get_vocab_size() <= 1 << 16 else "<u4").tobytes()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0])), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.binary())],
                    ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )

    return docs.select(id_column, text_column).mapInArrow(run, PIECE.format(kind) + ", ids binary")


class Shard:
    """An inverted index over the remainders of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(d) for d in docs])
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), lengths)
        key, tf = np.unique(owner * len(idf) + np.concatenate(docs), return_counts=True)
        owner, term = key // len(idf), key % len(idf)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[owner] / mean))
        self.terms_at = np.searchsorted(owner, np.arange(len(docs) + 1))
        self.terms = term
        by_term = np.argsort(term, kind="stable")
        self.owners, self.weights = owner[by_term], weight[by_term]
        self.post_at = np.searchsorted(term[by_term], np.arange(len(idf) + 1))
        self.idf, self.n = idf, len(docs)

    def drop(self, used: np.ndarray) -> None:
        """Leaves used documents out of the postings."""
        keep = ~used[self.owners]
        self.post_at = np.r_[0, np.cumsum(keep)][self.post_at]
        self.owners, self.weights = self.owners[keep], self.weights[keep]

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard that is still in the postings for the terms of one."""
        terms = self.terms[self.terms_at[doc] : self.terms_at[doc + 1]]
        lists = [slice(a, b) for a, b in zip(self.post_at[terms].tolist(), self.post_at[terms + 1].tolist(), strict=True) if a < b]
        if not lists:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.owners[x] for x in lists]), weights=np.concatenate([self.weights[x] for x in lists]), minlength=self.n)


def ranked(score: np.ndarray) -> Iterator[np.ndarray]:
    """Documents with a positive score, the best first, in steps that double."""
    left, step = np.flatnonzero(score > 0), STEP
    while len(left):
        if len(left) > step:
            parted = np.argpartition(-score[left], step - 1)
            now, left = left[parted[:step]], left[parted[step:]]
        else:
            now, left = left, left[:0]
        yield now[np.lexsort((now, -score[now]))]
        step *= 2


def fill(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of (document, from, to): every token of every document once, all windows full but the last."""
    index = Shard(docs, idf, mean)
    used = np.zeros(len(docs), bool)
    left, turns = np.array([len(d) for d in docs]), 0
    order = np.argsort(-left, kind="stable")
    at, seed, begin = 0, -1, 0
    while True:
        if seed < 0:
            while at < len(order) and used[order[at]]:
                at += 1
            if at == len(order):
                return
            seed, begin = int(order[at]), 0
            used[seed] = True
        now, room = [(seed, begin, len(docs[seed]))], window - (len(docs[seed]) - begin)
        turns += 1
        if turns % DROP == 0:
            index.drop(used)
        score = index.scores(seed)
        seed = -1
        score[used] = -1
        rest = np.zeros(0, np.int64)
        for near in ranked(score) if room else ():
            for d in near:
                if left[d] <= room:
                    now.append((int(d), 0, len(docs[d])))
                    used[d] = True
                    room -= left[d]
                if not room:
                    break
            rest = near[~used[near]]
            if not room or len(rest):
                break
        if room:
            while not len(rest) and at < len(order):  # no neighbour left: the longest unused one
                if not used[order[at]]:
                    rest = order[at : at + 1]
                else:
                    at += 1
            if len(rest):
                d = int(rest[0])
                used[d] = True
                if left[d] <= room:
                    now.append((d, 0, len(docs[d])))
                    room -= left[d]
                    while room and at < len(order):
                        d = int(order[at])
                        if used[d]:
                            at += 1
                            continue
                        used[d] = True
                        take = min(room, int(left[d]))
                        now.append((d, 0, take))
                        room -= take
                        if take < left[d]:
                            seed, begin = d, take
                else:
                    now.append((d, 0, int(room)))
                    seed, begin = d, int(room)
        yield now


def orders(df: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Each term's place in two random orders of the terms, rare ones sooner; a term of one document only comes last."""
    clocks = np.random.default_rng(7).exponential(size=(2, len(idf))) / np.maximum(idf, 1e-9) ** RARE
    clocks[:, df < 2] = np.inf
    return np.argsort(np.argsort(clocks, axis=1, kind="stable"), axis=1, kind="stable")


class Dealing:
    """Which shard a remainder goes to: from the tokens of each first key, and of each part of the large ones."""

    def __init__(self, order: np.ndarray, most: int):
        self.order, self.most = order, most

    def keys(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both keys of the remainders that begin at `at`."""
        return tuple(np.minimum.reduceat(order[ids], at) if len(at) else at for order in self.order)

    def first(self, tokens: np.ndarray) -> None:
        """Neighbouring keys share a shard; a key of over half a shard is dealt into parts."""
        large = tokens > self.most // 2
        held = np.where(large, 0, tokens)
        self.shard = np.where(large, -1, (np.cumsum(held) - held) // self.most)
        self.shards = int(self.shard.max(initial=-1)) + 1
        self.parts = np.where(large, -(-tokens // self.most), 0)
        self.parts_at = np.cumsum(self.parts) - self.parts

    def part(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The part of each remainder of a large key, numbered over all keys; -1 for others."""
        spread = mix(second.astype(np.uint64) + np.uint64(1)) % np.maximum(self.parts[first], 1).astype(np.uint64)
        return np.where(self.parts[first] > 0, self.parts_at[first] + spread.astype(np.int64), -1)

    def second(self, tokens: np.ndarray) -> None:
        """A part of over one and a half shards is dealt evenly."""
        self.even = np.where(tokens > self.most * 3 // 2, -(-tokens // self.most), 1)
        self.even_at = self.shards + np.cumsum(self.even) - self.even

    def shard_of(self, first: np.ndarray, second: np.ndarray, row: np.ndarray) -> np.ndarray:
        part = self.part(first, second)
        if not len(self.even):
            return self.shard[first]
        evenly = (mix(row.astype(np.uint64)) % self.even[part].astype(np.uint64)).astype(np.int64)
        return np.where(part < 0, self.shard[first], self.even_at[part] + evenly)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row a piece."""
    spark = ready(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    pieces = tokenise(docs, vocabulary, window, id_column, text_column).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    whole = pieces.where("ids is null").select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where("ids is not null")
    size = len_ids(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                df[np.unique(np.frombuffer(blob.as_py(), "<u2" if size <= 1 << 16 else "<u4"))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    n, tokens = rest.agg(F.count("*"), F.sum("length")).first()
    df = np.zeros(size, np.int64)
    counted = rest.select("ids").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    mean = (tokens or 0) / max(n, 1)
    kind_of = "<u2" if size <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(idf)
    dealing = Dealing(orders(df, idf), SHARD_TOKENS)

    def keyed(batch: pa.RecordBatch, deal: Dealing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = utf8(batch.column(batch.schema.get_field_index("ids")))
        at = offsets // np.dtype(kind_of).itemsize
        return *deal.keys(np.frombuffer(data.tobytes(), kind_of), at[:-1]), np.diff(at)

    def summed(which: Callable, many: int) -> np.ndarray:
        """Tokens of each number that `which` gives for the remainders' keys."""
        sent = spark.sparkContext.broadcast(dealing)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(many + 1, np.int64)  # the last place is for -1
            for batch in batches:
                first, second, length = keyed(batch, sent.value)
                np.add.at(total, which(sent.value, first, second), length)
            at = np.flatnonzero(total[:many])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "tokens"])

        found = rest.select("ids").mapInArrow(run, "k long, tokens long").groupBy("k").agg(F.sum("tokens").alias("tokens")).toPandas()
        out = np.zeros(many, np.int64)
        out[found["k"].to_numpy()] = found["tokens"].to_numpy()
        return out

    dealing.first(summed(lambda deal, first, second: first, size))
    many = int(dealing.parts.sum())
    dealing.second(summed(lambda deal, first, second: deal.part(first, second), many) if many else np.zeros(0, np.int64))
    dealt = spark.sparkContext.broadcast(dealing)

    def deal_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second, _ = keyed(batch, dealt.value)
            row = batch.column(batch.schema.get_field_index("row")).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dealt.value.shard_of(first, second, row), pa.int64())], [*batch.schema.names, "shard"])

    def fill_shard(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        remainders = [np.frombuffer(b, kind_of).astype(np.int64) for b in table.column("ids").to_pylist()]
        first = table.column("start").to_numpy()
        which, start, length, check, sequence, offset = ([] for _ in range(6))
        for k, content in enumerate(fill(remainders, shared.value, mean, window)):
            at = 0
            for d, a, b in content:
                which.append(d)
                start.append(int(first[d]) + a)
                length.append(b - a)
                check.append(crc(remainders[d][a:b]))
                sequence.append(((key[0].as_py() << 32) + k) * 2 + 1)
                offset.append(at)
                at += b - a
        took = table.select(["id", "doc_tokens"]).take(pa.array(which, pa.int64()))
        return pa.table({"id": took.column(0), "start": start, "length": length, "ids_crc32": check, "doc_tokens": took.column(1), "sequence_id": sequence, "offset": offset})

    packed = (
        rest.select("id", "start", "doc_tokens", "ids", "row")
        .mapInArrow(deal_out, f"id {kind}, start long, doc_tokens long, ids binary, row long, shard long")
        .groupBy("shard")
        .applyInArrow(fill_shard, PIECE.format(kind) + ", sequence_id long, offset long")
    )
    return whole.unionByName(packed).withColumnRenamed("id", id_column)


def len_ids(vocabulary: str) -> int:
    return encoder(vocabulary, spaced=True).library.get_vocab_size()
