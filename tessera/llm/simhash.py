"""SimHash near-duplicate groups by exact tiled comparison.

1. Each text becomes one fingerprint of 64 bits or a multiple (Python workers, whole Arrow buffers).
2. Distinct fingerprints are dealt into tiles by population count, hashed evenly within a count that fills several.
   Two fingerprints at most `radius` bits apart have population counts at most `radius` apart, so only such pairs of
   tiles meet. A tile is as large as keeps all cores busy, up to TILE, so a fingerprint is sent about
   sqrt(8 * cores) times and not once for every 4096 others.
3. Two tiles are compared block by block, ordered by population count, with exclusive-or and bit counts; blocks
   whose counts differ beyond the radius are skipped. A pair of tiles returns a spanning forest of the links it
   finds, at most one row a fingerprint: a group of n near copies never gives n * n rows.
4. Large-star and small-star rounds turn the forests into stars; each round is checkpointed to the shared folder.
   Nodes with more than a fair share of all edges are at most as many as there are partitions; the rows of these
   alone are spread by a salt, so no star's centre lands in one task.

With `similar` a link also needs an exact Jaccard similarity of the sets of different shingles, and no tiles are made: sets
that are similar share shingles. Sets that miss more of theirs in all other rows than the similarity allows go first
(`hopeful`), the others are grouped by their rarest shared shingles (`groups_of`, see `signature_tree`); no link leaves a
group. Each group is dealt to tasks of bounded size (a large one as pairs of its parts, by size), where fingerprints
within the radius are candidates, every candidate whose ends aren't joined yet is verified by the sets, and step 4 is
repeated over verified links. So only groups are compared pair by pair, and the rest grows with the shingles.

Copies share a fingerprint, so a hot group is one row from step 2 on. The driver sees a histogram of population
counts and a few numbers a round. Without `similar` comparisons grow with the square of the distinct fingerprints (that is
the method); tiles of bounded size bound memory.

Edge cases: null, empty and blank texts have fingerprint 0 and are linked like any other. Rows with equal ids are
kept, one result each. A null id takes part and gets its group's id, which is null only if the group has no id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import mix, partitions, ragged, ready, steps, utf8, word_spans, written

SEED = 42
#: Most fingerprints of a tile; fewer than LEAST_TILE are not worth a tile of their own.
TILE, LEAST_TILE = 1 << 19, 1 << 12
#: Fingerprints of either side that one vectorised step compares.
LEFT, RIGHT = 256, 512
#: Hashes whose bits are summed up at once: each takes 64 bytes, and 512 while they are added.
SUMMED = 1 << 14
#: Texts, and bytes of them, that one part of a group of candidates holds.
PART_ROWS, PART_BYTES = 1 << 13, 6 << 20
#: Rows that a key may have at least before it counts as hot.
FAIR = 256
#: Sets of this many shingles or more are counted at the root by a fixed part of all shingles alone.
LARGE = 64
#: Chosen sets (about 40 MB) that are sent to every executor, so that other texts stay where they are; more are joined by shuffle.
BROADCAST_SETS = 1 << 20
#: Text whose shingles are made at once; a longer one stands alone.
TEXT_BYTES = 1 << 18
#: Settings for near copies by distinct five-word shingles of Jaccard similarity 4 / 5 or more. By calculation such a
#: pair differs in 38.8 of 256 bits on average (standard deviation 5.7), one of four against five shingles in 48 (6.2):
#: 72 bits leave out some pairs of the shortest texts, 1 in 10,000. Unrelated texts are 128 bits apart (8). Links within the
#: radius are candidates, each is verified.
NEAR = {"words": 5, "parts": 4, "radius": 72, "similar": (4, 5)}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_spans(words_of_row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word and row of every shingle; a row of fewer words is one shingle."""
    n = len(words_of_row)
    begin = np.flatnonzero(np.r_[True, words_of_row[1:] != words_of_row[:-1]]) if n else np.zeros(0, np.int64)
    count = np.diff(np.r_[begin, n])
    first = ragged(begin, np.maximum(count - size + 1, 1))
    rows = np.repeat(words_of_row[begin], np.maximum(count - size + 1, 1))
    last = first + np.repeat(np.minimum(count, size), np.maximum(count - size + 1, 1)) - 1
    return first, last, rows


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 and row of every shingle, in order."""
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = ends - starts + 1  # with one space after each word
    joined = _LOWER[data[np.minimum(ragged(starts, lengths), len(data) - 1)]]
    after = np.cumsum(lengths)
    joined[after - 1] = 32
    joined = joined.tobytes()
    first, last, shingle_rows = shingle_spans(rows, words)
    begin, end = (after - lengths)[first], (after - 1)[last]
    digest = xxhash.xxh64_intdigest
    hashes = np.zeros(len(first), np.uint64)
    for i in range(0, len(first), 1 << 18):  # a huge text in parts
        j = min(len(first), i + (1 << 18))
        hashes[i:j] = [digest(joined[a:b], SEED) for a, b in zip(begin[i:j].tolist(), end[i:j].tolist(), strict=True)]
    return hashes, shingle_rows


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every row's different shingles, ordered by row and hash."""
    hashes, rows = shingle_hashes(data, offsets, words)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[keep], rows[keep]


def majority(hashes: np.ndarray, rows: np.ndarray, n: int, parts: int) -> np.ndarray:
    """One fingerprint of 64 * parts bits for each of n rows: a bit is 1 if over half of the row's hashes have it.

    The first 64 bits are of the hashes, each further 64 of a mix of them.
    """
    total, count = np.zeros((n, 64 * parts), np.int64), np.zeros(n, np.int64)
    for i in range(0, len(hashes), SUMMED):  # a huge text is summed up in parts
        j = min(len(hashes), i + SUMMED)
        at = np.flatnonzero(np.r_[True, rows[i + 1 : j] != rows[i : j - 1]])
        mine = rows[i:j][at]
        for k in range(parts):
            of = mix(hashes[i:j] + np.uint64(k * 0xD6E8FEB86659FD93 % (1 << 64))) if k else hashes[i:j]
            bits = np.unpackbits(of.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            total[mine, 64 * k : 64 * k + 64] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
        count[mine] += np.diff(np.r_[at, j - i])
    return np.packbits(2 * total > count[:, None], axis=1).view(">u8").reshape(-1, parts).astype(np.uint64)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, words: int, parts: int = 1) -> np.ndarray:
    """One fingerprint a row, over all its shingles."""
    return majority(*shingle_hashes(data, offsets, words), len(offsets) - 1, parts)


def share_of(similar: tuple[int, int]) -> int:
    """A share for `some_of` of which over half must be missing before a set's allowance is used up."""
    p, q = similar
    return max(1, 3 * q // (5 * (q - p)))


def some_of(hashes: np.ndarray, size: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of small sets and each share-th one of all shingles of large ones, and how many each set has."""
    of = np.repeat(np.arange(len(size)), size)
    taken = (size[of] < LARGE) | (hashes % np.uint64(share) == 0)
    return hashes[taken], np.bincount(of[taken], minlength=len(size))


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int, parts: int, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One fingerprint a row over its different shingles, a 64-bit hash of their set, its size, and `some_of` its shingles."""
    hashes, rows = distinct_shingles(data, offsets, words)
    content = np.zeros(len(offsets) - 1, np.uint64)
    at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
    if len(at):
        content[rows[at]] = np.add.reduceat(mix(hashes ^ np.uint64(0xA0761D6478BD642F)), at)
    size = np.bincount(rows, minlength=len(content))
    return majority(hashes, rows, len(offsets) - 1, parts), content, size.astype(np.int32), *some_of(hashes, size, share)


def shingled(batches: Iterator[pa.RecordBatch], column: int, words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of batches with the different shingles of their texts and how many each has."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        for i, j in steps(offsets, TEXT_BYTES):
            hashes, rows = distinct_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
            yield batch.slice(i, j - i), hashes, np.bincount(rows, minlength=j - i)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values.view(np.int64)))


def print_lists(prints: np.ndarray) -> pa.ListArray:
    parts = prints.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, prints.size + 1, parts, dtype=np.int32)), pa.array(prints.view(np.int64).ravel()))


def fingerprints(docs: DataFrame, words: int = 4, parts: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, print): the fingerprint as signed longs."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found = [np.zeros((0, parts), np.uint64), *(fingerprints_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words, parts) for i, j in steps(offsets))]
            yield pa.RecordBatch.from_arrays([batch.column(0), print_lists(np.concatenate(found))], ["id", "print"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"id {kind}, print array<long>")


def shingle_sets(docs: DataFrame, words: int, parts: int, text_column: str, share: int) -> DataFrame:
    """The rows with their fingerprint over different shingles, a hash of their set, its size and `some_of` it, in the columns
    print, content, size, some."""
    ready(docs.sparkSession)
    names = docs.columns
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            none = (np.zeros((0, parts), np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int64))
            found = [none, *(sets_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words, parts, share) for i, j in steps(offsets))]
            prints, content, size, some, taken = (np.concatenate(x) for x in zip(*found, strict=True))
            columns = [*batch.columns, print_lists(prints), pa.array(content.view(np.int64)), pa.array(size), lists(some, taken)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "print", "content", "size", "some"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, print array<long>, content long, size int, some array<long>")


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b at most `radius` bits apart.

    Only pairs near in the first half are compared in the rest, unless most pairs are that near in it.
    """
    half = (a.shape[1] + 1) // 2
    apart = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0])
    for k in range(1, half):
        apart += np.bitwise_count(a[:, None, k] ^ b[None, :, k])
    if radius >= 26 * half and half < a.shape[1] <= 4:
        rest = np.bitwise_count(a[:, None, half] ^ b[None, :, half])
        for k in range(half + 1, a.shape[1]):
            rest += np.bitwise_count(a[:, None, k] ^ b[None, :, k])
        near = apart <= radius  # the sum of both halves may be 256, which is 0 in a byte
        rest += apart
        near &= rest <= radius
        return np.nonzero(near)
    u, v = np.nonzero(apart <= radius)
    if half < a.shape[1]:
        near = np.bitwise_count(a[u] ^ b[v]).sum(1, dtype=np.int64) <= radius
        u, v = u[near], v[near]
    return u, v


class Tile:
    """Fingerprints ordered by population count, with their nodes and the sizes of their sets (0 where they don't matter)."""

    def __init__(self, nodes: np.ndarray, prints: np.ndarray, sizes: np.ndarray):
        pops = np.bitwise_count(prints).sum(1, dtype=np.int64)
        order = np.argsort(pops, kind="stable")
        self.nodes, self.prints, self.sizes, self.pops = nodes[order], prints[order], sizes[order], pops[order]


def linked(a: Tile, b: Tile, radius: int, similar: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or in one, given twice): (node, smallest of its group here)."""
    nodes, place = np.unique(np.concatenate([a.nodes, b.nodes]), return_inverse=True)
    left, right = place[: len(a.nodes)], place[len(a.nodes) :]
    label = np.arange(len(nodes))
    us, vs, held = [], [], 0
    for i in range(0, len(left), LEFT):
        block = a.prints[i : i + LEFT]
        low = np.searchsorted(b.pops, a.pops[i] - radius)
        high = np.searchsorted(b.pops, a.pops[min(i + LEFT, len(left)) - 1] + radius, "right")
        for j in range(max(low, i) if a is b else low, high, RIGHT):
            u, v = near_pairs(block, b.prints[j : min(j + RIGHT, high)], radius)
            u, v = u + i, v + j
            if similar and len(u):
                small, large = np.minimum(a.sizes[u], b.sizes[v]), np.maximum(a.sizes[u], b.sizes[v])
                hope = (small > 0) & (similar[1] * small >= similar[0] * large)
                u, v = u[hope], v[hope]
            u, v = left[u], right[v]
            apart = label[u] != label[v]
            if apart.any():
                us.append(u[apart])
                vs.append(v[apart])
                held += len(us[-1])
                if held > 1 << 18:  # fold links into labels: memory stays bounded in a dense tile
                    settle(label, np.concatenate(us), np.concatenate(vs))
                    us, vs, held = [], [], 0
    if held:
        settle(label, np.concatenate(us), np.concatenate(vs))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def settle(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Lowers labels until both ends of every link agree. Only roots move, so what labels have joined before stays joined."""
    while True:
        of_u, of_v = label[u], label[v]
        if np.array_equal(of_u, of_v):
            return
        low = np.minimum(of_u, of_v)
        np.minimum.at(label, of_u, low)
        np.minimum.at(label, of_v, low)
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def tiling(sizes: dict[int, int], most: int, radius: int, tile: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """For each population count 0..most: its first tile, its tiles, and the first and last tile that its tiles meet.

    Neighbouring counts share a tile until it is full; a count with more rows has several tiles.
    """
    first, many, held = [], [], 0
    ends: dict[int, list[int]] = {}  # the counts in each tile
    n = -1
    for pop in range(most + 1):
        size = sizes.get(pop, 0)
        if n < 0 or held + size > tile:
            n, held = n + 1, 0
        first.append(n)
        many.append(max(1, -(-size // tile)))
        for t in range(n, n + many[-1]):
            ends.setdefault(t, []).append(pop)
        if many[-1] > 1:
            n, held = n + many[-1] - 1, tile
        else:
            held += size
    low, high = [], []
    for pop in range(most + 1):
        mine = [p for t in range(first[pop], first[pop] + many[pop]) for p in (min(ends[t]), max(ends[t]))]
        low.append(first[max(0, min(mine) - radius)])
        top = min(most, max(mine) + radius)
        high.append(first[top] + many[top] - 1)
    return first, many, low, high


def links(prints: DataFrame, radius: int, similar: tuple[int, int] | None = None) -> DataFrame:
    """(u, v) with v < u: forests of the nodes at most `radius` bits apart. prints: distinct (node, print, size), written."""
    spark = prints.sparkSession
    pops = F.aggregate("print", F.lit(0), lambda n, x: n + F.bit_count(x))
    counted = prints.withColumn("pop", pops)
    seen = counted.groupBy("pop").agg(F.count("*").alias("n"), F.max(F.size("print")).alias("parts")).collect()
    sizes, parts = {r["pop"]: r["n"] for r in seen}, max((r["parts"] for r in seen), default=1)
    total = sum(sizes.values())
    tile = min(TILE, max(LEAST_TILE, -(-total // math.ceil(math.sqrt(8 * spark.sparkContext.defaultParallelism)))))
    tiles_of = tiling(sizes, 64 * parts, radius, tile)
    many_tiles = tiles_of[0][-1] + tiles_of[1][-1]
    n = max(1, min(partitions(spark), many_tiles * (many_tiles + 1) // 2))
    first, many, low, high = (F.array(*map(F.lit, x))[F.col("pop")] for x in tiles_of)
    dealt = counted.select("node", "print", "size", (first + F.pmod(F.xxhash64("print"), many).cast("int")).alias("tile"), low.alias("low"), high.alias("high"))

    def pack(table: pa.Table) -> pa.Table:
        blob = lambda values: pa.array([values.tobytes()], pa.binary())
        prints = table.column("print").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        bounds = [pa.array([f(table.column(c)).as_py()], pa.int32()) for c, f in (("tile", pc.min), ("low", pc.min), ("high", pc.max))]
        return pa.table([*bounds, blob(table.column("node").to_numpy()), blob(prints), blob(table.column("size").to_numpy())], ["tile", "low", "high", "nodes", "prints", "sizes"])

    tiles = dealt.groupBy("tile").applyInArrow(pack, "tile int, low int, high int, nodes binary, prints binary, sizes binary")
    meet = F.sequence("low", F.greatest("high", "tile"))
    pairs = tiles.withColumn("other", F.explode(meet)).select(F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "nodes", "prints", "sizes")

    def tile_of(nodes: bytes, words: bytes, counts: bytes) -> Tile:
        return Tile(np.frombuffer(nodes, np.int64), np.frombuffer(words, np.uint64).reshape(-1, parts), np.frombuffer(counts, np.int32))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            for i in range(len(batch)):
                pair = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                mine = tile_of(*(batch.column(k)[i].as_py() for k in (3, 4, 5)))
                if pair[0] != pair[1] and now != pair:
                    now, held = pair, mine  # the other one follows
                    continue
                u, v = linked(mine if pair[0] == pair[1] else held, mine, radius, similar)
                now, held = None, None
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.repartition(n, "a", "b").sortWithinPartitions("a", "b", "tile").mapInArrow(compare, "u long, v long").where("u <> v")


def spread_join(rows: DataFrame, by_key: DataFrame, key: list[str], total: int, largest: int) -> DataFrame:
    """rows joined to by_key (one row a key, n: how many of rows have it) without a task for a hot key.

    Keys with more than a fair share of all `total` rows are at most as many as partitions; the driver learns their
    hashes, their rows are spread by a salt, and their row in by_key is repeated once for each salt.
    """
    fair = max(FAIR, total // partitions(rows.sparkSession))
    if largest <= fair:
        return rows.join(by_key.drop("n"), key)
    hash_of = F.xxhash64(*key)
    hot = hash_of.isin([r[0] for r in by_key.where(F.col("n") > fair).select(hash_of).collect()])
    salts = -(-largest // fair)
    salt = F.when(hot, F.pmod(F.xxhash64(*(c for c in rows.columns if c not in key)), F.lit(salts))).otherwise(0).cast("int")
    every = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("__salt", salt).join(by_key.drop("n").withColumn("__salt", F.explode(every)), [*key, "__salt"]).drop("__salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (u, v): large-star and small-star rounds until nothing moves."""
    turned = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    state = None
    while True:
        both = turned.unionByName(turned.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"), F.sum(F.xxhash64(F.least("u", "v"), F.greatest("u", "v")).cast("decimal(38,0)")).alias("h"))
        total, largest, check = low.agg(F.sum("n"), F.max("n"), F.sum("h")).first()
        if (total, check) == state:
            return turned.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, (total, largest) = (total, check), (total or 0, largest or 0)
        large = spread_join(both, low.drop("h"), ["u"], total, largest).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, low, ["u"], total, largest).select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
        turned = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()


def alike(ids: np.ndarray, at: np.ndarray, u: np.ndarray, v: np.ndarray, similar: tuple[int, int], mark: np.ndarray) -> np.ndarray:
    """For each pair of sets whether its Jaccard similarity is similar[0] / similar[1] or more.

    Set k is ids[at[k] : at[k + 1]]; u is sorted; mark is all False, one for each id.
    """
    size = np.diff(at)
    shared = np.zeros(len(u), np.int64)
    first = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else u
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(u)], strict=True):
        mine, others = ids[at[u[i]] : at[u[i] + 1]], v[i:j]
        mark[mine] = True
        n = size[others]
        shared[i:j] = np.add.reduceat(mark[ids[ragged(at[others], n)]], np.cumsum(n) - n, dtype=np.int64)
        mark[mine] = False
    return similar[1] * shared >= similar[0] * (size[u] + size[v] - shared)


def verified(prints: np.ndarray, ids: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, similar: tuple[int, int]) -> np.ndarray:
    """For each row the smallest one that it is joined to by verified links between rows of `left` and of `right`.

    A link whose ends are joined already says nothing new and is left out; of the others each row's are verified 1, 2,
    4, ... at a time.
    """
    label, size = np.arange(len(prints)), np.diff(at)
    mark = np.zeros(int(ids.max(initial=0)) + 1, bool)
    step = max(1, LEFT * RIGHT // max(1, len(right)))
    for i in range(0, len(left), step):
        u, v = near_pairs(prints[left[i : i + step]], prints[right], radius)
        u, v = left[u + i], right[v]
        small, large = np.minimum(size[u], size[v]), np.maximum(size[u], size[v])
        hope = (u != v) & (small > 0) & (similar[1] * small >= similar[0] * large)
        u, v, take = u[hope], v[hope], 1
        while len(u := u[apart := label[u] != label[v]]):
            v = v[apart]
            first = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
            now = np.arange(len(u)) - np.repeat(first, np.diff(np.r_[first, len(u)])) < take
            same = np.flatnonzero(now)[alike(ids, at, u[now], v[now], similar, mark)]
            if len(same):
                settle(label, u[same], v[same])
            u, v, take = u[~now], v[~now], 2 * take
    return label


def verified_links(candidates: DataFrame, texts: DataFrame, words: int, radius: int, similar: tuple[int, int], join: Callable = verified) -> DataFrame:
    """(u, v): forests of the candidate links that hold. candidates: (node, print, size, bytes, root); texts: (node, text).

    join: what finds them between two parts of a group, as `verified` does.

    A large group is parted by the sizes of its sets, in steps of the least ratio that similar sets can have, and each
    step evenly; parts of one step and of the next one meet.
    """
    ratio = math.log(similar[1] / similar[0])
    stepped = candidates.withColumn("step", F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / F.lit(ratio) + F.lit(1e-9)).cast("int"))
    per_step = stepped.groupBy("root", "step").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / PART_ROWS), F.ceil(F.col("bytes") / PART_BYTES), F.lit(1)).cast("int")
    groups = per_step.groupBy("root").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("step", parts.alias("k"))))).alias("k"))
    is_large = (F.col("n") > PART_ROWS) | (F.col("bytes") > PART_BYTES)
    groups = groups.select("root", "n", "bytes", F.when(is_large, F.col("k")).alias("k")).checkpoint()
    total, largest, n, size = (x or 0 for x in groups.agg(F.sum("n"), F.max("n"), F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.sum(F.when(F.col("k").isNull(), F.col("bytes")))).first())
    buckets = max(1, -(-n // PART_ROWS), -(-size // PART_BYTES))
    own = F.pmod(F.xxhash64("node"), F.col("k")[F.col("step")]).cast("int")
    pair = lambda step, i, j: F.struct(step.alias("step"), i.alias("i"), j.alias("j"))
    within = F.transform(F.sequence(F.lit(0), F.col("k")[F.col("step")] - 1), lambda o: pair(F.col("step"), F.least("part", o), F.greatest("part", o)))
    none = F.array().cast("array<struct<step:int,i:int,j:int>>")
    beside = lambda step, make: F.when(F.col("k")[step].isNull(), none).otherwise(F.transform(F.sequence(F.lit(0), F.coalesce(F.col("k")[step], F.lit(1)) - 1), make))
    after = beside(F.col("step") + 1, lambda o: pair(F.col("step"), F.col("part"), -1 - o))
    before = beside(F.col("step") - 1, lambda o: pair(F.col("step") - 1, o, -1 - F.col("part")))
    dealt = (
        spread_join(stepped.drop("bytes"), groups.drop("bytes"), ["root"], total, largest)
        .withColumn("part", F.when(F.col("k").isNull(), F.lit(0)).otherwise(own))
        .withColumn("key", F.when(F.col("k").isNull(), -1 - F.pmod(F.xxhash64("root"), F.lit(buckets))).otherwise(F.col("root")))
        .withColumn("meets", F.when(F.col("k").isNull(), F.array(pair(F.lit(0), F.lit(0), F.lit(0)))).otherwise(F.concat(within, after, before)))
        .withColumn("here", F.when(F.col("k").isNull(), F.lit(0)).otherwise(F.col("step")))
        .select("key", "node", "print", "part", "here", "meets")
        .join(texts, "node")
        .withColumn("meet", F.explode("meets"))
        .select("key", "meet.step", "meet.i", "meet.j", "part", "here", "node", "print", "text")
    )

    def verify(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        data, offsets = utf8(table.column("text"))
        hashes, at = [], [np.zeros(1, np.int64)]
        for i, j in steps(offsets):
            h, rows = distinct_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
            hashes.append(h)
            at.append(np.bincount(rows, minlength=j - i))
        ids = np.unique(np.concatenate(hashes), return_inverse=True)[1].astype(np.int32)
        at, prints = np.cumsum(np.concatenate(at)), table.column("print").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(offsets) - 1, -1)
        del hashes, data
        _, step, i, j = (k.as_py() for k in key)
        part, here = table.column("part").to_numpy(), table.column("here").to_numpy()
        left = np.flatnonzero((here == step) & (part == i))
        right = np.flatnonzero((here == step) & (part == j)) if j >= 0 else np.flatnonzero((here == step + 1) & (part == -1 - j))
        label = join(prints, ids, at, left, right, radius, similar)
        node, moved = table.column("node").to_numpy(), np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": pa.array(node[moved], pa.int64()), "v": pa.array(node[label[moved]], pa.int64())})

    return dealt.groupBy("key", "step", "i", "j").applyInArrow(verify, "u long, v long")


def roots_of(distinct: DataFrame, edges: DataFrame, same: list[str]) -> DataFrame:
    """(*same, n, keeper): for each distinct row the smallest keeper of its group. distinct: (*same, node, n, keeper), written."""
    roots = components(edges).withColumnRenamed("node", "of")
    placed = distinct.join(roots, F.col("node") == F.col("of"), "left").select(*same, F.col("n").alias("copies"), "keeper", F.coalesce("root", "node").alias("root")).checkpoint()
    named = placed.groupBy("root").agg(F.min("keeper").alias("least"), F.count("*").alias("n")).checkpoint()
    total, largest = (x or 0 for x in named.agg(F.sum("n"), F.max("n")).first())
    return spread_join(placed.drop("keeper"), named, ["root"], total, largest).select(*same, F.col("copies").alias("n"), F.col("least").alias("keeper")).checkpoint()


def sum_and_max(of: DataFrame) -> tuple[int, int]:
    return tuple(x or 0 for x in of.agg(F.sum("n"), F.max("n")).first())


def shingles_of(texts: DataFrame, words: int, share: int = 1) -> DataFrame:
    """(node, shingle): all shingles, or those of `some_of`. texts: (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hashes, size in shingled(batches, 1, words):
            if share > 1:
                hashes, size = some_of(hashes, size, share)
            yield pa.RecordBatch.from_arrays([part.column(0), lists(hashes, size)], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles array<long>").select("node", F.explode("shingles").alias("shingle"))


def hopeful(distinct: DataFrame, shingles: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The distinct sets that don't miss more of their shingles in all other rows than they are allowed to.

    shingles: (node, shingle) of the rows, or of a fixed part of all shingles. Rows are counted by their numbers, which
    pack well on their way, as hashes don't.
    """
    p, q = similar
    counted = shingles.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    missing = counted.where("node = last").groupBy("node").agg(F.count("*").alias("missing"))
    return distinct.join(missing, "node", "left").where(F.coalesce("missing", F.lit(0)) * q <= (q - p) * F.col("size")).drop("missing")


def groups_of(texts: DataFrame, words: int, similar: tuple[int, int]) -> DataFrame:
    """(node, root): groups that no link leaves. texts: (node, size, text), written."""
    p, q = similar
    shingles = shingles_of(texts, words)
    shared = shingles.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    found = shingles.join(shared, "shingle").join(texts.select("node", "size"), "node")
    of = W.partitionBy("node")
    missing = F.col("size") - F.count("*").over(of)
    turn = F.row_number().over(of.orderBy("n", "shingle"))
    allowed = F.floor((q - p) * F.col("size") / q)
    first = found.withColumns({"missing": missing, "turn": turn}).where(F.col("turn") <= allowed + 1 - F.col("missing")).select("node", "shingle").checkpoint()
    stars = first.groupBy("shingle").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1").checkpoint()
    edges = spread_join(first, stars, ["shingle"], *sum_and_max(stars)).select(F.col("node").alias("u"), "v").where("u <> v")
    loose = components(edges)
    return loose.unionByName(loose.select(F.col("root").alias("node"), "root").distinct())


def distinct_of(rows: DataFrame, same: list[str], node, *more) -> DataFrame:
    """One row for each fingerprint (and set): its node, how many rows have it, and the first of them: the one with the smallest id."""
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("row")))
    return rows.groupBy(*same).agg(F.count("*").alias("n"), first.alias("keeper"), *more).withColumn("node", node).checkpoint()


def verified_groups(rows: DataFrame, words: int, radius: int, similar: tuple[int, int], text_column: str) -> tuple[list[str], DataFrame]:
    """Groups of near copies. rows: (row, id, text, print, content, size, some), written."""
    same = ["print", "content"]
    distinct = distinct_of(rows, same, F.col("keeper.row"), F.max("size").alias("size"), F.max(F.coalesce(F.octet_length(text_column), F.lit(0))).alias("bytes"))
    # copies of a set are no other sets; where they are too many to be sent along they are counted too, and more sets stay
    copies = rows.select("row").join(distinct.select(F.col("node").alias("row")), "row", "left_anti").checkpoint()
    once = rows.join(F.broadcast(copies), "row", "left_anti") if copies.count() <= BROADCAST_SETS else rows
    counted = once.select(F.col("row").alias("node"), F.explode("some").alias("shingle"))
    chosen = hopeful(distinct.where("size > 0"), counted, similar).select("node", "print", "size", "bytes").checkpoint()
    few = chosen.count() <= BROADCAST_SETS
    wanted = chosen.select("node", "size")
    texts = written(rows.select(F.col("row").alias("node"), F.col(text_column).alias("text")).join(F.broadcast(wanted) if few else wanted, "node"))
    candidates = chosen.join(groups_of(texts, words, similar), "node").checkpoint()
    return same, roots_of(distinct, verified_links(candidates, texts.select("node", "text"), words, radius, similar), same)


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, parts: int = 1, id_column: str = "doc_id", text_column: str = "text", similar: tuple[int, int] | None = None
) -> DataFrame:
    """(id, fingerprint, component_id): groups of fingerprints reachable over links; its id is the smallest in it.

    parts: the fingerprint's length in 64 bits. More of them tell lower similarities apart, see NEAR.
    similar: links hold only between sets of different shingles of that Jaccard similarity (a fraction) or more.
    """
    if similar:
        rows = written(shingle_sets(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), words, parts, "text", share_of(similar)).withColumn("row", F.monotonically_increasing_id()))
        same, of = verified_groups(rows, words, radius, similar, "text")
    else:
        rows, same = fingerprints(docs, words, parts, id_column, text_column).withColumn("row", F.monotonically_increasing_id()).checkpoint(), ["print"]
        distinct = distinct_of(rows, same, F.col("print")[0] if parts == 1 else F.col("keeper.row")).withColumn("size", F.lit(0))
        of = roots_of(distinct, links(distinct, radius), same)
    shown = F.array_join(F.transform("print", lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")
    found = spread_join(rows.select("id", "row", *same), of, same, *sum_and_max(of))
    return found.select(F.col("id").alias(id_column), shown.alias("fingerprint"), F.col("keeper.id").alias("component_id"))


def first_of_each(docs: DataFrame, words: int, radius: int, parts: int, similar: tuple[int, int], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs without all but one of each group: the one with the smallest id (then the first row) stays.

    Rows are told apart as rows, so equal and null ids take nothing with them; a row without an id stays only if its
    group has none with one.
    """
    names = [F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    text, key = (f"c{docs.columns.index(c)}" for c in (text_column, id_column))
    rows = written(shingle_sets(docs.select(*names), words, parts, text, share_of(similar)).withColumns({"row": F.monotonically_increasing_id(), "id": F.col(key)}))
    same, of = verified_groups(rows, words, radius, similar, text)
    keepers = of.select(F.col("keeper.row").alias("row")).distinct()
    return rows.join(keepers, "row", "left_semi").select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))
