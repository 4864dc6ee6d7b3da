"""Benchmark decontamination by q-gram lemma filtering with banded alignment.

Items and texts are folded (lower case; every run of characters that are neither letters nor digits of any script is
one blank) and compared as UTF-8 bytes. An item of m bytes within e = floor(EDIT_SHARE * m) edits of a region of a text
shares at least m + 1 - q - q * e of its q-grams with it, all within a band of 2 * e + 1 diagonals. Hits are counted
for each text and item in bands three strips of e + 1 diagonals wide, each overlapping the next by two strips, so one
band holds every such region whole; bands that reach the bound are retained, and a banded alignment verifies them and
gives the region's edits and bounds. q is chosen for each item so that the bound is positive: the filter loses no
region.

Items are sent to executors only in slices of at most SLICE_BYTES of text; a larger benchmark is taken in several
slices, each against all texts. Texts are worked on whole, long ones in parts that overlap by two items' length.

Edge cases: null and empty texts hold nothing; null, empty or folded-to-nothing items match nothing. Items shorter than
LEAST_BYTES are too short for edits: they match where their words stand whole and unchanged in a text. Those of fewer
than `least` bytes would be everywhere by chance (LEAST_BYTES, where nothing else is said) and match only a text that is
nothing else; with `least` = 0 there are none. Items and texts that are repeated each give their own rows,
one for each pair of row ids; the best region (fewest edits, then first) is shown. Null ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._common import ready, steps, utf8

EDIT_SHARE = 0.1
LEAST_BYTES, LEAST_Q, MOST_Q = 24, 4, 12
SLICE_BYTES = 4 << 20
PART = 1 << 20
FILTER_BITS = 22

#: Folding of single bytes: ASCII letters to lower case, digits and bytes beyond ASCII as they are, all else a blank.
FOLD = np.full(256, 32, np.uint8)
FOLD[48:58], FOLD[97:123], FOLD[65:91], FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)
#: The characters of Latin-1 beyond ASCII that are neither letters nor digits.
SIGN = np.array([c >= 128 and not chr(c).isalnum() for c in range(256)])
#: The first byte of a character beyond Latin-1 is this or higher.
BEYOND = 0xC4
_BLANK = re.compile(r"[\W_]+")


def unicode_fold(text: bytes) -> bytes:
    return _BLANK.sub(" ", text.decode().lower()).encode()


def fold(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of many texts, and where each begins: by bytes, texts with characters beyond Latin-1 as they are read."""
    beyond = np.unique(np.searchsorted(offsets, np.flatnonzero(data >= BEYOND), "right") - 1)
    if not len(beyond):
        return latin_fold(data, offsets)
    parts, lengths, at = [], [], 0
    for r in [*beyond.tolist(), len(offsets) - 1]:
        part, bounds = latin_fold(data[offsets[at] : offsets[r]], offsets[at : r + 1] - offsets[at])
        parts.append(part)
        lengths.append(np.diff(bounds))
        if r < len(offsets) - 1:
            parts.append(np.frombuffer(unicode_fold(data[offsets[r] : offsets[r + 1]].tobytes()), np.uint8))
            lengths.append(np.array([len(parts[-1])]))
        at = r + 1
    return np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(lengths))]


def latin_fold(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts without characters beyond Latin-1."""
    out = FOLD[data]
    lead = np.flatnonzero(data >= 0xC2)  # two bytes a character, the second with its low six bits
    if len(lead):
        char = (data[lead] & 3) << 6 | data[lead + 1] & 63
        sign = SIGN[char]
        out[lead[sign]] = out[lead[sign] + 1] = 32
        out[lead[(char >= 0xC0) & (char <= 0xDE) & ~sign] + 1] += 0x20
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    keep[offsets[:-1][np.diff(offsets) > 0]] = True  # a text begins anew, whatever stands before it
    return out[keep], np.r_[0, np.cumsum(keep)][offsets]


def fold_text(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(fold(raw, np.array([0, len(raw)]))[0].tobytes().strip(), np.uint8)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q-gram, its high bits well spread."""
    n = len(chars) - q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(q if n > 0 else 0):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += chars[i : i + n]
        out += np.uint64(1)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def plan(length: int) -> tuple[int, int, int] | None:
    """(q, edits, least shared q-grams) for an item of so many bytes; None if it is too short."""
    if length < LEAST_BYTES:
        return None
    edits = int(EDIT_SHARE * length)
    for q in range(MOST_Q, LEAST_Q - 1, -1):
        if (least := length + 1 - q - q * edits) >= 3:
            return q, edits, least
    return None


class Index:
    """The q-grams of one slice of items, one table for each q."""

    def __init__(self, items: list[tuple[object, str]], least: int = LEAST_BYTES):
        self.items = []
        self.short: dict[bytes, list[int]] = {}
        self.words: dict[int, dict[bytes, list[int]]] = {}
        by_q: dict[int, list] = {}
        for key, text in items:
            chars = fold_text(text)
            if p := plan(len(chars)):
                by_q.setdefault(p[0], []).append((grams(chars, p[0]), len(self.items)))
                self.items.append((key, chars, *p))
            elif len(chars):
                known = self.short if len(chars) < least else self.words.setdefault(len(chars), {})
                known.setdefault(chars.tobytes(), []).append(len(self.items))
                self.items.append((key, chars, 0, 0, 1))
        self.edits = np.array([x[3] for x in self.items], np.int64)
        self.least = np.array([x[4] for x in self.items], np.int64)
        self.reach = 2 * max((len(x[1]) for x in self.items), default=0)
        self.longest_short = max(map(len, self.short), default=0)
        self.tables = {}
        for q, found in by_q.items():
            h = np.concatenate([g for g, _ in found])
            item = np.repeat([i for _, i in found], [len(g) for g, _ in found])
            at = np.concatenate([np.arange(len(g)) for g, _ in found])
            order = np.argsort(h, kind="stable")
            flags = np.zeros(1 << FILTER_BITS, bool)
            flags[h >> np.uint64(64 - FILTER_BITS)] = True
            self.tables[q] = h[order], item[order], at[order], flags

    def bands(self, chars: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, lowest diagonal, highest diagonal) of the bands that reach the bound."""
        found: list[tuple[int, int, int, int]] = []
        for q, (known, item, at, flags) in self.tables.items():
            g = grams(chars, q)
            place = np.flatnonzero(flags[g >> np.uint64(64 - FILTER_BITS)])
            lo, hi = np.searchsorted(known, g[place]), np.searchsorted(known, g[place], "right")
            row = np.searchsorted(bounds, place, "right") - 1
            n = np.where(place + q <= bounds[np.minimum(row + 1, len(bounds) - 1)], hi - lo, 0)
            if not n.sum():
                continue
            k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            of, rows = item[k], np.repeat(row, n)
            pair = rows * len(self.items) + of
            pairs = len(self.items) * (len(bounds) - 1)
            if pairs <= 1 << 22:  # a band has no more hits than its text
                some = np.bincount(pair, minlength=pairs)[pair] >= self.least[of]
            else:
                _, inverse, total = np.unique(pair, return_inverse=True, return_counts=True)
                some = total[inverse] >= self.least[of]
            if not some.any():
                continue
            of, rows, pair = of[some], rows[some], pair[some]
            width = self.edits[of] + 1
            diagonal = np.repeat(place, n)[some] - bounds[rows] - at[k[some]]
            strip = (diagonal + self.reach) // width
            far = int(strip.max()) + 3
            spot = pair * far + strip
            order = np.argsort(spot, kind="stable")
            spot, position, diagonal = spot[order], at[k[some]][order], diagonal[order]
            first = np.unique(np.concatenate([spot, spot - 1, spot - 2]))  # each starts a band of three strips
            a, b = np.searchsorted(spot, first), np.searchsorted(spot, first + 3)
            owner = first // far % len(self.items)
            for c in np.flatnonzero(b - a >= self.least[owner]):
                i = int(owner[c])
                near = np.sort(diagonal[a[c] : b[c]])
                if (np.searchsorted(near, near + 2 * self.edits[i], "right") - np.arange(len(near))).max() < self.least[i]:
                    continue  # no 2 * edits + 1 diagonals of the band reach the bound
                if len(np.unique(position[a[c] : b[c]])) >= self.least[i]:  # an item's q-gram counts once
                    low = int(first[c] % far) * int(self.edits[i] + 1) - self.reach
                    found.append((int(first[c] // far // len(self.items)), i, low, low + 3 * int(self.edits[i] + 1) - 1))
        wide = None
        for band in sorted(found):  # bands of one text and item that touch are verified as one, up to a few of them
            if wide and wide[:2] == band[:2] and band[2] <= wide[3] + 1 and band[3] - wide[2] < 12 * int(self.edits[band[1]] + 1):
                wide = (*wide[:3], band[3])
            else:
                if wide:
                    yield wide
                wide = band
        if wide:
            yield wide

    def whole_words(self, chars: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item, place) of short items whose words stand whole in a text; each length is one pass over the words' beginnings."""
        blank = chars == 32
        begins = ~blank & np.r_[True, blank[:-1]][: len(blank)]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        begin = np.flatnonzero(begins & ~blank)
        row = np.searchsorted(bounds, begin, "right") - 1
        for length, items in self.words.items():
            end = begin + length
            fits = np.flatnonzero(end <= bounds[row + 1])
            fits = fits[(end[fits] == bounds[row[fits] + 1]) | blank[np.minimum(end[fits], len(chars) - 1)]]
            mark = np.zeros(len(fits), np.uint64)
            for i in range(length):
                mark = mark * np.uint64(0x9E3779B97F4A7C15) + chars[begin[fits] + i] + np.uint64(1)
            own = np.frombuffer(b"".join(items), np.uint8).reshape(-1, length)
            marks = np.zeros(len(own), np.uint64)
            for i in range(length):
                marks = marks * np.uint64(0x9E3779B97F4A7C15) + own[:, i] + np.uint64(1)
            for k in fits[np.isin(mark, marks)].tolist():
                for i in items.get(chars[begin[k] : end[k]].tobytes(), ()):
                    yield int(row[k]), i, int(begin[k])

    def verify(self, i: int, chars: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
        """Banded alignment of a whole item with any region on diagonals low..high: (edits, start, end), or None."""
        _, item, _, most, _ = self.items[i]
        begin = max(0, low)
        whole = chars[begin : max(begin, high + len(item))].tobytes().find(item.tobytes())
        if whole >= 0:  # nothing has fewer edits than none
            return 0, begin + whole, begin + whole + len(item)
        width = high - low + 1
        far = len(item) + width + 1
        diagonals = np.arange(low, high + 1)
        cost = np.where((diagonals >= 0) & (diagonals <= len(chars)), 0, far)  # a region may start anywhere
        since = diagonals.copy()
        for row in range(1, len(item) + 1):
            column = diagonals + row
            inside = (column >= 1) & (column <= len(chars))
            same = np.zeros(width, bool)
            same[inside] = chars[column[inside] - 1] == item[row - 1]
            new = np.where(inside, cost + ~same, far)
            start = since.copy()
            start[:-1] = np.where((better := cost[1:] + 1 < new[:-1]), since[1:], since[:-1])  # the item's byte is missing in the text
            new[:-1] = np.where(better, cost[1:] + 1, new[:-1])
            new = np.where((column >= 0) & (column <= len(chars)), new, far)
            # runs of added characters: the least of new[j] + (k - j) over j <= k
            lead = new - np.arange(width)
            best = np.minimum.accumulate(lead)
            source = np.maximum.accumulate(np.where(lead == best, np.arange(width), 0))
            cost, since = best + np.arange(width), start[source]
            if cost.min() > most:
                return None
        k = int(cost.argmin())
        return (int(cost[k]), int(since[k]), int(diagonals[k] + len(item))) if cost[k] <= most else None


def search(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, start, end): the best region of each item in each row."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    folded, bounds = fold(data, offsets)
    parts = [(r, a, min(b, a + PART + index.reach)) for r, (lo, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) for a in range(lo, max(b, lo + 1), PART)]
    cut = [0, *(k for k in range(1, len(parts)) if parts[k][1] != parts[k - 1][2]), len(parts)]
    for a, b in zip(cut, cut[1:], strict=False):  # neighbours without overlap are searched together
        base = parts[a][1]
        for row, i, low, high in index.bands(folded[base : parts[b - 1][2]], np.array([p[1] - base for p in parts[a:b]] + [parts[b - 1][2] - base])):
            r, begin, end = parts[a + row]
            if found := index.verify(i, folded[begin:end], low, high):
                shift = begin - int(bounds[r])
                found = found[0], found[1] + shift, found[2] + shift
                best[r, i] = min(best.get((r, i), found), found)
    if index.words:
        for r, i, at in index.whole_words(folded, bounds):
            at -= int(bounds[r])
            best.setdefault((r, i), (0, at, at + len(index.items[i][1])))
    if index.short:
        length = np.diff(bounds)
        for r in np.flatnonzero((length > 0) & (length <= index.longest_short + 2)).tolist():
            chars = folded[bounds[r] : bounds[r + 1]].tobytes()
            for i in index.short.get(chars.strip(b" "), ()):
                best[r, i] = 0, (at := len(chars) - len(chars.lstrip(b" "))), at + len(index.items[i][1])
    return [(*k, *v) for k, v in best.items()]


def slices_of(benchmark: DataFrame, item_column: str, item_text: str) -> Iterator:
    """The items in broadcast lists of about SLICE_BYTES."""
    spark = ready(benchmark.sparkSession)
    sized = benchmark.select(F.col(item_column).alias("item"), F.col(item_text).alias("words")).where("words is not null and words <> ''")
    slices = max(1, -(-int(sized.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // SLICE_BYTES))
    if slices > 1:  # rows of a slice lie together, so the benchmark is shuffled once and each slice reads its own
        sized = sized.withColumn("slice", F.pmod(F.xxhash64("words"), F.lit(slices))).repartitionByRange(slices, "slice").checkpoint()
    for k in range(slices):
        some = (sized.where(F.col("slice") == k).drop("slice") if slices > 1 else sized).orderBy("item", "words").collect()
        yield spark.sparkContext.broadcast([(r["item"], r["words"]) for r in some])


def found_in(index: Index, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """search() over a column of texts."""
    data, offsets = utf8(texts)
    return [(r + i, *x) for i, j in steps(offsets, PART) for r, *x in search(index, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])] if index.items else []


def matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", least: int = LEAST_BYTES) -> DataFrame:
    """(id, item, edits, start, end): each text that holds an item, with the best region (places in the folded text)."""
    if id_column == item_column:
        raise ValueError(f"texts and items have the same id column {id_column}; rename one of them")
    kind, item_kind = docs.schema[id_column].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, `{item_column}` {item_kind}, edits int, start long, end long"
    source = docs.select(F.col(id_column), F.col(text_column).alias("__text"))
    items_type = to_arrow_type(benchmark.schema[item_column].dataType)
    out = None
    for shared in slices_of(benchmark, item_column, item_text):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, least)
            for batch in batches:
                which, item, *rest = list(zip(*found_in(index, batch.column(1)), strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(which, pa.int64())), pa.array([index.items[i][0] for i in item], items_type), *(pa.array(c, t) for c, t in zip(rest, (pa.int32(), pa.int64(), pa.int64()), strict=True))],
                    [id_column, item_column, "edits", "start", "end"],
                )

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def without(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text", least: int = LEAST_BYTES) -> DataFrame:
    """The rows of docs whose text holds no item, in the same columns: one pass, judged row by row, whatever their ids."""
    at = docs.columns.index(text_column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for shared in slices_of(benchmark, item_column, item_text):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, least)
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[r for r, *_ in found_in(index, batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
