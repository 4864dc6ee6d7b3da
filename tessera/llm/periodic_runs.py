"""Periodic runs of words by Karp-Miller-Rosenberg naming, and texts without a run's repetitions.

A run of period q is a stretch of neighbouring words in which words q apart are equal, as long as it can be; q is its
smallest period. Runs of at least max(LEAST, TIMES * q) words are found:

1. Words get numbers, equal ones of one text the same (bytes decide). Level k + 1 names the blocks of 2**(k+1) words by
   the pairs of level k's names. A block that occurs once in its text needs no shared name, and nor do the blocks that
   begin with it, so in prose the levels empty soon.
2. A run of period q has TIMES * q - q neighbouring places that equal those q further on, so one of them is a multiple of
   that number. These places are the grid: n * ln(n) / 3 pairs of places for n words, most of which differ at once.
3. From each pair that is equal the common extension forwards and backwards is taken block by block, from the longest
   names down. Both together are the run; the smallest period of a stretch stays.

Every text is one row of one Arrow batch: nothing is shuffled, so hot sources and copies cost what others do. A worker
holds the names of about STEP_BYTES of text at a time, or of one longer text: four bytes a word and level, and as many
levels as its longest repetition has binary digits. Pairs are taken PAIRS at a time.

Edge cases: null, empty and blank texts have no words, no run, and the empty text as `collapsed`. A text that is one
word over and over is one run. Rows are independent of each other: equal and null ids and repeated rows don't matter, an
empty table gives no rows, and columns of docs keep their names and values (its own columns are runs, n_words, collapsed:
columns of these names in docs raise an error).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import distinct_spans, ragged, ready, steps, utf8, word_spans

#: A run has at least LEAST words, and TIMES its period.
LEAST, TIMES = 6, 4
#: Pairs of places that one vectorised step extends.
PAIRS = 1 << 20
#: Text that one step looks at; a longer text stands alone.
TEXT_BYTES = 1 << 20
RUN = "struct<start:long,length:long,period:long>"
WORD = r"([^\x20\x09-\x0D]+)"


def named(ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Levels of names. ids: a number for each word, equal only for equal words of one text; ends: where its text ends.

    Level k names the block of 2**k words that begins at each place; a block that is alone in its text, or crosses its
    end, has a negative name of its own. Each level has one place more, that equals none.
    """
    n = len(ids)
    alone = -np.arange(1, n + 2, dtype=np.int32)

    def ranked(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, of, count = np.unique(keys, return_inverse=True, return_counts=True)
        level = alone.copy()
        shared = count[of] > 1
        level[at[shared]] = of[shared]
        return level, at[shared]

    level, at = ranked(ids, np.arange(n))
    levels, width = [level], 1
    while len(at):
        at = at[at + 2 * width <= ends[at]]
        at = at[level[at + width] >= 0]
        if not len(at):
            break
        level, at = ranked(level[at].astype(np.int64) * (n + 1) + level[at + width], at)
        levels.append(level)
        width *= 2
    return levels


def extended(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from a and from b on are equal, and how many before them. a < b, in one text."""
    ahead, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):  # what is left is shorter than two such blocks: none above is repeated
        name, width = levels[k], 1 << k
        same = name[a + ahead] == name[b + ahead]
        ahead[same] += width
        low = a - back - width
        same = np.flatnonzero(low >= 0)
        same = same[name[low[same]] == name[b[same] - back[same] - width]]
        back[same] += width
    return ahead, back


def grid(sizes: np.ndarray, starts: np.ndarray, times: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) pairs of all texts, PAIRS at a time: each run of theirs has such a place."""
    most = sizes // times
    most[sizes < least] = 0
    texts = np.repeat(np.arange(len(sizes)), most)
    period = ragged(np.ones(len(sizes), np.int64), most)
    gap = np.maximum((times - 1) * period, least - period)
    count = (sizes[texts] - period - 1) // gap + 1
    total = np.cumsum(count)
    i = 0
    while i < len(count):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
        place = (ragged(np.zeros(j - i, np.int64), count[i:j])) * np.repeat(gap[i:j], count[i:j]) + np.repeat(starts[texts[i:j]], count[i:j])
        yield place, np.repeat(period[i:j], count[i:j])
        i = j


def runs_of(ids: np.ndarray, texts: np.ndarray, n_texts: int, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (over all words), length and period of the runs of n_texts texts, ordered by start and period.

    ids: a number for each word; texts: the text that each word is in, in order.
    """
    sizes = np.bincount(texts, minlength=n_texts)
    starts = np.cumsum(sizes) - sizes
    _, ids = np.unique(texts * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)
    levels = named(ids, np.repeat(starts + sizes, sizes))
    found = [np.zeros((3, 0), np.int64)]
    for place, period in grid(sizes, starts, times, least):
        same = levels[0][place] == levels[0][place + period]
        place, period = place[same], period[same]
        ahead, back = extended(levels, place, place + period)
        long = ahead + back + period >= np.maximum(least, times * period)
        found.append(np.unique(np.stack([(place - back)[long], (ahead + back + period)[long], period[long]]), axis=1))
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)  # a stretch is found under multiples of its period as well
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def analysed(data: np.ndarray, offsets: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """For each text: words; (rows, runs) with starts inside their texts; and the text without repetitions."""
    n = len(offsets) - 1
    begin, end, texts = word_spans(data, offsets)
    sizes = np.bincount(texts, minlength=n)
    first = np.cumsum(sizes) - sizes
    _, ids = distinct_spans(data, begin, end)
    start, length, period = runs_of(ids, texts, n, least, times)
    edges = np.zeros(len(begin) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    begin, end, of = begin[kept], end[kept], texts[kept]
    width = end - begin + 1  # with a blank after each word
    joined = data[np.minimum(ragged(begin, width), max(len(data) - 1, 0))] if len(begin) else np.zeros(0, np.uint8)
    after = np.cumsum(width)
    joined[after - 1] = 0x20
    per_text = np.cumsum(np.bincount(of, weights=width, minlength=n).astype(np.int64))
    blob = joined.tobytes()
    collapsed = [blob[a : max(a, b - 1)] for a, b in zip([0, *per_text[:-1].tolist()], per_text.tolist(), strict=True)]
    row = texts[start] if len(start) else start
    return sizes, row, np.stack([start - first[row], length, period]), collapsed


def runs(docs: DataFrame, text_column: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """docs without the text, with n_words, runs (start, length, period; by start, then period) and collapsed: its words
    without those that any run has after its first period, joined by one blank."""
    ready(docs.sparkSession)
    others = [f for f in docs.schema if f.name != text_column]
    own = {"n_words", "runs", "collapsed"}
    if clash := own & {f.name for f in others}:
        raise ValueError(f"docs may not have columns named {', '.join(sorted(clash))}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in steps(offsets, TEXT_BYTES):
                sizes, row, found, collapsed = analysed(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least, times)
                at = np.r_[0, np.cumsum(np.bincount(row, minlength=j - i))].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(x) for x in found], ["start", "length", "period"]))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(sizes), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], [*(f"c{k}" for k in range(len(others))), "n_words", "runs", "collapsed"])

    taken = docs.select(F.col(text_column).alias("text"), *(F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(others)))
    schema = "".join(f"c{k} {f.dataType.simpleString()}, " for k, f in enumerate(others)) + f"n_words long, runs array<{RUN}>, collapsed string"
    made = taken.mapInArrow(run, schema)
    return made.select(*(F.col(f"c{k}").alias(f.name) for k, f in enumerate(others)), "n_words", "runs", "collapsed")


def longest(runs: Column) -> Column:
    """The run with the greatest length; of several the one with the smallest start, then period. Null without a run."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def listed(runs: Column) -> Column:
    """A line for each run: start,length,period."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")


def with_planted_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs, every tenth text (by the checksum of its id) with a periodic end, so that there is something to find.

    Words from a on become the p words from a on over and over; a and p come from the checksum. A row without an id, or
    without words, stays as it is.
    """
    h = F.crc32(F.col(id_column).cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")

    words = F.regexp_extract_all(F.col(text_column), F.lit(WORD), 1)
    made = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.col(text_column))), F.lit(0))
    return docs.withColumn(text_column, F.when((h % 10 == 0) & F.col(text_column).isNotNull(), made).otherwise(F.col(text_column)))
