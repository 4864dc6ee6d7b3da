"""Canonical text: newline handling, sizes and the chunker, as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Production limit; the code's own default was 4000.
CHUNK_CHARS = 10_000
#: Line ends beside the newline (vertical tab, form feed, separators, next line, line and paragraph separator).
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: White space of any script; and the same without the newline.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
BLANK = r"[\t\x0b\f\r \p{Z}\x1c-\x1f\x85]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|(?<!{SPACE}){SPACE}++\z", "")


def stripped_right(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!{SPACE}){SPACE}++\z", "")


def normalized(text: Column) -> Column:
    """One kind of newline, no white space at line ends or at either end of the text."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    return stripped(F.regexp_replace(unix, rf"(?<!{BLANK}){BLANK}++(?=\n|\z)", ""))


def line_count(text: Column) -> Column:
    """Newlines and one; 0 for an empty text."""
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def run_starts(lengths: Column, gap: int, most: int, apart: bool = False) -> Column:
    """Where runs of neighbouring pieces begin, that are joined while they have at most `most` characters, gaps included.

    Only lengths and places are folded, no text is copied. A longer piece begins a run; with `apart` it also ends it.
    """
    start = F.struct(F.lit(None).cast("int").alias("now"), F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i"))

    def step(state: Column, n: Column) -> Column:
        fits = F.coalesce(state.now + gap + n <= most, F.lit(False))
        now = F.when(fits, state.now + gap + n).when((n > most) & F.lit(apart), F.lit(None)).otherwise(n)
        return F.struct(now.cast("int").alias("now"), F.when(fits, state.starts).otherwise(F.concat(state.starts, F.array(state.i))).alias("starts"), (state.i + 1).alias("i"))

    return F.aggregate(lengths, start, step, lambda s: s.starts)


def runs(pieces: Column, joiner: str, most: int, each: Callable[[Column], Column], apart: bool = False) -> Column:
    """each(run) for the pieces of every run, in one array of texts."""

    def of(pieces: Column) -> Column:
        cut = lambda starts: F.transform(starts, lambda a, k: each(F.slice(pieces, a + 1, F.coalesce(F.get(starts, k + 1), F.size(pieces)) - a)))
        return let(run_starts(F.transform(pieces, F.length), len(joiner), most, apart), cut)

    return F.flatten(let(pieces, of))


def not_empty(texts: Column) -> Column:
    return F.filter(texts, lambda x: x != "")


def sliced(text: Column, most: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(most))
    return not_empty(F.transform(starts, lambda i: stripped(F.substring(text, i, F.lit(most)))))


def split_paragraph(paragraph: Column, most: int) -> Column:
    """A paragraph that is too long: its lines packed and stripped, or a single line cut. A long line among others is left whole."""
    whole = lambda run: F.array(stripped(F.array_join(run, "\n")))
    of = lambda lines: F.when(F.size(lines) > 1, not_empty(runs(F.transform(lines, stripped_right), "\n", most, whole))).otherwise(sliced(paragraph, most))
    return let(F.split(paragraph, LINE_END), of)


def chunks(text: Column, most: int = CHUNK_CHARS) -> Column:
    """Chunks of a canonical text: paragraphs packed up to the limit; those that are too long are split and stay apart."""
    pieces = lambda run: F.when(F.length(F.get(run, F.lit(0))) > most, split_paragraph(F.get(run, F.lit(0)), most)).otherwise(F.array(F.array_join(run, "\n\n")))
    paragraphs = lambda t: not_empty(F.transform(F.split(t, "\n\n"), stripped))
    of = lambda t: F.when(t == "", F.array(F.lit(""))).otherwise(not_empty(runs(paragraphs(t), "\n\n", most, pieces, apart=True)))
    return let(stripped(text), of)
