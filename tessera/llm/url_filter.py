"""URL filter: host and path rules, then a character language-model ratio for what no rule decides.

Two variable-order Markov models over the characters of whole URLs (scheme, query string and fragment too), one of
accepted and one of rejected URLs, are smoothed by
Witten-Bell interpolation down to order 0. A URL's score is the log-likelihood difference divided by its length.
The URLs that rules decide train and calibrate: those of HELD_OUT's fold by hash give the cut, all others the counts
(equal URLs are in one fold). Where the fold lacks a class, the others give the cut too.

Model size is fixed by its parameters, not by data: SYMBOLS ** (ORDER + 1) cells (11 MB as float32), which is what
is sent to executors; counts reach the driver already summed, so at most that many per model.

Edge cases: a null URL, or one without "://", has an empty host and path and meets no rule; the first gets score 0, the
second is scored like any other text. With no
accepted or no rejected URL to learn from, everything undecided is allowed. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ready, utf8

#: (rule, verdict): host, then the start of the path.
RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Symbol 0 starts a URL, the last one stands for every other byte.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-"
SYMBOLS = len(ALPHABET) + 2
ORDER = 3
BINS, WIDEST = 2000, 10.0
#: Folds of the URLs that rules decide; the first calibrates.
HELD_OUT = 5

CODE = np.full(256, SYMBOLS - 1, np.int64)
for _i, _c in enumerate(ALPHABET, 1):
    CODE[ord(_c)] = CODE[ord(_c.upper())] = _i


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def by_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def contexts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each character of each text the code of it and the ORDER symbols before it; and the row of each."""
    data, offsets = utf8(column)
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    padded = np.zeros(len(data) + ORDER * len(lengths), np.int64)
    at = np.arange(len(data)) + ORDER * (rows + 1)
    padded[at] = CODE[data]
    code = np.zeros(len(data), np.int64)
    for back in range(ORDER, -1, -1):
        code = code * SYMBOLS + padded[at - back]
    return code, rows


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = {k: np.zeros(SYMBOLS ** (ORDER + 1), np.int64) for k in ("allow", "block")}
    for batch in batches:
        said = np.array(batch.column("verdict").to_pylist(), object)
        code, rows = contexts(batch.column("address"))
        for k, total in totals.items():
            mine = code[said[rows] == k]
            np.add.at(total, *np.unique(mine, return_counts=True))
    for k, total in totals.items():
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at)), pa.array(at), pa.array(total[at])], ["verdict", "gram", "n"])


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """log p(symbol | up to ORDER symbols before it), each order interpolated with the next lower one."""
    p = np.full(1, 1.0 / SYMBOLS)
    for order in range(ORDER + 1):
        n = counts.reshape(-1, SYMBOLS ** (order + 1)).sum(0).reshape(-1, SYMBOLS).astype(np.float64)
        kinds = (n > 0).sum(1, keepdims=True)
        lower = np.broadcast_to(p.reshape(-1, SYMBOLS) if order else np.full((1, SYMBOLS), p[0]), (max(1, p.size // SYMBOLS), SYMBOLS))
        lower = np.tile(lower, (len(n) // len(lower), 1))
        seen = n.sum(1, keepdims=True)
        p = np.where(seen > 0, (n + kinds * lower) / np.maximum(seen + kinds, 1), lower).ravel()
    return np.log(p)


def score_with(ratio, column: pa.Array) -> np.ndarray:
    """Length-normalised log-likelihood difference of each row (0 for an empty one)."""
    code, rows = contexts(column)
    n = np.bincount(rows, minlength=len(column))
    return np.bincount(rows, weights=ratio[code], minlength=len(column)) / np.maximum(n, 1)


def calibrated(histogram: dict[tuple[str, int], int]) -> float:
    """The cut that best parts both training sets by balanced accuracy; the lowest of equals."""
    good, bad = (np.array([histogram.get((k, b), 0) for b in range(BINS)], float) for k in ("allow", "block"))
    kept = good[::-1].cumsum()[::-1] / good.sum()
    dropped = (bad.cumsum() - bad) / bad.sum()
    return float(np.argmax(kept + dropped)) / BINS * 2 * WIDEST - WIDEST


def judge(pages: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Returns id, host, path, rule, verdict, score for every row; score is null where a rule decides."""
    spark = ready(pages.sparkSession)
    host, path = host_and_path(F.col(url_column))
    parts = pages.select(F.col(id_column), host.alias("host"), path.alias("path"), F.coalesce(F.col(url_column), F.lit("")).alias("address"))
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "by_rule": verdict})
    labelled = ruled.where("by_rule is not null").select(F.col("by_rule").alias("verdict"), "address")
    held_out = F.pmod(F.xxhash64("address"), F.lit(HELD_OUT)) == 0

    counted = labelled.where(~held_out).mapInArrow(count_grams, "verdict string, gram long, n long").groupBy("verdict", "gram").agg(F.sum("n").alias("n"))
    counts = {k: np.zeros(SYMBOLS ** (ORDER + 1), np.int64) for k in ("allow", "block")}
    for k, part in counted.toPandas().groupby("verdict"):
        counts[k][part["gram"].to_numpy()] = part["n"].to_numpy()
    if not all(c.any() for c in counts.values()):
        return ruled.select(id_column, "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    ratio = spark.sparkContext.broadcast((log_likelihoods(counts["allow"]) - log_likelihoods(counts["block"])).astype(np.float32))

    @F.pandas_udf("double")
    def score(address: pd.Series) -> pd.Series:
        return pd.Series(score_with(ratio.value, pa.array(address, pa.string())))

    binned = labelled.select("verdict", held_out.alias("held_out"), F.least(F.greatest(F.floor((score("address") + WIDEST) / (2 * WIDEST) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int").alias("bin"))
    seen = binned.groupBy("held_out", "verdict", "bin").agg(F.count("*").alias("n")).collect()
    apart = len({r["verdict"] for r in seen if r["held_out"]}) == 2
    cut = calibrated({(r["verdict"], r["bin"]): r["n"] for r in seen if r["held_out"] == apart})
    scored = ruled.withColumn("score", F.when(F.col("by_rule").isNull(), score("address")))
    return scored.select(id_column, "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"), "score")
