"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Indicators are hashed character 3-grams and 1- to 3-grams of word shapes (letter case, digits, closing signs, and
whether a word repeats the one before it). Each is scaled by its class log-count ratio, the scaled vector is brought
to length one, and a linear hinge-loss model is fitted by dual coordinate descent. A logistic curve fitted on a
quarter of the sample that the support vectors did not see turns margins into scores.

The model learns from at most SAMPLE labelled rows (a documented bound; the first by hash of their id), each sent to
the driver as at most FEATURES / 8 bytes: 32 MB whatever the table's size. Every row is then scored, in full.

Edge cases: null, empty and blank texts have no indicators and get the score of the model's bias. Rows whose id is
null are never learned from and count as held out. Labels that are null are ignored; of several labels for an id the
lowest counts. Without rows of both classes every score is the share of good rows (0.5 without any). Repeated rows
are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import STEP_BYTES, ready, steps, utf8, word_hashes, word_spans

SAMPLE = 4096
FEATURES = 1 << 16
HALF = FEATURES // 2
COST, ROUNDS, SMOOTHING = 1.0, 12, 0.5
FOLDS, THRESHOLD = 5, 0.3

#: Byte classes: 0 lower case, 1 upper case, 2 digit, 3 closing point or comma, 4 exclamation mark, 5 other sign, 6 beyond ASCII.
CLASS = np.full(256, 5, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 0, 1, 2, 6
CLASS[[44, 46]], CLASS[33] = 3, 4


def pieces(data: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """A text in parts of bounded size, each but the first beginning with the last words of the one before."""
    at, begin = 0, True
    while True:
        part = data[at : at + STEP_BYTES]
        yield part, begin
        if at + len(part) >= len(data):
            return
        starts = word_spans(part, np.array([0, len(part)]))[0]
        back = int(starts[-5]) if len(starts) >= 5 else 0
        at += max(back, len(part) // 2)
        begin = False


def indicators(data: np.ndarray) -> np.ndarray:
    """The features that one text has, in order."""
    flags = np.zeros(FEATURES, bool)
    for part, begin in pieces(data):
        wide = part.astype(np.uint64)
        if len(part) >= 3:
            gram = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
            flags[((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)] = True
        starts, ends, _ = word_spans(part, np.array([0, len(part)]))
        if not len(starts):
            continue
        hashes = word_hashes(part, starts, ends)
        same = np.r_[False, hashes[1:] == hashes[:-1]]
        second = CLASS[part[np.minimum(starts + 1, ends - 1)]] == 1
        code = ((CLASS[part[starts]] * 7 + CLASS[part[ends - 1]]) * 4 + 2 * second + same + 1).astype(np.uint64)
        code = code if begin else code[1:]
        key = np.zeros(len(code), np.uint64)
        for n in range(1, 4):
            if len(code) < n:
                break
            key = key[: len(code) - n + 1] * np.uint64(1000003) + code[n - 1 :]
            flags[HALF + (((key + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64)] = True
    return np.flatnonzero(flags)


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, dims: int) -> np.ndarray:
    """Hinge-loss support vectors by dual coordinate descent; the last weight is the bias."""
    w = np.zeros(dims + 1)
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(ROUNDS):
        for i in order.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), COST)
            if new != alpha[i]:
                change = (new - alpha[i]) * y[i]
                w[rows[i]] += change * values[i]
                w[-1] += change
                alpha[i] = new
    return w


def logistic(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(good | margin), by damped Newton steps on smoothed targets."""
    up, down = good.sum(), (~good).sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, s = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, [(d * margin).sum(), d.sum()])
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return max(a, 1e-3), b


def fit(rows: list[np.ndarray], good: np.ndarray) -> dict:
    """The model: per feature its scale and scaled weight, the bias, and the logistic curve."""
    if good.all() or not good.any():
        share = min(max(float(good.mean()) if len(good) else 0.5, 1e-3), 1 - 1e-3)
        return {"ratio": np.zeros(FEATURES), "weight": np.zeros(FEATURES), "bias": 0.0, "slope": 1.0, "offset": float(np.log(share / (1 - share)))}
    counts = {k: np.bincount(np.concatenate([r for r, g in zip(rows, good, strict=True) if g == k]), minlength=FEATURES) + SMOOTHING for k in (True, False)}
    ratio = np.log(counts[True] / counts[True].sum()) - np.log(counts[False] / counts[False].sum())
    values = [ratio[r] / max(np.linalg.norm(ratio[r]), 1e-9) for r in rows]
    seen = np.arange(len(rows)) % 4 != 0
    if len(set(good[seen])) < 2 or len(set(good[~seen])) < 2:
        seen = np.ones(len(rows), bool)
    kept = np.flatnonzero(seen)
    w = dual_descent([rows[i] for i in kept], [values[i] for i in kept], np.where(good[kept], 1.0, -1.0), FEATURES)
    judged = np.flatnonzero(~seen) if not seen.all() else kept
    margin = np.array([w[rows[i]] @ values[i] + w[-1] for i in judged])
    slope, offset = logistic(margin, good[judged])
    return {"ratio": ratio, "weight": w[:-1] * ratio, "bias": float(w[-1]), "slope": float(slope), "offset": float(offset)}


def score_of(found: np.ndarray, model: dict) -> float:
    norm = np.sqrt((model["ratio"][found] ** 2).sum())
    margin = model["weight"][found].sum() / max(norm, 1e-9) + model["bias"]
    return float(1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["offset"], -30, 30))))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str) -> dict:
    """Fits the model on the bounded sample."""
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column))).groupBy(F.col(id_column).alias("__id")).agg(F.min(label_column).alias("__label"))
    present = docs.select(F.col(id_column).alias("__id")).distinct()
    chosen = known.join(present, "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            packed = []
            for i in range(len(batch)):
                flags = np.zeros(FEATURES, bool)
                flags[indicators(data[offsets[i] : offsets[i + 1]])] = True
                packed.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["id", "label", "bits"])

    kind = docs.schema[id_column].dataType.simpleString()
    sample = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text")).join(F.broadcast(chosen), "__id")
    found = sample.select("__id", F.col("__label").cast("int"), "__text").mapInArrow(run, f"id {kind}, label int, bits binary")
    rows = sorted(found.orderBy(F.xxhash64("id"), "bits").limit(SAMPLE).collect(), key=lambda r: (r["bits"], r["id"]))
    order = np.random.default_rng(11).permutation(len(rows))
    return fit([np.flatnonzero(np.unpackbits(np.frombuffer(rows[i]["bits"], np.uint8))) for i in order], np.array([rows[i]["label"] == 1 for i in order], bool))


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", passed: tuple[str, ...] = ()) -> DataFrame:
    """(id, *passed, held_out, score, predicted) of every row; only the text is looked at."""
    spark = ready(docs.sparkSession)
    model = spark.sparkContext.broadcast(learn(docs, labels, id_column, text_column, label_column))
    names = [id_column, *passed]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(len(names)))
            scores = [score_of(indicators(data[offsets[i] : offsets[i + 1]]), model.value) for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(scores, pa.float64())], [*names, "score"])

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["score double"])
    scored = docs.select(*names, docs[text_column].alias("__text")).mapInArrow(run, schema)
    return scored.select(*names, held_out(F.col(id_column)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
