"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans.

The field labels whole segments; the text between them scores nothing. Features look at the whole candidate: its shape,
how many digits it has, its checksum or number ranges and the characters beside it. Forward-backward sums over all
segmentations train it, and the same bounded dynamic program finds the best boundaries and types jointly. A segment has
at most MOST_TOKENS tokens and MOST_CHARS characters (19 digits with a sign between each two have 37 tokens). In
training any candidate of up to TRAIN_TOKENS tokens competes; decoding is constrained to candidates that pass their
kind's exact test and touch no base span, so it holds a few numbers for each such candidate and nothing for the rest
of a text, however long. The spans it adds are what the greedy patterns swallow, such as two card numbers side by side.

It learns from the base spans of at most TRAIN_ISLANDS different stretches around digits and at-signs, of each the first
ISLAND_CHARS characters; these bound the fitting sample only, decoding covers every text in full.

Edge cases: null and empty texts have no spans (the hash is that of an empty string). Repeated rows and equal ids
give one result each; a null id is kept. With no stretch to learn from, only the base spans are returned.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import ready

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS, MOST_CHARS, TRAIN_TOKENS = 40, 320, 16
TRAIN_ISLANDS, EPOCHS, RATE, DECAY = 400, 6, 0.4, 1e-3
ISLAND_CHARS, MARGIN = 240, 16

DIGITS = "0123456789"
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
RUN = re.compile(r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+")
QUAD = re.compile(r"(?<![0-9])(?=([0-9]++\.[0-9]++\.[0-9]++\.[0-9]++))")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]*")
NUMBER = re.compile(r"[0-9]+")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\x00-\x7f]+|[\x00-\x7f]", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def octets(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)


def card_like(text: str) -> bool:
    d = digits_of(text)
    return 12 <= len(d) <= 19 and luhn(d)


def phone_like(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: what a scan for local@domain.domain finds, led by the at-signs."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            after = domain.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of every base span, in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if octets(m[0])]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if card_like(m[0])]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if phone_like(m[0])] if "+" in text else []
    return sorted(found)


def valid(kind: int, text: str) -> bool:
    """The exact test that a span of the field must pass."""
    if kind == 0:
        return next(emails(text), None) == (0, len(text))
    if kind == 1:
        return octets(text)
    if kind == 2:
        return bool(CARD.fullmatch(text)) and card_like(text)
    return bool(PHONE.fullmatch(text)) and phone_like(text)


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and at-signs; neighbours closer than two margins are one stretch."""
    start = end = -1
    for m in TRIGGER.finditer(text):
        at = m.start()
        if end < 0:
            start, end = max(0, at - MARGIN), at + MARGIN
        elif at - MARGIN <= end:
            end = at + MARGIN
        else:
            yield start, min(end, len(text))
            start, end = max(at - MARGIN, end), at + MARGIN
    if end >= 0:
        yield start, min(end, len(text))


def shape(text: str) -> str:
    return re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", text))


def side(text: str, at: int) -> str:
    c = text[at] if 0 <= at < len(text) else ""
    return "edge" if not c else "digit" if c in DIGITS else "word" if c.isalnum() else "space" if c.isspace() else c


def features_of(text: str, a: int, b: int) -> list[str]:
    span = text[a:b]
    d = digits_of(span)
    return [f"shape {shape(span)[:24]}", f"digits {min(len(d), 20)}", f"left {side(text, a - 1)}", f"right {side(text, b)}", f"at {span.count('@')}", f"plus {span[0] == '+'}", f"octets {octets(span)}", f"luhn {12 <= len(d) <= 19 and luhn(d)}", f"letters {any(c.isalpha() for c in span)}"]


def sound(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of all segments that pass their kind's exact test, whole tokens each, by kind and start."""
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > max(0, at - MOST_CHARS) and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1, min(len(text), at + MOST_CHARS)) if begin < at else None
        if domain:
            starts = [begin + m.start() for m in TOKEN.finditer(text[begin:at]) if m[0][0].isalnum() or m[0] == "+"]
            ends = [at + 1 + m.end() for m in TOKEN.finditer(text[at + 1 : domain.end()]) if m[0][0].isalnum()]
            for a in starts[-MOST_TOKENS:]:
                yield from ((a, 0, b) for b in ends[:MOST_TOKENS] if b - a <= MOST_CHARS and "." in text[at:b] and valid(0, text[a:b]))
        at = text.find("@", at + 1)
    yield from ((m.start(), 1, m.end(1)) for m in QUAD.finditer(text) if octets(m[1]))
    for run in RUN.finditer(text):
        if run.end() - run.start() < 12:
            continue
        wait: list[tuple[int, int, int]] = []  # the last tokens: start, end, digits before
        before = 0
        for m in NUMBER.finditer(text, run.start(), run.end()):
            wait.append((m.start(), m.end(), before))
            before += m.end() - m.start()
            while before - wait[0][2] > 19 and len(wait) > 1:
                wait.pop(0)
            for a, _, had in wait:
                if 12 <= before - had <= 19 and card_like(text[a : m.end()]):
                    yield a, 2, m.end()
    for run in DIALLED.finditer(text):
        digits = 0
        for m in NUMBER.finditer(text, run.start(), run.end()):
            digits += m.end() - m.start()
            if digits > 15 or m.end() - run.start() > MOST_CHARS:
                break
            if digits >= 9 and valid(3, text[run.start() : m.end()]):
                yield run.start(), 3, m.end()


def candidates(text: str) -> tuple[list[int], dict[int, list[tuple[int, list[str]]]]]:
    """Token bounds, and for each end the (start, features) of the segments that may be an entity: what training compares."""
    bounds = [0, *(m.end() for m in TOKEN.finditer(text))]
    n, place = len(bounds) - 1, {x: k for k, x in enumerate(bounds)}
    opens = [text[bounds[i]] in DIGITS or text[bounds[i]] == "+" or (text[bounds[i]].isascii() and text[bounds[i]].isalpha()) for i in range(n)]
    spans = {(place[a], place[b]) for a, _, b in sound(text)}
    for i in range(n):
        if not opens[i]:
            continue
        for j in range(i + 1, min(n, i + TRAIN_TOKENS) + 1):
            a, b = bounds[i], bounds[j]
            if b - a > MOST_CHARS or "\n" in text[bounds[j - 1] : b]:
                break
            if text[b - 1].isascii() and text[b - 1].isalnum() and TRIGGER.search(text, a, b):
                spans.add((i, j))
    by_end: dict[int, list] = {}
    for i, j in sorted(spans):
        by_end.setdefault(j, []).append((i, features_of(text, bounds[i], bounds[j])))
    return bounds, by_end


def scored(by_end: dict, weights: dict[tuple[int, str], float]) -> dict[int, list[tuple[int, int, float, list[str]]]]:
    get = weights.get
    return {j: [(i, k, get((k, "bias"), 0.0) + sum(get((k, f), 0.0) for f in features), features) for i, features in found for k in range(len(KINDS))] for j, found in by_end.items()}


def add(a: float, b: float) -> float:
    if a == -math.inf or b == -math.inf:
        return max(a, b)
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def train(examples: list[tuple[str, list[tuple[int, int, int]]]]) -> dict[tuple[int, str], float]:
    """Maximum likelihood by forward-backward and AdaGrad. examples: (text, non-overlapping (start, kind, end))."""
    weights: dict[tuple[int, str], float] = {}
    squares: dict[tuple[int, str], float] = {}
    prepared = [(*candidates(text), set(spans)) for text, spans in examples]
    for _ in range(EPOCHS):
        for bounds, by_end, gold in prepared:
            n = len(bounds) - 1
            segments = scored(by_end, weights)
            ahead = [0.0] + [-math.inf] * n
            for j in range(1, n + 1):
                ahead[j] = ahead[j - 1]
                for i, _, s, _ in segments.get(j, ()):
                    ahead[j] = add(ahead[j], ahead[i] + s)
            back = [-math.inf] * n + [0.0]
            starts: dict[int, list] = {}
            for j, found in segments.items():
                for i, k, s, features in found:
                    starts.setdefault(i, []).append((j, k, s, features))
            for i in range(n - 1, -1, -1):
                back[i] = back[i + 1]
                for j, _, s, _ in starts.get(i, ()):
                    back[i] = add(back[i], back[j] + s)
            gradient: dict[tuple[int, str], float] = {}
            for i, found in starts.items():
                for j, k, s, features in found:
                    g = ((bounds[i], k, bounds[j]) in gold) - math.exp(min(0.0, ahead[i] + s + back[j] - ahead[n]))
                    if abs(g) > 1e-4:
                        for f in ("bias", *features):
                            gradient[k, f] = gradient.get((k, f), 0.0) + g
            for key, g in gradient.items():
                g -= DECAY * weights.get(key, 0.0)
                squares[key] = squares.get(key, 0.0) + g * g
                weights[key] = weights.get(key, 0.0) + RATE * g / math.sqrt(squares[key] + 1e-6)
    return weights


def decode(text: str, weights: dict[tuple[int, str], float], base: list[tuple[int, int, int]] = ()) -> list[tuple[int, int, int]]:
    """The best segmentation's entities beside the base spans: (start, kind, end)."""
    fixed = sorted((a, b) for a, _, b in base)
    firsts, reach = [a for a, _ in fixed], []
    for _, b in fixed:
        reach.append(max(b, reach[-1] if reach else 0))
    get = weights.get
    found = array("q"), array("q"), array("q"), array("d")  # start, kind, end, score
    for a, k, b in sound(text):
        i = bisect_right(firsts, b - 1)  # base spans that begin before the candidate ends
        if i and reach[i - 1] > a:
            continue
        score = get((k, "bias"), 0.0) + sum(get((k, f), 0.0) for f in features_of(text, a, b))
        if score > 0:
            for column, x in zip(found, (a, k, b, score), strict=True):
                column.append(x)
    starts, kinds, ends, scores = found
    # states: the ends after which the best score is higher than before; each with its segment and the state before it
    at, best, segment, came = array("q", [0]), array("d", [0.0]), array("q", [-1]), array("q", [-1])
    for c in sorted(range(len(starts)), key=lambda c: (ends[c], starts[c], kinds[c])):
        before = bisect_right(at, starts[c]) - 1
        total = best[before] + scores[c]
        if total > best[-1]:
            if at[-1] == ends[c]:
                best[-1], segment[-1], came[-1] = total, c, before
            else:
                for column, x in zip((at, best, segment, came), (ends[c], total, c, before), strict=True):
                    column.append(x)
    out, state = [], len(at) - 1
    while state > 0:
        c = segment[state]
        out.append((starts[c], kinds[c], ends[c]))
        state = came[state]
    return out[::-1]


def learn(docs: DataFrame, text_column: str) -> dict[tuple[int, str], float]:
    """Trains on the first TRAIN_ISLANDS different stretches by hash that hold a base span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, str] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or not TRIGGER.search(text):
                    continue
                for a, b in islands(text):
                    piece = text[a : min(b, a + ISLAND_CHARS)]
                    if base_spans(piece):
                        held[hashlib.sha256(piece.encode()).digest()] = piece
            if len(held) > 4 * TRAIN_ISLANDS:
                held = dict(sorted(held.items())[:TRAIN_ISLANDS])
        held = dict(sorted(held.items())[:TRAIN_ISLANDS])
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.string())], ["key", "piece"])

    rows = docs.select(text_column).mapInArrow(run, "key binary, piece string").distinct().orderBy("key").limit(TRAIN_ISLANDS).collect()
    examples = []
    for row in rows:
        spans = base_spans(row["piece"])
        if all(a[2] <= b[0] for a, b in zip(spans, spans[1:], strict=False)):
            examples.append((row["piece"], spans))
    return train(examples)


def find(text: str, weights: dict[tuple[int, str], float]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans."""
    if not text or not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    return base, sorted({*base, *decode(text, weights, base)}) if weights else base


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", passed: tuple[str, ...] = (), mask: str | None = None) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans[, masked]), plus the columns in passed.

    With mask set, `masked` is the text with every span replaced by mask.format(kind).
    """
    ready(docs.sparkSession)
    weights = learn(docs, text_column)
    names = [id_column, *passed]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in names] + [f"n_{k} long" for k in KINDS] + ["base string", "spans string"] + ["masked string"] * bool(mask))

    def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        if text is None or not spans:
            return text
        out, at = [], 0
        for a, k, b in spans:
            if a >= at:
                out += [text[at:a], mask.format(KINDS[k])]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            found = [find(t, weights) for t in texts]
            out = [batch.column(i) for i in range(len(names))]
            out += [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            out += [pa.array([shown(f[i]) for f in found], pa.string()) for i in (0, 1)]
            if mask:
                out.append(pa.array([masked(t, f[1]) for t, f in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, [*names, *(f"n_{k}" for k in KINDS), "base", "spans", *["masked"] * bool(mask)])

    return docs.select(*names, docs[text_column].alias("__text")).mapInArrow(run, schema)
