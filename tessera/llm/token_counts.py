"""Token counts by overlap resynchronisation.

A text longer than CHUNK characters is encoded in chunks that overlap. Two neighbouring chunks are spliced at a place
in their overlap where both have a token start. That place is stable: the vocabulary's pattern looks ahead of a
piece only, so once both encodings part the text at the same place they go on alike, but for the last piece of the
earlier chunk, which its end may have cut; a place only counts if the earlier chunk's next piece ends before that
chunk does. In texts off the fast way of _tokens a place must also follow white space, where no piece, special token
or composed character can reach across. If an overlap has no such place it is doubled and the text spliced again, up
to a single chunk.

Edge cases: null and empty texts have 0 bytes and 0 tokens. Null ids and repeated rows are kept, one result each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import STEP_BYTES, ready, utf8
from ._tokens import Encoder, encoder

VOCABULARY = "word_bpe_49k.json"
CHUNK, OVERLAP, LIMIT = 1 << 14, 256, 2048


class Chunk:
    """One encoded chunk: where it begins in its text, its token starts that may part it, and the tokens from each on."""

    def __init__(self, begin: int, end: int, starts: np.ndarray, counts: np.ndarray):
        self.begin, self.end = begin, end
        self.starts, self.before = starts + begin, np.r_[0, np.cumsum(counts)]


def cuts(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Bounds of the overlapping chunks of a text."""
    out, at = [], 0
    while True:
        out.append((at, min(length, at + chunk)))
        if at + chunk >= length:
            return out
        at += chunk - overlap


def splice(chunks: list[Chunk]) -> int | None:
    """The tokens of the whole text, or None if two chunks have no stable common start."""
    total, since = 0, 0  # since: index in the present chunk's starts from which its tokens count
    for here, after in zip(chunks, chunks[1:], strict=False):
        whole = here.starts[:-1]  # the last piece may be cut by the chunk's end
        lo = np.searchsorted(whole, after.begin, "right")
        place = np.intersect1d(whole[max(lo, since) :], after.starts, assume_unique=True)
        if not len(place):
            return None
        cut = int(np.searchsorted(here.starts, place[0]))
        total += int(here.before[cut] - here.before[since])
        since = int(np.searchsorted(after.starts, place[0]))
    return total + int(chunks[-1].before[-1] - chunks[-1].before[since])


def encode_chunks(enc: Encoder, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(starts, counts) of each text; all that may take the fast way do so together."""
    out: list = [None] * len(texts)
    raws = [enc.safe(t) for t in texts]
    fast = [i for i, r in enumerate(raws) if r is not None]
    starts, place, edges = enc.batch([raws[i] for i in fast])
    sizes, at = enc.size[place], 0
    for i, a, b in zip(fast, edges[:-1], edges[1:], strict=True):
        out[i] = starts[a:b] - at, sizes[a:b]
        at += len(raws[i])
    for i, raw in enumerate(raws):
        if raw is None:
            out[i] = enc.slow_starts(texts[i])
    return out


def count_tokens(enc: Encoder, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Tokens of each text."""
    out, wait = [0] * len(texts), {i: overlap for i, t in enumerate(texts) if t}
    while wait:
        plans = {i: cuts(len(texts[i]), max(chunk, 2 * o), o) for i, o in wait.items()}
        encoded = iter(encode_chunks(enc, [texts[i][a:b] for i, plan in plans.items() for a, b in plan]))
        again = {}
        for i, plan in plans.items():
            n = splice([Chunk(a, b, *next(encoded)) for a, b in plan])
            if n is None:
                again[i] = wait[i] * 2
            else:
                out[i] = n
        wait = again
    return out


def counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, spaced=False)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            sizes = np.diff(offsets)
            found: list[int] = []
            texts: list[str] = []
            held = 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                held += int(sizes[i])
                if held > STEP_BYTES // 2 or i == len(batch) - 1:
                    found += count_tokens(enc, texts)
                    texts, held = [], 0
            tokens = np.array(found, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], [id_column, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
