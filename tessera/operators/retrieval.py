"""Scoped retrieval: nearest chunks among a submission's documents, and what is made of them."""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import optional

DEFAULT_RESULTS, MOST_RESULTS, SNIPPET_CHARS, CONTEXT_SNIPPETS, DIMENSIONS = 5, 10, 1200, 4, 256
#: Scope ids up to this many are sent to every executor; larger scopes are joined by shuffle.
BROADCAST_IDS = 100_000


def clamped(n: int | None) -> int:
    return max(1, min(DEFAULT_RESULTS if n is None else int(n), MOST_RESULTS))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def scoped(chunks: DataFrame, scope: DataFrame, scope_size: int | None = None) -> DataFrame:
    """Chunks of the scope's documents. The filter stands below the ranking: one after it would lose results."""
    ids = scope.select("documentId").distinct()
    if scope_size is not None and scope_size <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return chunks.join(ids, "documentId", "left_semi")


def nearest(chunks: DataFrame, query: list[float], k: int, vector: str = "embedding", ties: tuple[str, ...] = ("documentId", "chunkIndex")) -> DataFrame:
    """The k best by cosine; each task keeps k rows, and only those are merged."""
    unit = np.asarray(query, float)
    at = F.array(*(F.lit(float(x)) for x in unit))
    score = F.when(dot(F.col(vector), F.col(vector)) > 0, cosine(F.col(vector), at)).otherwise(F.lit(0.0))
    return chunks.withColumn("score", score).orderBy(F.desc("score"), *ties).limit(clamped(k))


def projected(found: DataFrame) -> DataFrame:
    """(documentId, score, contentType, text, s3Uri, metadata)."""
    return found.select("documentId", "score", F.lit("TEXT").alias("contentType"), F.left("content", F.lit(SNIPPET_CHARS)).alias("text"), F.col("contentKey").alias("s3Uri"), F.create_map(F.lit("documentId"), F.col("documentId")).alias("metadata"))


def document_ids(found: DataFrame) -> Column:
    """Distinct non-empty ids, sorted: an aggregate."""
    return F.array_sort(F.filter(F.collect_set("documentId"), lambda x: x != ""))


#: The texts around answers.
NO_DOCUMENTS = "Summary placeholder: no documents are linked to this submission."
NO_MATCHES = "Summary placeholder: no scoped matches were found for submission {submission} for query '{query}'."
MATCHES = "Summary placeholder: retrieved {n} scoped chunks for submission {submission} for query '{query}'."
RESULT = "Result {n}\ndocumentId: {documentId}\ns3Uri: {s3Uri}\nscore: {score}\n{text}"
PROMPT = """You are answering with only the provided scoped retrieval results.

Submission ID: {submission}

User query: {query}

Provide a short answer grounded only in these snippets. If the answer is not present, say so plainly.



{results}"""


def filled(template: str, **values: Column) -> Column:
    """A template with columns in its places."""
    parts = [(F.lit(text), values[name].cast("string") if name else F.lit("")) for text, name, _, _ in Formatter().parse(template)]
    return F.concat(*(x for pair in parts for x in pair))


def placeholder(n: int | None, submission: str = "", query: str = "") -> str:
    """What stands for a summary while no model is called; None: the submission has no documents."""
    return NO_DOCUMENTS if n is None else (MATCHES if n else NO_MATCHES).format(n=n, submission=submission, query=query)


def placeholder_text(n: Column, submission: Column, query: Column) -> Column:
    said = {"n": n, "submission": submission, "query": query}
    return F.when(n.isNull(), NO_DOCUMENTS).when(n == 0, filled(NO_MATCHES, **said)).otherwise(filled(MATCHES, **said))


def prompt(submission: str, query: str, results: list[dict]) -> str:
    """Over the first results: each with its number, document, place and score before its text."""
    listed = "\n\n".join(RESULT.format(n=i, **{k: r.get(k) for k in ("documentId", "s3Uri", "score", "text")}) for i, r in enumerate(results[:CONTEXT_SNIPPETS], 1))
    return PROMPT.format(submission=submission, query=query, results=listed)


def prompt_text(submission: Column, query: Column, results: Column) -> Column:
    """The same for an array of results (documentId, s3Uri, score, text)."""
    one = lambda r, i: filled(RESULT, n=i + 1, documentId=r["documentId"], s3Uri=r["s3Uri"], score=r["score"], text=r["text"])
    return filled(PROMPT, submission=submission, query=query, results=F.array_join(F.transform(F.slice(results, 1, CONTEXT_SNIPPETS), one), "\n\n"))


def answer_text(blocks: list[dict]) -> str:
    """The text blocks of a model's response, one a line."""
    return "\n".join(b["text"] for b in blocks if b.get("type", "text") == "text" and b.get("text")).strip()


def summarized(submission: str, query: str, results: list[dict], model: Callable[[str], str | list[dict]] | None) -> dict:
    """The model's answer, or the placeholder with the error if it fails or is absent."""
    out = {"summary": placeholder(len(results), submission, query), "modelInvoked": False, "modelError": None}
    if model and results:
        try:
            said = model(prompt(submission, query, results))
            out |= {"summary": answer_text(said) if isinstance(said, list) else said.strip(), "modelInvoked": True}
        except Exception as e:  # the contract: any failure of the model becomes a field
            out["modelError"] = f"{type(e).__name__}: {e}"
    return out


def embed(text: str, dims: int = DIMENSIONS) -> list[float]:
    """A deterministic stand-in for an embedding model: hashed words, unit length."""
    import zlib

    v = np.zeros(dims)
    for word in text.lower().split():
        h = zlib.crc32(word.encode())
        v[h % dims] += 1.0 if h >> 31 else -1.0
    size = np.linalg.norm(v)
    return [float(np.float32(x)) for x in (v / size if size else v)]


def embedded(chunks: DataFrame, embedder: Callable[[str], list[float]] = embed, content: str = "content") -> DataFrame:
    """embedder: a function of a text; one that has `many` (a model of `semantic`) takes a batch of texts at once."""

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        if hasattr(embedder, "many"):
            return pd.Series(list(embedder.many(texts.tolist())), index=texts.index, dtype=object)
        return texts.map(lambda t: embedder(t or ""))

    return chunks.withColumn("embedding", vectors(content))


def index_new(chunks: DataFrame, index: DataFrame, embedder: Callable[[str], list[float]] = embed) -> DataFrame:
    """Rows to append: chunks that the index lacks, with their vectors."""
    return embedded(chunks.join(index.select("contentKey"), "contentKey", "left_anti"), embedder)


def leaks(retrieved: DataFrame, scope: DataFrame) -> DataFrame:
    """Retrieved ids outside the scope; must be empty."""
    return retrieved.join(scope.select("documentId"), "documentId", "left_anti")


def query_text(text: Column) -> Column:
    return optional(text)
