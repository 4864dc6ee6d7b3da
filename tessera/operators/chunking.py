"""Chunk records of canonical documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text


def chunk_records(documents: DataFrame, most: int = text.CHUNK_CHARS, id_column: str = "documentId", text_column: str = "markdown") -> DataFrame:
    """(id, chunkIndex, contentKey, metadataKey, content, metadata): chunks count from 1."""
    split = documents.select(F.col(id_column), F.posexplode(text.chunks(F.col(text_column), most)).alias("at", "content"))
    number, document = F.col("at") + 1, F.col(id_column).cast("string")
    attributes = F.concat(F.lit('{"metadataAttributes": {"documentId": '), keys.quoted(document), F.lit("}}"))
    return split.select(id_column, number.alias("chunkIndex"), keys.chunk_key(document, number).alias("contentKey"), keys.metadata_key(document, number).alias("metadataKey"), "content", attributes.alias("metadata"))
