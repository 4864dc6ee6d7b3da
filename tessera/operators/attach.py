"""Documents of submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def document_of(files: DataFrame) -> DataFrame:
    """The canonical document's id, or else the one that the raw file resolved to."""
    found = F.coalesce(F.nullif("canonicalDocumentId", F.lit("")), F.nullif("resolvedDocumentId", F.lit("")))
    return files.withColumn("documentId", found)


def attached(submissions: DataFrame, resolved: DataFrame) -> DataFrame:
    """submissions with documentIds joined by the resolved ones (sorted, each once) and status COMPLETE."""
    new = resolved.where("documentId is not null").groupBy("submissionId").agg(F.collect_set("documentId").alias("new"))
    none = F.array().cast("array<string>")
    ids = F.array_sort(F.array_union(F.coalesce("documentIds", none), F.coalesce("new", none)))
    return submissions.join(new, "submissionId", "left").withColumns({"documentIds": ids, "status": F.when(F.col("new").isNotNull(), F.lit("COMPLETE")).otherwise(F.col("status"))}).drop("new")


def with_hash(attached: DataFrame, documents: DataFrame) -> DataFrame:
    """(submissionId, documentId, canonicalHash): attached has a row a submission and document."""
    return attached.select("submissionId", "documentId").join(documents.select("documentId", "canonicalHash"), "documentId")


def document_of_hash(attached: DataFrame, documents: DataFrame, submission: str, canonical_hash: str) -> str:
    """The document that a submission has for a canonical hash; raises if it has none."""
    found = with_hash(attached.where(F.col("submissionId") == submission), documents).where(F.col("canonicalHash") == canonical_hash).first()
    if found is None:
        raise ValueError(f"submission {submission} has no document with the hash {canonical_hash}")
    return found["documentId"]
