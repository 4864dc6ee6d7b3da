"""Object keys, content hashes and the ids derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INGESTION = "ingestion/"


def decoded(key: Column) -> Column:
    """A key as its event carries it, URL-decoded (a plus is a blank); null if it is malformed."""
    return F.try_url_decode(key)


def is_upload(key: Column) -> Column:
    return F.coalesce(key.startswith(INGESTION), F.lit(False))


def submission_of(key: Column) -> Column:
    """The part up to the first slash below the prefix; null in a malformed key."""
    return F.nullif(F.regexp_extract(key, r"^ingestion/([^/]+)/(?s)(.+)$", 1), F.lit(""))


def file_of(key: Column) -> Column:
    """All behind that slash: a file id may hold slashes of its own."""
    return F.nullif(F.regexp_extract(key, r"^ingestion/([^/]+)/(?s)(.+)$", 2), F.lit(""))


def raw_key(submission: Column, file: Column) -> Column:
    return F.concat(F.lit(INGESTION), submission, F.lit("/"), file)


def processed_key(submission: Column, file: Column) -> Column:
    return F.concat(F.lit("processed/"), submission, F.lit("/"), file, F.lit(".md"))


def canonical_prefix(document: Column) -> Column:
    return F.concat(F.lit("canonical/"), document, F.lit("/"))


def chunk_key(document: Column, number: Column) -> Column:
    """Chunks count from 1; four digits at least (format_string, as lpad would cut longer numbers)."""
    return F.concat(canonical_prefix(document), F.format_string("chunk-%04d.md", number))


def metadata_key(document: Column, number: Column) -> Column:
    return F.concat(chunk_key(document, number), F.lit(".metadata.json"))


def content_hash(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def digest(content: Column) -> Column:
    """The bytes of a content's hash."""
    return F.unhex(F.sha2(content, 256))


def hash_of_digest(digest: Column) -> Column:
    """What content_hash gives, of the digest."""
    return F.concat(F.lit("sha256:"), F.lower(F.hex(digest)))


def document_id(canonical_hash: Column) -> Column:
    """The first 64 bits of the hash name the document."""
    return F.concat(F.lit("doc-"), F.substring(canonical_hash, 8, 16))


def run_id() -> Column:
    return F.concat(F.lit("run-"), F.uuid())


def client_token(run: str, most: int = 256) -> str:
    """What makes a repeated start of one run the same start."""
    return run[:most]


def optional(text: Column) -> Column:
    """Stripped of white space at both ends; null if nothing is left."""
    space = r"[\s\p{Z}\x1c-\x1f\x85]+"
    return F.nullif(F.regexp_replace(text, f"^{space}|{space}$", ""), F.lit(""))


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.struct(text.alias("x")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)  # without the object around it


def shortened(text: Column, most: int = 2048) -> Column:
    return F.left(text, F.lit(most))
