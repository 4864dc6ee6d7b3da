"""Rendering of JSON documents as canonical Markdown, and the hash that names the result.

Catalyst has no recursive expressions, and Spark's JSON functions change key order, numbers and escapes; so this is
the one Python function on the ingestion path, called a batch at a time.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F

from ..schemas import L, S, struct

STRATEGY = "json_to_markdown_lines_v2"
PRUNED = "segment_id"
RENDERED = struct(
    markdown=S, canonicalHash=S, businessDocumentKey=S, sourceVersion=S, sourceUpdatedAt=S, topLevelType=S, topLevelEntries=L,
    sanitizedEntries=L, segmentIds=L, sizeBytes=L, chars=L, lines=L, error=S,
)


def count_pruned(value) -> int:
    """Objects that have the key, those inside its own subtrees included."""
    if not isinstance(value, dict | list):
        return 0
    n, children = (PRUNED in value, value.values()) if isinstance(value, dict) else (0, value)
    for child in children:
        if isinstance(child, dict | list):
            n += count_pruned(child)
    return int(n)


def block(text: str) -> str:
    if "\n" not in text and "\r" not in text:
        return text.strip()
    return "\n".join(line.rstrip() for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n")).strip()


def scalar(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    return block(value) if isinstance(value, str) else str(value)


@lru_cache(1 << 12)
def title(key: str) -> str:
    return key.replace("_", " ").strip().title()


def add_lines(out: list[str], value, indent: int = 0, key: str | None = None, item: bool = False) -> None:
    """Adds the lines of one value: of the root, of a key's value or of a list's item."""
    pad = " " * indent
    head = f"{pad}-" if item else None if key is None else pad + title(key)
    if not isinstance(value, dict | list):
        text = scalar(value)
        if item:
            out.append(f"{head} {text}")
        elif head is None:
            out.append(text)
        elif "\n" in text:
            out.append(f"{head}: |")
            out += [f"{pad}  {line}" for line in text.splitlines()]
        else:
            out.append(f"{head}: {text}")
        return
    if head is not None:
        out.append(f"{head}:")
    listed = isinstance(value, list)
    inner = indent + 2 if item or (listed and key is not None) else indent
    first = True
    for child in value if listed else value.items():
        if not listed and child[0] == PRUNED:
            continue
        if not first:
            out.append("")
        first = False
        if listed:
            add_lines(out, child, inner, item=True)
        else:
            add_lines(out, child[1], inner, key=str(child[0]))


def render(value) -> str:
    lines: list[str] = []
    add_lines(lines, value)
    return "\n".join([line.rstrip() for line in lines]).strip()


def canonical_hash(markdown: str) -> str:
    """Of a versioned envelope: sorted keys, no blanks, ASCII with \\u escapes."""
    envelope = f'{{"markdownText":{json.dumps(markdown)},"normalizationStrategy":"{STRATEGY}"}}'
    return f"sha256:{hashlib.sha256(envelope.encode()).hexdigest()}"


def optional(value) -> str | None:
    return None if value is None else str(value).strip() or None


def normalize(content: bytes) -> tuple:
    """The fields of RENDERED for one raw file; a file that can't be read has only its error."""
    try:
        value = json.loads(content.decode("utf-8"))
        markdown = render(value)
        known = value if isinstance(value, dict) else {}
        entries = len(value) if isinstance(value, dict | list) else 1
        return (
            markdown, canonical_hash(markdown), optional(known.get("report_id")), optional(known.get("source_version")),
            optional(known.get("report_date") or known.get("source_updated_at")), type(value).__name__, entries, entries - (PRUNED in known),
            count_pruned(value), len(content), len(markdown), markdown.count("\n") + 1 if markdown else 0, None,
        )
    except (ValueError, RecursionError) as e:
        return (*[None] * 12, f"{type(e).__name__}: {e}"[:2048])


@F.pandas_udf(RENDERED)
def normalize_document(content: pd.Series) -> pd.DataFrame:
    empty = (*[None] * 12, "ValueError: no content")
    frame = pd.DataFrame([empty if c is None else normalize(bytes(c)) for c in content], columns=RENDERED.names)
    return frame.astype({n: "Int64" for n in ("topLevelEntries", "sanitizedEntries", "segmentIds", "sizeBytes", "chars", "lines")})
