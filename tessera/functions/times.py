"""Ages of timestamps against a given now."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """ISO-8601 with a closing Z or an offset; null if it can't be read."""
    return F.try_to_timestamp(text)


def minutes_since(ts: Column, now: Column) -> Column:
    """Minutes with their fraction; a missing timestamp is 0 minutes old, so it is never stale."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.coalesce((micros(now) - micros(ts)) / F.lit(60_000_000.0), F.lit(0.0))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def clock_run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")
