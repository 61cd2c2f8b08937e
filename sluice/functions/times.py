"""Timestamps and dates out of dirty text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats tried after the plain cast.
TIMESTAMP_PATTERNS = ("yyyy-MM-dd HH:mm:ss",)
DATE_PATTERNS = ("yyyy-MM-dd",)

STARTS_WITH_YEAR = r"^\s*[+-]?[0-9]{4}"


def to_ts(col: Column, patterns: Sequence[str] = TIMESTAMP_PATTERNS) -> Column:
    """Cast, else the patterns in turn, else NULL.

    Only text that starts with a year is cast: Spark would read ``12:30`` as
    today at half past twelve, which a later run could not reproduce.
    """
    text = F.trim(col)
    cast = F.when(text.rlike(STARTS_WITH_YEAR), text).try_cast("timestamp")
    return F.coalesce(cast, *[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def to_dt(col: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """Cast, else the patterns in turn, else NULL."""
    text = F.trim(col)
    parsed = [F.to_date(F.try_to_timestamp(text, F.lit(p))) for p in patterns]
    return F.coalesce(text.try_cast("date"), *parsed)


def hours_between(start: Column, end: Column) -> Column:
    """Hours from whole seconds; NULL if either side is NULL."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(3600.0)
