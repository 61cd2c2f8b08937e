"""Text helpers.  All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value", and texts that mean "yes".
NULL_MARKERS = ("", "NA", "N/A", "NULL", "NONE", "UNKNOWN")
YES_MARKERS = ("Y", "YES", "TRUE", "1")


def nullify(col: Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    """Trim spaces; a marker in any case becomes NULL.

    Text longer than every marker is kept without looking further.
    """
    text = F.trim(col)
    longest = max(len(m) for m in markers)
    return F.when((F.length(text) > longest) | ~F.upper(text).isin(*markers), text)


def norm_id(col: Column) -> Column:
    """ASCII letters and digits only, in upper case; nothing left gives ``''``.

    The named class is one table look-up per character, several times faster
    than the same set written as ranges.
    """
    return F.upper(F.regexp_replace(col, r"\P{Alnum}+", ""))


def norm_code(col: Column) -> Column:
    """Upper case, each run of white space as one underscore."""
    return F.upper(F.regexp_replace(col, r"\s+", "_"))


def trim_upper(col: Column) -> Column:
    return F.upper(F.trim(col))


def title_case(col: Column) -> Column:
    return F.initcap(col)


def to_flag(col: Column) -> Column:
    """TRUE for a yes marker, FALSE for other text, NULL for NULL."""
    return F.upper(col).isin(*YES_MARKERS)


def as_json(columns: Sequence[str]) -> Column:
    """The named columns as one JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def quoted(name: str) -> str:
    """An identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"
