"""Numbers out of dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(col: Column, type_name: str = "double") -> Column:
    """Drop all but digits, point and minus, then cast; NULL when that fails.

    Units and thousands marks vanish.  So do exponent letters and brackets:
    ``1.5e3`` is read as 1.53 and ``(5)`` as 5.
    """
    return F.regexp_replace(col, "[^0-9.-]+", "").try_cast(type_name)
