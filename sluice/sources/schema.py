"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import StringType, StructField, StructType


def text_schema(columns: Sequence[str]) -> StructType:
    """All columns as nullable text, as raw files are read."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def schema_from_ddl(ddl: str, partition_cols: Sequence[str] = ()) -> StructType:
    """The data columns of a table: its columns without the partition columns.

    A type Spark does not know is an error, not a string.
    """
    fields = [f for f in StructType.fromDDL(ddl).fields if f.name not in partition_cols]
    if not fields:
        raise ValueError("no data columns are left beside the partition columns")
    return StructType(fields)
