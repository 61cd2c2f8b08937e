"""One row per key, with a survivor that does not depend on task order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """Keep the first row per key; NULL keys are equal to each other.

    First means smallest in ``order_by`` and then in the remaining columns,
    where a value comes before NULL, so a complete copy beats one that lacks
    something and rows that tie are identical.  It is an aggregate, not a window: every map
    task sends on at most one row per key, so a key that holds a large share
    of the input does not load one reducer, and the number of ``copies`` comes
    with it for free.
    """
    ordered = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ordered]
    counts = [F.count("*").alias(copies)] if copies else []
    if not ordered and not rest:
        return df.groupBy(*keys).agg(F.count("*").alias(copies)) if copies else df.distinct()
    ranked = [c for i, name in enumerate(rest) for c in (F.col(name).isNull().alias(f"_no_{i}"), F.col(name))]
    first = F.min(F.struct(*ordered, *ranked)).alias("_first")
    kept = df.groupBy(*keys).agg(first, *counts)
    columns = [F.col(c) if c in keys else F.col(f"_first.`{c}`") for c in df.columns]
    return kept.select(*columns, *([copies] if copies else []))


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark cuts each key to one row before the shuffle (a window group limit),
    so a hot key is one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)
