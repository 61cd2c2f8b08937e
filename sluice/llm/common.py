"""Helpers the operators share: staging, tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import scratch_root

#: Rows in one Arrow batch.  Texts can be long, so batches are kept short.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings for text: short Arrow batches, adaptive skew handling."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_folder: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """One folder for all that operators stage inside, removed at the end.

    Results are lazy and read staged files, so they have to be written before the end.  Without
    this, staged files stay in the shared scratch folder, and whoever owns that folder removes ``llm-*``.
    """
    path = f"{scratch_root(spark)}/llm-{uuid.uuid4().hex}"
    held = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(held)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs only its running tasks, and a
    branch that reads the result twice computes it once.
    """
    root = _folder.get() or f"{scratch_root(spark)}/llm-{uuid.uuid4().hex}"
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128 bits of a text; null counts as empty.  With the id it says which row a decision is about."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def texts_of(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8; null counts as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""
