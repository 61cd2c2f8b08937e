"""What one run knows about itself, and the session settings it relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def resolve_business_date(text: str | None = None) -> str:
    """An ISO date, checked; today in UTC when nothing is given."""
    if not text:
        return datetime.now(timezone.utc).date().isoformat()
    return date.fromisoformat(text).isoformat()


@dataclass(frozen=True)
class Run:
    """Identity of one run.

    One start time serves every timestamp and every "today" of the run, so a
    retried task or a second evaluation writes the same values again.
    """

    business_date: str
    run_id: str
    started_at: datetime
    source_zip: str = ""

    @classmethod
    def start(cls, business_date: str | None = None, source_zip: str = "", run_id: str | None = None) -> Run:
        return cls(
            resolve_business_date(business_date),
            run_id or str(uuid.uuid4()),
            datetime.now(timezone.utc),
            source_zip,
        )

    @property
    def today(self) -> date:
        return self.started_at.astimezone(timezone.utc).date()


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators count on; all can change in a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A join is cut at a heavy key also where the next step has to shuffle again for it.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # The size aimed at when partitions are merged, cut, or written as files.  Shuffled rows take several
    # times as much in the memory of a task.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    # Cleaning a wide table makes a long generated method.  The JVM leaves
    # methods over 8000 bytes uncompiled; above that, Spark shall use its
    # smaller per-expression code instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


PARTITION_BYTES = 128 * 1024 * 1024
#: An estimate from here on means that Spark knows nothing of the size.
UNKNOWN_BYTES = 1 << 62
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def planned_bytes(df: DataFrame) -> int:
    """Spark's estimate of a frame's size; 0 if it has none."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate if estimate < UNKNOWN_BYTES else 0


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Start shuffles with partitions of about PARTITION_BYTES, and set the session back after.

    Spark merges partitions that turn out small, but does not cut ones that
    turn out large, so the number follows the input, however large.  It never
    goes below the session's own setting.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(own, -(-input_bytes // PARTITION_BYTES))
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


#: How much of a raw file a task reads: cleaned rows, sorted by key, take some eighty times as much in memory.
RAW_SPLIT_BYTES = 16 * 1024 * 1024
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Read files in splits of RAW_SPLIT_BYTES at most, and set the session back after.

    For cleaning only: sums of staged rows are smaller in all, the more rows a task has.
    """
    before = spark.conf.get(SPLIT_BYTES)
    own = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))
    spark.conf.set(SPLIT_BYTES, str(min(own, RAW_SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint folder.

    Only a local session, where every task sees the same disk, may go without
    the setting; it then has a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
