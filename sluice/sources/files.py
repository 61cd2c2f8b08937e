"""CSV and Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.paths import join_path
from sluice.sinks.swap import readable_folder
from sluice.sources.schema import text_schema


def input_path(root: str, business_date: str) -> str:
    """Where the archive of a date lies; ``*`` stands for all dates."""
    return join_path(root, f"vehicle_health_{business_date.replace('-', '_')}.zip")


def stored_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """The size of files or folders; they are listed, not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    source_file: str,
    sep: str = ",",
    check_header: bool = False,
) -> DataFrame:
    """Text columns bound by position, plus where they came from.

    Short rows end in NULLs, extra fields are dropped.  ``check_header`` makes
    a file whose header differs from ``columns`` an error.
    """
    raw = (
        spark.read.schema(text_schema(columns))
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("sep", sep)
        .option("enforceSchema", str(not check_header).lower())
        .csv(path)
    )
    return raw.withColumn("source_file", F.lit(source_file))


def read_slice(
    spark: SparkSession, root: str, table: str, schema: StructType, business_date: str
) -> DataFrame:
    """One date of a published table.

    Only the folder of that date is listed, and partition values keep their
    declared type instead of an inferred one.  A slice whose publish stopped after its files were
    complete is read from where these are.
    """
    base, name = join_path(root, table), f"business_date={business_date}"
    folder = readable_folder(spark, base, name)
    if folder == join_path(base, name):
        return spark.read.schema(schema).option("basePath", base).parquet(folder)
    rows = spark.read.schema(StructType([f for f in schema.fields if f.name != "business_date"])).parquet(folder)
    return rows.withColumn("business_date", F.lit(business_date)).select(*schema.names)


def read_sales(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The clean sales table, partitioned by order date."""
    return spark.read.schema(schema).parquet(path)
