"""Sales summary: a table over clean sales and a revenue view on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.context import configure
from sluice.domains.sales import CLEAN_SALES, REVENUE_VIEW
from sluice.sinks.tables import (
    create_view,
    ensure_table,
    full_name,
    recover_partitions,
    revenue_view_sql,
)

PATH_PREFIX = "s3a://"


def validate_config(database: str, *paths: str, prefix: str = PATH_PREFIX) -> None:
    """Paths must be where the platform keeps data, and a database be named."""
    for path in paths:
        if not path.startswith(prefix):
            raise ValueError(f"{path!r} must start with {prefix}")
    if not database.strip():
        raise ValueError("a database name is required")


def run_sales(
    spark: SparkSession, clean_path: str, database: str, prefix: str = PATH_PREFIX
) -> DataFrame:
    """Register clean sales with all its dates, and give revenue by order date."""
    validate_config(database, clean_path, prefix=prefix)
    configure(spark)
    table = ensure_table(spark, database, CLEAN_SALES, clean_path)
    recover_partitions(spark, table)
    view = full_name(database, REVENUE_VIEW)
    create_view(spark, view, revenue_view_sql(table))
    return spark.table(view)
