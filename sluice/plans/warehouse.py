"""Loading a published date into the analytics tables, and checking the load."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import configure
from sluice.domains.vehicles import ANALYTICS_TABLES, OUTPUTS
from sluice.operators.measures import risk_listing
from sluice.operators.quality import GateError, count_delta, quality_listing, slice_counts
from sluice.operators.rules import union_all
from sluice.plans.health import together
from sluice.paths import join_path
from sluice.sinks.loads import load_together
from sluice.sinks.swap import readable_folder
from sluice.sinks.tables import (
    create_view,
    ensure_table,
    full_name,
    register_partitions,
    recover_partitions,
    risk_view_sql,
)

RISK_VIEW = "vehicle_health_risk_story"


@dataclass(frozen=True)
class Validation:
    """What the reader of a load wants to see; all lazy."""

    slice_counts: DataFrame
    deltas: DataFrame
    quality: DataFrame
    risk: DataFrame


def staging_table(spark: SparkSession, database: str, name: str, root: str, business_date: str) -> str:
    """An external table over one published date, made anew and named by it.

    A load of another date does not touch it, so the counts of this one stay true.

    It lies on the folder of that date, so only that folder is searched for
    partitions, however long the history is.
    """
    spec = replace(OUTPUTS[name].without("business_date"), name=f"{name}_parquet_{business_date.replace('-', '_')}")
    folder = readable_folder(spark, join_path(root, name), f"business_date={business_date}")
    table = ensure_table(spark, database, spec, folder, recreate=True)
    if spec.partition_by:
        recover_partitions(spark, table)
    return table


def analytics_table(spark: SparkSession, database: str, name: str, root: str) -> str:
    spec = OUTPUTS[name].partitioned("business_date")
    return ensure_table(spark, database, spec, join_path(root, name))


def load_warehouse(
    spark: SparkSession,
    curated_root: str,
    warehouse_root: str,
    business_date: str,
    staging_db: str = "staging",
    analytics_db: str = "analytics",
    fail_on_delta: bool = False,
) -> Validation:
    """Replace one date in all analytics tables as one unit, and compare the row counts.

    A load that stopped is ended or forgotten by the next one of its date (see ``sluice.sinks.loads``).
    """
    configure(spark)
    slice_name = f"business_date={business_date}"

    def staged(name: str) -> DataFrame:
        return spark.table(staging_table(spark, staging_db, name, curated_root, business_date))

    staging = dict(zip(ANALYTICS_TABLES, together(*[lambda n=n: staged(n) for n in ANALYTICS_TABLES])))
    columns = {n: OUTPUTS[n].partitioned("business_date").data_schema.names for n in ANALYTICS_TABLES}
    rows = {name: df.select(*columns[name]) for name, df in staging.items()}
    load_together(spark, warehouse_root, slice_name, rows, together)

    def registered(name: str) -> str:
        table = analytics_table(spark, analytics_db, name, warehouse_root)
        register_partitions(spark, table, join_path(warehouse_root, name), ["business_date"], business_date)
        return table

    targets = {
        name: spark.table(table)
        for name, table in zip(ANALYTICS_TABLES, together(*[lambda n=n: registered(n) for n in ANALYTICS_TABLES]))
    }
    deltas = [
        count_delta(staging[name], targets[name].filter(F.col("business_date") == business_date), name)
        for name in ANALYTICS_TABLES
    ]
    view = full_name(analytics_db, RISK_VIEW)
    create_view(
        spark, view, risk_view_sql(full_name(analytics_db, "daily_vehicle_health_summary"))
    )
    all_deltas = union_all(deltas)
    if fail_on_delta:
        wrong = all_deltas.filter("row_count_delta <> 0").collect()
        if wrong:
            raise GateError(f"rows lost in the load: {[row.asDict() for row in wrong]}")
    return Validation(
        slice_counts(targets, business_date),
        all_deltas,
        quality_listing(targets["data_quality_report"], business_date),
        risk_listing(spark.table(view), business_date),
    )
