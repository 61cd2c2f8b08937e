"""One query per operator and per job, over the raw views."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import cache

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import Run, configure, scratch_root
from sluice.domains import vehicles as domain
from sluice.domains.sales import CLEAN_SALES
from sluice.functions import (
    hours_between,
    norm_code,
    norm_id,
    nullify,
    title_case,
    to_dt,
    to_flag,
    to_number,
    to_ts,
    trim_upper,
)
from sluice.operators import measures, quality
from sluice.operators.cleaning import COPIES, nullify_strings
from sluice.operators.dedupe import duplicate_keys
from sluice.operators.joins import latest_service, lookup
from sluice.operators.rules import REASON, reason_counts, reason_list
from sluice.plans.health import Curation, RawTables, run_health
from sluice.plans.sales import run_sales
from sluice.plans.warehouse import (
    Validation,
    analytics_table,
    load_warehouse,
    staging_table,
)
from sluice.paths import join_path
from sluice.sinks.files import FORMAT_OPTIONS, publish, remove_folder, stage
from sluice.sinks.loads import commit_load, finish_load, write_part
from sluice.sinks.tables import (
    create_view,
    discovered_partitions,
    ensure_table,
    full_name,
    load_slice,
    partition_diff,
    recover_partitions,
    register_all,
    register_partitions,
    registered_partitions,
    revenue_view_sql,
    risk_view_sql,
)
from sluice.sources.archives import check_archives, list_members, read_archived_csv
from sluice.sources.files import read_raw_csv, read_sales, read_slice
from verification.fixture_archives import write_archives
from verification.oracle import BUSINESS_DATE, EARLIER_DATE, RUN_ID, RUN_TIME, SOURCE_ZIP
from verification.views import ORDER_BY, RAW_VIEWS, TABLES

RUN = Run(
    BUSINESS_DATE,
    RUN_ID,
    datetime.fromisoformat(RUN_TIME).replace(tzinfo=timezone.utc),
    SOURCE_ZIP,
)
# The raw views break rules in about three rows out of ten, on purpose.
JOB_REJECT_RATE = 0.5

Query = Callable[[SparkSession, str], DataFrame]


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its schema is looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw view over the tables of a folder."""
    configure(spark)
    sql = RAW_VIEWS[name]
    used = [t for t in TABLES if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    def raw(name: str, spec: domain.Dataset) -> DataFrame:
        return view(spark, sf_dir, name).withColumn("source_file", F.lit(spec.file_name))

    return RawTables(
        raw("raw_telemetry", domain.TELEMETRY),
        raw("raw_service", domain.SERVICE),
        raw("raw_vehicle", domain.VEHICLES),
        raw("raw_dealer", domain.DEALERS),
        ORDER_BY,
    )


def curation(spark: SparkSession, sf_dir: str) -> Curation:
    return Curation(raw_tables(spark, sf_dir), RUN)


def report(spark: SparkSession, sf_dir: str) -> Curation:
    """For queries that ask several things of the same rows: what is shared is staged once."""
    return Curation(raw_tables(spark, sf_dir), RUN, new_folder(spark, "report"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, on shared storage."""
    return join_path(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


# --- column functions -------------------------------------------------------


def nullify_strings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nullify_strings(view(spark, sf_dir, "raw_telemetry"))


def norm_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vin = norm_id(nullify(F.col("vin")))
    return view(spark, sf_dir, "raw_telemetry").select(
        "event_id", "copy_no", vin.alias("vin"), F.length(vin).alias("vin_length")
    )


def clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    odometer, cost = nullify(F.col("odometer_km")), nullify(F.col("parts_cost"))
    telemetry = view(spark, sf_dir, "raw_telemetry").select(
        F.lit("telemetry").alias("source"),
        F.col("event_id").alias("row_key"),
        "copy_no",
        to_number(odometer).alias("as_double"),
        to_number(odometer, "decimal(12,2)").alias("as_decimal"),
        to_number(odometer, "int").alias("as_int"),
    )
    service = view(spark, sf_dir, "raw_service").select(
        F.lit("service").alias("source"),
        F.col("o_orderkey").alias("row_key"),
        "copy_no",
        to_number(cost).alias("as_double"),
        to_number(cost, "decimal(12,2)").alias("as_decimal"),
        F.lit(None).cast("int").alias("as_int"),
    )
    return telemetry.unionByName(service)


def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, start = nullify(F.col("event_timestamp")), nullify(F.col("warranty_start_date"))
    telemetry = view(spark, sf_dir, "raw_telemetry").select(
        F.lit("telemetry").alias("source"),
        F.col("event_id").alias("row_key"),
        "copy_no",
        to_ts(event).alias("as_timestamp"),
        F.to_date(to_ts(event)).alias("as_date"),
    )
    vehicle = view(spark, sf_dir, "raw_vehicle").select(
        F.lit("vehicle").alias("source"),
        F.col("c_custkey").alias("row_key"),
        F.lit(0).alias("copy_no"),
        to_ts(start).alias("as_timestamp"),
        to_dt(start).alias("as_date"),
    )
    return telemetry.unionByName(vehicle)


def norm_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "raw_service").select(
        "o_orderkey",
        "copy_no",
        norm_code(nullify(F.col("service_type"))).alias("service_type"),
        norm_code(nullify(F.col("service_status"))).alias("service_status"),
        trim_upper(nullify(F.col("dealer_id"))).alias("dealer_id"),
    )


def title_case_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "raw_vehicle").select(
        "c_custkey", title_case(nullify(F.col("model"))).alias("model")
    )


def flags_and_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = to_flag(nullify(F.col("warranty_flag")))
    opened = to_ts(nullify(F.col("service_open_timestamp")))
    closed = to_ts(nullify(F.col("service_close_timestamp")))
    return view(spark, sf_dir, "raw_service").select(
        "o_orderkey",
        "copy_no",
        flag.alias("warranty_flag"),
        flag.cast("double").alias("warranty_number"),
        hours_between(opened, closed).alias("hours"),
    )


# --- dedupe, rules, rejects -------------------------------------------------

STAMPS = ("business_date", "source_zip", "pipeline_run_id", "ingested_at")


def deduped(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = getattr(curation(spark, sf_dir), name).evaluated
        return rows.drop(*STAMPS, REASON).withColumnRenamed(COPIES, "copies")

    return query


def dedupe_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry that does not say which copy came first: a value beats none."""
    raw = raw_tables(spark, sf_dir)
    raw = replace(raw, telemetry=raw.telemetry.drop(*ORDER_BY["telemetry"]), order_by={})
    rows = Curation(raw, RUN).telemetry.evaluated
    return rows.drop(*STAMPS, REASON).withColumnRenamed(COPIES, "copies")


def cleaned(name: str) -> Query:
    return lambda spark, sf_dir: getattr(curation(spark, sf_dir), name).valid


def rejected(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        curated = getattr(curation(spark, sf_dir), name)
        return curated.invalid.select(
            *curated.spec.keys, REASON, F.size(reason_list()).alias("n_reasons")
        )

    return query


def reject_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected telemetry with what its numbers and time were as text, also where that could not be read."""
    c = replace(curation(spark, sf_dir), keep_raw=True)
    raw = c.rejects.filter(F.col("dataset_name") == domain.TELEMETRY.name)
    fields = ("vin", "event_timestamp", "odometer_km", "engine_temp_c", "oil_pressure_kpa", "severity")
    return raw.select(REASON, *[F.get_json_object("raw_json", f"$.{c}").alias(c) for c in fields])


def unknown_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation(spark, sf_dir).unknown.drop(*STAMPS)


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(view(spark, sf_dir, "raw_telemetry"), domain.EVENT_KEY)


# --- summaries --------------------------------------------------------------


def rounded(story: DataFrame) -> DataFrame:
    """Averages of averages differ in their last bit by the order of addition."""
    return story.withColumns(
        {c: F.round(c, 10) for c in ("avg_battery_voltage", "avg_engine_temp_c")}
    )


def risk_story(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.risk_story(curation(spark, sf_dir).daily_summary))


def risk_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    story = measures.risk_story(curation(spark, sf_dir).daily_summary)
    return measures.risk_listing(story, BUSINESS_DATE)


def revenue_columns(revenue: DataFrame) -> DataFrame:
    return revenue.withColumn("total_revenue", F.col("total_revenue").cast("double"))


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_columns(measures.daily_revenue(view(spark, sf_dir, "clean_sales")))


# --- quality ----------------------------------------------------------------


def gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = curation(spark, sf_dir).enriched
    return quality.gate_metrics(enriched, domain.SEVERITIES, domain.EVENT_KEY)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = curation(spark, sf_dir)
    return quality.reconcile(c.enriched, c.daily_summary, "telemetry_event_count")


def dataset_counts(c: Curation) -> list[DataFrame]:
    return [quality.curated_counts(d) for d in (c.telemetry, c.service, c.vehicles, c.dealers)]


def reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = curation(spark, sf_dir)
    return quality.reject_rate(dataset_counts(c), c.unknown, 0.10)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report out of one row of counts, which one pass over each staged table gives."""
    c = report(spark, sf_dir)
    tables = {"service": c.service, "vehicle": c.vehicles, "dealer": c.dealers}
    row = quality.one_row(
        {
            "event": quality.event_metrics(c.events, domain.SEVERITIES, domain.EVENT_KEY),
            **{name: quality.curated_counts(t).drop("dataset_name") for name, t in tables.items()},
            "summary": c.daily_summary.agg(
                F.count("*").alias("rows"), F.sum("telemetry_event_count").alias("events")
            ),
            "kpi": c.service_kpis.agg(F.count("*").alias("rows")),
        }
    )

    def total(metric: str) -> Column:
        return sum((F.col(f"{name}_{metric}") for name in tables), F.col(f"event_{metric}"))

    gate = (*quality.row_checks(domain.SEVERITIES), "duplicate_event_key")
    delta = F.abs(F.col("event_enriched_rows") - F.col("summary_events"))
    return quality.listed(
        row,
        {
            "vehicle_health_enriched": {name: F.col(f"event_{name}") for name in gate},
            "daily_vehicle_health_summary": {"summary_reconciliation_delta": delta},
        },
        {
            "telemetry_input_rows": F.col("event_input_rows"),
            "service_input_rows": F.col("service_input_rows"),
            "vehicle_master_input_rows": F.col("vehicle_input_rows"),
            "dealer_master_input_rows": F.col("dealer_input_rows"),
            "duplicates_dropped": total("input_rows") - total("kept_rows"),
            "vehicle_health_enriched_rows": F.col("event_enriched_rows"),
            "daily_summary_rows": F.col("summary_rows"),
            "service_summary_rows": F.col("kpi_rows"),
            "reject_rows": total("reject_rows") + F.col("event_unknown_rows"),
        },
    )


# --- sources and sinks ------------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "csv")
    dealers = view(spark, sf_dir, "raw_dealer").select(*domain.DEALER_COLUMNS)
    dealers.write.options(**FORMAT_OPTIONS["csv"]).csv(folder)
    return read_raw_csv(
        spark, folder, domain.DEALER_COLUMNS, domain.DEALERS.file_name, check_header=True
    )


def archive_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    rows = view(spark, sf_dir, "raw_telemetry").select(*domain.TELEMETRY_COLUMNS)
    write_archives(rows, folder, domain.TELEMETRY.file_name)
    members = list_members(spark, join_path(folder, "*.zip"))
    check_archives(members, [domain.TELEMETRY.file_name])
    return read_archived_csv(
        spark, members, domain.TELEMETRY.file_name, domain.TELEMETRY_COLUMNS
    ).drop("source_zip", "line_no")


SUMMARY = domain.OUTPUTS["daily_vehicle_health_summary"]
KPIS = domain.OUTPUTS["service_kpi_summary"]
ENRICHED = domain.OUTPUTS["vehicle_health_enriched"]


def slice_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates are written, then one is written again with fewer rows."""
    root = new_folder(spark, "slices")
    summary = curation(spark, sf_dir).daily_summary
    for day in (EARLIER_DATE, BUSINESS_DATE):
        publish(summary.withColumn("business_date", F.lit(day)), root, SUMMARY, day)
    rewritten = summary.filter(F.col("severity").isin("HIGH", "CRITICAL"))
    publish(rewritten, root, SUMMARY, BUSINESS_DATE)
    days = [
        read_slice(spark, root, SUMMARY.name, SUMMARY.schema, day)
        for day in (EARLIER_DATE, BUSINESS_DATE)
    ]
    return quality.union_all(days)


def slice_failed_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date is written, and a rewrite of it fails after it has written files: the date is as it was."""
    root = new_folder(spark, "slices")
    summary = curation(spark, sf_dir).daily_summary
    publish(summary, root, SUMMARY, BUSINESS_DATE)
    broken = F.when(F.col("severity") == "CRITICAL", F.raise_error("lost")).otherwise(F.col("severity"))
    try:
        publish(summary.withColumn("severity", broken.cast("string")), root, SUMMARY, BUSINESS_DATE)
    except PySparkException:
        pass
    return read_slice(spark, root, SUMMARY.name, SUMMARY.schema, BUSINESS_DATE)


def staged_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service figures as files, for queries that write them several times."""
    return stage(curation(spark, sf_dir).service_kpis, new_folder(spark, "report"), KPIS.name)


def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs append to a date, and the first one is repeated: each is there once."""
    root = new_folder(spark, "modes")
    kpis = staged_kpis(spark, sf_dir)
    for run_id in ("run-a", "run-b", "run-a"):
        publish(kpis, root, KPIS, BUSINESS_DATE, "append", run_id=run_id)
    return read_slice(spark, root, KPIS.name, KPIS.schema, BUSINESS_DATE)


def published(spark: SparkSession, sf_dir: str) -> str:
    """The enriched rows and both summaries of the run's date, as files."""
    root = new_folder(spark, "published")
    c = report(spark, sf_dir)
    publish(c.enriched, root, ENRICHED, BUSINESS_DATE)
    publish(c.daily_summary, root, SUMMARY, BUSINESS_DATE)
    publish(c.service_kpis, root, KPIS, BUSINESS_DATE)
    return root


def loaded(spark: SparkSession, root: str, database: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Staging rows and analytics rows of the run's date after a load."""
    staging = staging_table(spark, f"{database}_staging", name, root, BUSINESS_DATE)
    target = analytics_table(spark, database, name, new_folder(spark, name))
    columns = domain.OUTPUTS[name].partitioned("business_date").data_schema.names
    # Twice: the second load must replace the first.
    for _ in range(2):
        load_slice(spark, spark.table(staging), target, columns, BUSINESS_DATE)
    return spark.table(staging), spark.table(target)


def new_database(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


def table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "published")
    publish(curation(spark, sf_dir).service_kpis, root, KPIS, BUSINESS_DATE)
    return loaded(spark, root, new_database("load"), KPIS.name)[1]


def loaded_tables(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    root, database = published(spark, sf_dir), new_database("load")
    return {s.name: loaded(spark, root, database, s.name) for s in (ENRICHED, SUMMARY, KPIS)}


def slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: target for name, (_, target) in loaded_tables(spark, sf_dir).items()}
    return quality.slice_counts(tables, BUSINESS_DATE)


def count_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union_all(
        [
            quality.count_delta(staging, target, name)
            for name, (staging, target) in loaded_tables(spark, sf_dir).items()
        ]
    )


def warehouse_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load is committed and stops before any table is swapped; what comes next ends it."""
    root, target = health_run(spark, sf_dir), new_folder(spark, "warehouse")
    slice_name, specs = f"business_date={BUSINESS_DATE}", [domain.OUTPUTS[n] for n in domain.ANALYTICS_TABLES]
    parts = [
        write_part(target, s.name, slice_name, read_slice(spark, root, s.name, s.schema, BUSINESS_DATE).drop("business_date"))
        for s in specs
    ]
    commit_load(spark, target, slice_name, parts)
    finish_load(spark, target, slice_name)
    tables = {s.name: read_slice(spark, target, s.name, s.schema, BUSINESS_DATE) for s in specs}
    return quality.slice_counts(tables, BUSINESS_DATE)


def partition_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates are registered, the folder of one goes: the catalog follows."""
    root, database = new_folder(spark, "published"), new_database("partitions")
    summary = curation(spark, sf_dir).daily_summary
    path = join_path(root, SUMMARY.name)
    table = ensure_table(spark, database, SUMMARY, path)
    for day in (EARLIER_DATE, BUSINESS_DATE):
        publish(summary.withColumn("business_date", F.lit(day)), root, SUMMARY, day)
    register_partitions(spark, table, path, SUMMARY.partition_by)
    remove_folder(spark, join_path(path, f"business_date={BUSINESS_DATE}"))
    register_partitions(spark, table, path, SUMMARY.partition_by, drop_vanished=True)
    return spark.table(table)


def hot_vehicle_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events looked up by vehicle, where one vehicle has a third of them."""
    c = curation(spark, sf_dir)
    vehicles = c.vehicles.valid.select("vin", F.lit(1).alias("known"))
    found = lookup(c.telemetry.evaluated.select("vin"), vehicles, "vin")
    return found.groupBy("vin").agg(F.count("*").alias("events"), F.count("known").alias("found"))


def view_risk_story(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, database = new_folder(spark, "published"), new_database("views")
    publish(curation(spark, sf_dir).daily_summary, root, SUMMARY, BUSINESS_DATE)
    table = ensure_table(spark, database, SUMMARY, join_path(root, SUMMARY.name))
    recover_partitions(spark, table)
    name = full_name(database, "risk_story")
    create_view(spark, name, risk_view_sql(table))
    return rounded(spark.table(name))


def written_sales(spark: SparkSession, sf_dir: str) -> str:
    """Clean sales as a table partitioned by order date."""
    folder = new_folder(spark, "sales")
    sales = view(spark, sf_dir, "clean_sales")
    sales = sales.withColumn("total_amount", F.col("total_amount").cast("double"))
    # By ranges of dates: few tasks per date, and a busy date is cut by order.
    tasks = 2 * spark.sparkContext.defaultParallelism
    spread = sales.repartitionByRange(tasks, "order_date", "order_id")
    spread.write.partitionBy("order_date").parquet(folder)
    return folder


def view_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "sales")
    sales = view(spark, sf_dir, "clean_sales")
    sales.withColumn("total_amount", F.col("total_amount").cast("double")).write.parquet(folder)
    read_sales(spark, folder, CLEAN_SALES.schema).createOrReplaceTempView("sluice_clean_sales")
    return spark.sql(revenue_view_sql("sluice_clean_sales"))


def partition_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date is registered, another is published: the other one is new."""
    root, database = new_folder(spark, "published"), new_database("partitions")
    summary = curation(spark, sf_dir).daily_summary
    publish(summary.withColumn("business_date", F.lit(EARLIER_DATE)), root, SUMMARY, EARLIER_DATE)
    path = join_path(root, SUMMARY.name)
    table = ensure_table(spark, database, SUMMARY, path)
    recover_partitions(spark, table)
    publish(summary, root, SUMMARY, BUSINESS_DATE)
    found = discovered_partitions(spark, path, SUMMARY.partition_by)
    return partition_diff(found, registered_partitions(spark, table))


def register_partitions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates are published and registered one after the other; the rows come through the table."""
    root, database = new_folder(spark, "published"), new_database("partitions")
    summary = curation(spark, sf_dir).daily_summary
    path = join_path(root, SUMMARY.name)
    table = ensure_table(spark, database, SUMMARY, path)
    publish(summary.withColumn("business_date", F.lit(EARLIER_DATE)), root, SUMMARY, EARLIER_DATE)
    register_partitions(spark, table, path, SUMMARY.partition_by)
    publish(summary, root, SUMMARY, BUSINESS_DATE)
    register_partitions(spark, table, path, SUMMARY.partition_by, BUSINESS_DATE)
    return spark.table(table)


def register_moved_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is registered, then published to another root and registered again."""
    database = new_database("moved")
    summary = curation(spark, sf_dir).daily_summary
    for rows in (summary, summary.filter(F.col("severity").isin("HIGH", "CRITICAL"))):
        root = new_folder(spark, "published")
        publish(rows, root, SUMMARY, BUSINESS_DATE)
        (table,) = register_all(spark, root, database, [SUMMARY])
    return spark.table(table)


def write_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date appended twice and then left alone, and the same date once as CSV."""
    root, csv_root = new_folder(spark, "modes"), new_folder(spark, "csv")
    kpis = staged_kpis(spark, sf_dir)
    for mode in ("append", "append", "ignore"):
        publish(kpis, root, KPIS, BUSINESS_DATE, mode)
    publish(kpis, csv_root, KPIS, BUSINESS_DATE, "errorifexists", "csv")
    appended = read_slice(spark, root, KPIS.name, KPIS.schema, BUSINESS_DATE)
    text = spark.read.schema(KPIS.schema).option("header", "true").csv(join_path(csv_root, KPIS.name))
    return appended.withColumn("written_as", F.lit("append")).unionByName(
        text.withColumn("written_as", F.lit("csv"))
    )


# --- jobs -------------------------------------------------------------------


def fresh_run() -> Run:
    return Run(BUSINESS_DATE, f"{RUN_ID}-{uuid.uuid4().hex}", RUN.started_at, SOURCE_ZIP)


def health_run(spark: SparkSession, sf_dir: str) -> str:
    """The whole health job; gives the root of what it published."""
    output = new_folder(spark, "health")
    run_health(
        spark, raw_tables(spark, sf_dir), output, fresh_run(), max_reject_rate=JOB_REJECT_RATE
    )
    return output


def health_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = domain.OUTPUTS["data_quality_report"]
    report = read_slice(spark, health_run(spark, sf_dir), spec.name, spec.schema, BUSINESS_DATE)
    return report.select("dataset_name", "metric_name", "metric_value", "status")


def validated(spark: SparkSession, sf_dir: str) -> Validation:
    """A run of the health job, loaded into the analytics tables."""
    return load_warehouse(
        spark,
        health_run(spark, sf_dir),
        new_folder(spark, "warehouse"),
        BUSINESS_DATE,
        new_database("staging"),
        new_database("analytics"),
        fail_on_delta=True,
    )


def warehouse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).deltas


def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).slice_counts


def quality_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).quality.drop("pipeline_run_id", "reported_at")


def sales_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = join_path(scratch_root(spark), "sales-")
    return run_sales(spark, written_sales(spark, sf_dir), new_database("sales"), prefix)


QUERIES: dict[str, Query] = {
    "nullify_strings": nullify_strings_query,
    "norm_ids": norm_ids,
    "clean_numbers": clean_numbers,
    "parse_times": parse_times,
    "norm_codes": norm_codes,
    "title_case": title_case_query,
    "flags_and_hours": flags_and_hours,
    "dedupe_telemetry": deduped("telemetry"),
    "dedupe_service": deduped("service"),
    "dedupe_unordered": dedupe_unordered,
    "clean_telemetry": cleaned("telemetry"),
    "clean_service": cleaned("service"),
    "clean_vehicle": cleaned("vehicles"),
    "clean_dealer": cleaned("dealers"),
    "reject_reasons_telemetry": rejected("telemetry"),
    "reject_reasons_service": rejected("service"),
    "reject_reasons_vehicle": rejected("vehicles"),
    "reject_reasons_dealer": rejected("dealers"),
    "reject_reason_counts": lambda spark, sf: reason_counts(report(spark, sf).rejects),
    "reject_envelope": lambda spark, sf: report(spark, sf).rejects,
    "reject_raw_text": reject_raw_text,
    "unknown_vehicles": unknown_vehicles,
    "hot_vehicle_lookup": hot_vehicle_lookup,
    "latest_service": lambda spark, sf: latest_service(curation(spark, sf).service.valid),
    "enriched": lambda spark, sf: curation(spark, sf).enriched,
    "daily_summary": lambda spark, sf: curation(spark, sf).daily_summary,
    "repeat_offenders": lambda spark, sf: measures.repeat_offenders(curation(spark, sf).enriched),
    "service_kpis": lambda spark, sf: curation(spark, sf).service_kpis,
    "risk_story": risk_story,
    "risk_listing": risk_listing,
    "daily_revenue": daily_revenue,
    "duplicate_keys": duplicates,
    "gate_metrics": gate_metrics,
    "reconcile": reconcile,
    "reject_rate": reject_rate,
    "quality_report": quality_report,
    "slice_counts": slice_counts,
    "count_delta": count_delta,
    "csv_roundtrip": csv_roundtrip,
    "archive_ingest": archive_ingest,
    "slice_overwrite": slice_overwrite,
    "slice_failed_rewrite": slice_failed_rewrite,
    "append_rerun": append_rerun,
    "table_load": table_load,
    "warehouse_resume": warehouse_resume,
    "view_risk_story": view_risk_story,
    "view_daily_revenue": view_daily_revenue,
    "partition_diff": partition_diff_query,
    "register_partitions": register_partitions_query,
    "partition_sync": partition_sync,
    "register_moved_root": register_moved_root,
    "write_modes": write_modes,
    "health_job": health_job,
    "warehouse_job": warehouse_job,
    "warehouse_counts": warehouse_counts,
    "quality_listing": quality_listing,
    "sales_job": sales_job,
}
