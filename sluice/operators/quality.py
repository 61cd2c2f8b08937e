"""Checks on curated data, and the report about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import Run
from sluice.operators.cleaning import COPIES, Curated
from sluice.operators.rules import is_valid, union_all

REPORT_SCHEMA = (
    "dataset_name string, metric_name string, metric_value bigint, status string, "
    "business_date string, pipeline_run_id string, reported_at timestamp"
)


class GateError(ValueError):
    """The run must not publish."""


@dataclass(frozen=True)
class Check:
    """A number that must be zero."""

    dataset: str
    metric: str
    value: int


def row_checks(allowed_severities: Sequence[str]) -> dict[str, Column]:
    """Conditions no enriched row may meet."""
    return {
        "null_vin": F.col("vin").isNull(),
        "invalid_vin_length": F.length("vin") != 17,
        "missing_model": F.col("model").isNull(),
        "invalid_severity": ~F.col("severity").isin(*allowed_severities),
        "negative_odometer": F.col("odometer_km") < 0,
    }


def count_true(condition: Column) -> Column:
    """How many rows meet a condition; 0, not NULL, for no rows."""
    return F.count(F.when(condition, 1))


def gate_metrics(
    enriched: DataFrame, allowed_severities: Sequence[str], key: Sequence[str]
) -> DataFrame:
    """All gate counts as one row, from one pass with one shuffle.

    The row conditions are counted within the grouping that finds duplicates.
    """
    checks = row_checks(allowed_severities)
    per_key = enriched.groupBy(*key).agg(
        F.count("*").alias("rows"),
        *[count_true(broken).alias(name) for name, broken in checks.items()],
    )
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("enriched_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks],
        count_true(F.col("rows") > 1).alias("duplicate_event_key"),
    )


def event_metrics(flagged: DataFrame, allowed_severities: Sequence[str], key: Sequence[str]) -> DataFrame:
    """All counts about events as one row, from one pass with one shuffle.

    ``flagged`` holds each evaluated event once, with ``_known`` set if its vehicle is known: what
    came in, was kept, rejected, is unknown or enriched, and what the gate counts on enriched rows.
    """
    known = is_valid() & F.col("_known").isNotNull()
    checks = {name: count_true(known & broken) for name, broken in row_checks(allowed_severities).items()}
    counts = {
        "input_rows": F.sum(COPIES),
        "kept_rows": F.count("*"),
        "reject_rows": count_true(~is_valid()),
        "unknown_rows": count_true(is_valid() & F.col("_known").isNull()),
        "enriched_rows": count_true(known),
        **checks,
    }
    per_key = flagged.groupBy(*key).agg(*[value.alias(name) for name, value in counts.items()])
    return per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        count_true(F.col("enriched_rows") > 1).alias("duplicate_event_key"),
    )


def one_row(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One-row frames of counts as a single row; a column is called after its frame and its name.

    Each frame is computed once, whatever is then made of the row.
    """
    names = {f"{prefix}_{c}": (prefix, c) for prefix, df in frames.items() for c in df.columns}
    facts = union_all(
        [
            df.select(
                F.inline(
                    F.array(*[F.struct(F.lit(f"{prefix}_{c}").alias("fact"), F.col(c).cast("bigint").alias("n")) for c in df.columns])
                )
            )
            for prefix, df in frames.items()
        ]
    )
    return facts.agg(
        *[F.coalesce(F.max(F.when(F.col("fact") == name, F.col("n"))), F.lit(0)).alias(name) for name in names]
    )


def listed(row: DataFrame, checks: Mapping[str, Mapping[str, Column]], counts: Mapping[str, Column]) -> DataFrame:
    """Report rows out of one row: checks by dataset, which fail above zero, and plain counts."""
    entries = [
        (dataset, metric, value, F.when(value > 0, "FAILED").otherwise("PASSED"))
        for dataset, metrics in checks.items()
        for metric, value in metrics.items()
    ]
    entries += [("pipeline", metric, value, F.lit("INFO")) for metric, value in counts.items()]
    structs = [
        F.struct(
            F.lit(dataset).alias("dataset_name"),
            F.lit(metric).alias("metric_name"),
            value.cast("bigint").alias("metric_value"),
            status.alias("status"),
        )
        for dataset, metric, value, status in entries
    ]
    return row.select(F.inline(F.array(*structs)))


def _side_by_side(counts: Mapping[str, DataFrame]) -> DataFrame:
    """One-row frames with a column ``n`` as the columns of one row."""
    tagged = [df.select(F.lit(name).alias("side"), "n") for name, df in counts.items()]
    return union_all(tagged).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("side") == name, F.col("n"))), F.lit(0)).alias(name)
            for name in counts
        ]
    )


def reconcile(detail: DataFrame, summary: DataFrame, count_column: str) -> DataFrame:
    """Detail rows against the sum of the summary's counts."""
    both = _side_by_side(
        {
            "detail_rows": detail.agg(F.count("*").alias("n")),
            "summary_rows": summary.agg(F.sum(count_column).alias("n")),
        }
    )
    delta = F.abs(F.col("detail_rows") - F.col("summary_rows"))
    return both.withColumn("summary_reconciliation_delta", delta)


def count_delta(staging: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """Row counts of a staged slice and of the table it was loaded into."""
    both = _side_by_side(
        {
            "staging_row_count": staging.agg(F.count("*").alias("n")),
            "target_row_count": target.agg(F.count("*").alias("n")),
        }
    )
    return both.select(
        F.lit(table).alias("table_name"),
        "staging_row_count",
        "target_row_count",
        (F.col("target_row_count") - F.col("staging_row_count")).alias("row_count_delta"),
    )


def slice_counts(tables: Mapping[str, DataFrame], business_date: str) -> DataFrame:
    """Rows of one date per table."""
    counted = [
        df.filter(F.col("business_date") == business_date).agg(
            F.lit(name).alias("table_name"),
            F.lit(business_date).alias("business_date"),
            F.count("*").alias("row_count"),
        )
        for name, df in tables.items()
    ]
    return union_all(counted)


def curated_counts(curated: Curated) -> DataFrame:
    """Input, kept and rejected rows of one dataset, from its evaluated frame."""
    return curated.evaluated.agg(
        F.lit(curated.spec.name).alias("dataset_name"),
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("input_rows"),
        F.count("*").alias("kept_rows"),
        count_true(~is_valid()).alias("reject_rows"),
    )


def reject_rate(counts: Sequence[DataFrame], unknown: DataFrame, max_rate: float) -> DataFrame:
    """Rejected over input rows of the whole run, and whether that is too much.

    ``counts`` are results of :func:`curated_counts`; rows with an unknown
    reference count as rejects on top.
    """
    late = unknown.agg(
        F.lit("reference").alias("dataset_name"),
        F.lit(0).cast("bigint").alias("input_rows"),
        F.lit(0).cast("bigint").alias("kept_rows"),
        F.count("*").alias("reject_rows"),
    )
    total = union_all([*counts, late]).agg(
        F.sum("input_rows").alias("input_rows"), F.sum("reject_rows").alias("reject_rows")
    )
    rate = F.when(F.col("input_rows") > 0, F.col("reject_rows") / F.col("input_rows")).otherwise(0.0)
    return total.withColumn("reject_rate", rate).withColumn("too_high", F.col("reject_rate") > max_rate)


def rate_checks(input_rows: int, reject_rows: int, max_rate: float) -> list[Check]:
    """The reject-rate check; it appears in the report only when broken."""
    rate = reject_rows / input_rows if input_rows else 0
    return [Check("pipeline", "reject_rate_threshold_exceeded", 1)] if rate > max_rate else []


def enforce(checks: Sequence[Check]) -> None:
    """Stop the run if any check is not zero."""
    failed = [c for c in checks if c.value > 0]
    if failed:
        raise GateError(
            "not published: " + ", ".join(f"{c.dataset}.{c.metric}={c.value}" for c in failed)
        )


def quality_report(
    spark: SparkSession, checks: Sequence[Check], counts: Mapping[str, int], run: Run
) -> DataFrame:
    """Long form: one row per check and per count of this run."""
    stamp = (run.business_date, run.run_id, run.started_at)
    rows = [
        (c.dataset, c.metric, c.value, "FAILED" if c.value > 0 else "PASSED", *stamp) for c in checks
    ]
    rows += [("pipeline", name, value, "INFO", *stamp) for name, value in counts.items()]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def long_form(metrics: DataFrame, dataset: str, status: str | None = None) -> DataFrame:
    """A one-row frame of counts as report rows, without leaving Spark."""
    entries = [
        F.struct(F.lit(name).alias("metric_name"), F.col(name).cast("bigint").alias("metric_value"))
        for name in metrics.columns
    ]
    rows = metrics.select(F.inline(F.array(*entries)))
    verdict = F.when(F.col("metric_value") > 0, "FAILED").otherwise("PASSED")
    return rows.select(
        F.lit(dataset).alias("dataset_name"),
        "metric_name",
        "metric_value",
        (F.lit(status) if status else verdict).alias("status"),
    )


def quality_listing(report: DataFrame, business_date: str) -> DataFrame:
    """The quality report of one date, newest first."""
    columns = [field.strip().split(" ")[0] for field in REPORT_SCHEMA.split(",")]
    return (
        report.filter(F.col("business_date") == business_date)
        .select(*columns)
        .orderBy(F.desc("reported_at"))
    )
