"""Health curation: four raw tables to seven published ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.context import Run, configure, planned_bytes, scratch_root, sized_shuffles, small_splits
from sluice.domains import vehicles as domain
from sluice.operators import measures
from sluice.operators.cleaning import COPIES, Curated, curate
from sluice.operators.dedupe import duplicate_keys
from sluice.operators.joins import (
    BROADCAST_BYTES,
    attach_profile,
    enrich,
    lookup,
    unknown_refs,
    vehicle_profile,
)
from sluice.operators.quality import (
    Check,
    GateError,
    count_true,
    enforce,
    quality_report,
    rate_checks,
    row_checks,
)
from sluice.operators.rules import DATASET, RAW, REASON, is_valid, reject_envelope, union_all
from sluice.sinks.files import publish, remove_folder, stage
from sluice.sinks.tables import register_all
from sluice.sources.files import join_path

MAX_REJECT_RATE = 0.10
#: Where below the output root the report of a stopped run goes.
FAILED = "failed"


@dataclass(frozen=True)
class RawTables:
    """The raw text tables of a run, which columns say what came first, and how
    many bytes they hold; when that is not given, Spark's own estimate is taken."""

    telemetry: DataFrame
    service: DataFrame
    vehicles: DataFrame
    dealers: DataFrame
    order_by: Mapping[str, Sequence[str]] = field(default_factory=dict)
    input_bytes: int = 0

    def bytes(self) -> int:
        frames = (self.telemetry, self.service, self.vehicles, self.dealers)
        return self.input_bytes or sum(map(planned_bytes, frames))

    def curated(self, name: str, spec: domain.Dataset, run: Run, keep_raw: bool = False) -> Curated:
        return curate(getattr(self, name), spec, run, self.order_by.get(name, ()), keep_raw)


def event_rejects(flagged: DataFrame, columns: Sequence[str], run: Run) -> DataFrame:
    """Envelopes of rejected events, those of unknown vehicles among them, from one pass.

    ``flagged`` holds each evaluated event once, with ``_known`` set if its vehicle is in the master table.
    """
    unknown = is_valid() & F.col("_known").isNull()
    kept = flagged.filter(~is_valid() | unknown)
    reason = F.when(unknown, domain.UNKNOWN_VEHICLE).otherwise(F.col(REASON))
    dataset = F.when(unknown, domain.UNKNOWN_VEHICLE_DATASET).otherwise(domain.TELEMETRY.name)
    raw = [RAW] if RAW in flagged.columns else []
    named = kept.select(*columns, reason.alias(REASON), dataset.alias(DATASET), *raw)
    return reject_envelope(named, F.col(DATASET), run)


def all_rejects(invalid: Mapping[str, DataFrame], events: DataFrame, run: Run) -> DataFrame:
    """Rejects of every dataset and kind in one frame."""
    return union_all([*[reject_envelope(df, name, run) for name, df in invalid.items()], events])


@dataclass(frozen=True)
class Curation:
    """Every intermediate result of the health job as a lazy frame.

    For queries that want one result: each is one plan of its own.  A report wants many results
    of the same rows: with a ``scratch`` folder what several results share is staged there when it is first asked
    for, so each raw table is read once, whatever the report asks.
    """

    raw: RawTables
    run: Run
    scratch: str | None = None
    keep_raw: bool = False

    def _curated(self, name: str, spec: domain.Dataset) -> Curated:
        curated = self.raw.curated(name, spec, self.run, self.keep_raw)
        if self.scratch is None:
            return curated
        return Curated(spec, self.run, self._staged_raw(curated.evaluated, name))

    def _staged_raw(self, df: DataFrame, name: str) -> DataFrame:
        with small_splits(df.sparkSession):
            return stage(df, self.scratch, name)

    @cached_property
    def telemetry(self) -> Curated:
        if self.scratch is None:
            return self._curated("telemetry", domain.TELEMETRY)
        return Curated(domain.TELEMETRY, self.run, self.events.select(*self.telemetry_columns, *self.marks))

    @cached_property
    def service(self) -> Curated:
        return self._curated("service", domain.SERVICE)

    @cached_property
    def vehicles(self) -> Curated:
        return self._curated("vehicles", domain.VEHICLES)

    @cached_property
    def dealers(self) -> Curated:
        return self._curated("dealers", domain.DEALERS)

    @cached_property
    def _raw_telemetry(self) -> Curated:
        return self.raw.curated("telemetry", domain.TELEMETRY, self.run, self.keep_raw)

    @property
    def marks(self) -> list[str]:
        return [c for c in self._raw_telemetry.evaluated.columns if c in (COPIES, REASON, RAW)]

    @property
    def telemetry_columns(self) -> list[str]:
        return [c for c in self._raw_telemetry.evaluated.columns if c not in (COPIES, REASON, RAW)]

    @cached_property
    def events(self) -> DataFrame:
        """Each evaluated event once, with the profile of its vehicle and ``_known``."""
        profile = vehicle_profile(self.service.valid, self.vehicles.valid, self.dealers.valid)
        events = attach_profile(self._raw_telemetry.evaluated, profile.withColumn("_known", F.lit(True)), "left")
        return self._staged_raw(events, "events") if self.scratch else events

    @cached_property
    def flagged(self) -> DataFrame:
        """Each evaluated event once, with ``_known``."""
        if self.scratch:
            return self.events
        known = self.vehicles.valid.select("vin").withColumn("_known", F.lit(True))
        return lookup(self._raw_telemetry.evaluated, known, "vin")

    @cached_property
    def enriched(self) -> DataFrame:
        if self.scratch:
            rows = self.events.filter(is_valid() & F.col("_known").isNotNull())
        else:
            rows = enrich(
                self.telemetry.valid,
                self.service.valid,
                self.vehicles.valid,
                self.dealers.valid,
            )
        return rows.select(*domain.OUTPUTS["vehicle_health_enriched"].schema.names)

    @cached_property
    def unknown(self) -> DataFrame:
        if self.scratch:
            return self.events.filter(is_valid() & F.col("_known").isNull()).select(*self.telemetry_columns)
        return unknown_refs(self.telemetry.valid, self.vehicles.valid, "vin")

    @cached_property
    def daily_summary(self) -> DataFrame:
        summary = measures.daily_summary(self.enriched)
        return stage(summary, self.scratch, "daily_summary") if self.scratch else summary

    @cached_property
    def service_kpis(self) -> DataFrame:
        return measures.service_kpis(
            self.service.valid, self.vehicles.valid, self.dealers.valid
        )

    @cached_property
    def rejects(self) -> DataFrame:
        tables = (self.service, self.vehicles, self.dealers)
        events = event_rejects(self.flagged, self.telemetry_columns, self.run)
        return all_rejects({c.spec.name: c.invalid for c in tables}, events, self.run)


def together(*tasks: Callable[[], object]) -> list:
    """Start independent Spark jobs at once, so that small ones do not queue."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        return [f.result() for f in [pool.submit(task) for task in tasks]]


def measured(df: DataFrame, folder: str, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Stage a frame and count things about it in the same pass.

    The counts are taken in the last stage, right before the write.  Spark
    takes each finished task of that stage once, also when tasks are repeated;
    counts taken before a shuffle would not have that.
    """
    seen = Observation(name)
    counted = df.observe(seen, *[value.alias(metric) for metric, value in metrics.items()])
    staged = stage(counted, folder, name)
    return staged, {metric: value or 0 for metric, value in seen.get.items()}


def byte_size(df: DataFrame) -> Column:
    """An upper estimate of a frame's bytes: its text, and 16 for each value."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return F.sum(sum(texts, F.lit(16 * len(df.columns))).cast("bigint"))


def dataset_metrics(curated: Curated) -> dict[str, Column]:
    return {
        "input_rows": F.sum(COPIES),
        "kept_rows": F.count(F.lit(1)),
        "reject_rows": count_true(~is_valid()),
        "bytes": byte_size(curated.evaluated),
    }


def stage_curated(curated: Curated, folder: str) -> tuple[Curated, dict]:
    evaluated, counts = measured(
        curated.evaluated, folder, curated.spec.name, **dataset_metrics(curated)
    )
    return Curated(curated.spec, curated.run, evaluated), counts


@dataclass(frozen=True)
class Result:
    """What a run found and where it put its tables."""

    run: Run
    output: str
    counts: Mapping[str, int]
    checks: Sequence[Check]


def run_health(
    spark: SparkSession,
    raw: RawTables,
    output: str,
    run: Run,
    mode: str = "overwrite",
    fmt: str = "parquet",
    max_reject_rate: float = MAX_REJECT_RATE,
    database: str | None = None,
    publish_failed_report: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep_staged: bool = False,
) -> Result:
    """Curate one date, check it, and publish it; nothing is published if a check fails.

    The report is published last, so a date whose report names the run is whole.  The report of
    a stopped run goes to a folder of its own.  Staged tables are removed after success.

    Each raw table is read once and each shared result is computed once.  The
    events meet their vehicle in one left join, which gives the enriched rows
    and the rows of unknown vehicles together.
    """
    configure(spark)
    with sized_shuffles(spark, raw.bytes()):
        result = _run(spark, raw, output, run, mode, fmt, max_reject_rate, database, publish_failed_report, broadcast_bytes)
    if not keep_staged:
        remove_folder(spark, staging_folder(spark, run))
    return result


def staging_folder(spark: SparkSession, run: Run) -> str:
    """Where a run keeps the tables that several results share."""
    return join_path(scratch_root(spark), f"sluice-{run.run_id}")


def _run(
    spark: SparkSession,
    raw: RawTables,
    output: str,
    run: Run,
    mode: str,
    fmt: str,
    max_reject_rate: float,
    database: str | None,
    publish_failed_report: bool,
    broadcast_bytes: int,
) -> Result:
    folder = staging_folder(spark, run)

    def curated(name: str, spec: domain.Dataset) -> Callable[[], tuple[Curated, dict]]:
        return lambda: stage_curated(raw.curated(name, spec, run), folder)

    with small_splits(spark):
        (service, in_service), (vehicles, in_vehicles), (dealers, in_dealers) = together(
            curated("service", domain.SERVICE),
            curated("vehicles", domain.VEHICLES),
            curated("dealers", domain.DEALERS),
        )
    small_dealers = in_dealers["bytes"] <= broadcast_bytes
    small_vehicles = in_vehicles["bytes"] <= broadcast_bytes

    profile = vehicle_profile(
        service.valid,
        vehicles.valid,
        dealers.valid,
        small_dealers,
    ).withColumn("_known", F.lit(True))
    profile, in_profile = measured(profile, folder, "profile", bytes=byte_size(profile))

    telemetry = raw.curated("telemetry", domain.TELEMETRY, run)
    telemetry_columns = [c for c in telemetry.evaluated.columns if c not in (COPIES, REASON)]
    small_profile = in_profile["bytes"] <= broadcast_bytes
    events = attach_profile(telemetry.evaluated, profile, "left", small_profile)
    known = is_valid() & F.col("_known").isNotNull()
    unknown = is_valid() & F.col("_known").isNull()
    with small_splits(spark):
        events, in_events = measured(
            events,
            folder,
            "events",
            input_rows=F.sum(COPIES),
            kept_rows=F.count(F.lit(1)),
            reject_rows=count_true(~is_valid()),
            unknown_rows=count_true(unknown),
            enriched_rows=count_true(known),
            **{
                name: count_true(known & broken)
                for name, broken in row_checks(domain.SEVERITIES).items()
            },
        )
    telemetry_clean = events.filter(is_valid()).select(*telemetry_columns)
    enriched = events.filter(known)

    (summary, in_summary), (kpis, in_kpis), duplicates = together(
        lambda: measured(
            measures.daily_summary(enriched),
            folder,
            "daily_summary",
            rows=F.count(F.lit(1)),
            events=F.sum("telemetry_event_count"),
        ),
        lambda: measured(
            measures.service_kpis(
                service.valid,
                vehicles.valid,
                dealers.valid,
                small_vehicles,
                small_dealers,
            ),
            folder,
            "service_kpis",
            rows=F.count(F.lit(1)),
        ),
        lambda: duplicate_keys(enriched, domain.EVENT_KEY).count(),
    )

    inputs = (in_events, in_service, in_vehicles, in_dealers)
    input_rows = sum(c["input_rows"] for c in inputs)
    reject_rows = sum(c["reject_rows"] for c in inputs) + in_events["unknown_rows"]
    counts = {
        "telemetry_input_rows": in_events["input_rows"],
        "service_input_rows": in_service["input_rows"],
        "vehicle_master_input_rows": in_vehicles["input_rows"],
        "dealer_master_input_rows": in_dealers["input_rows"],
        "vehicle_health_enriched_rows": in_events["enriched_rows"],
        "daily_summary_rows": in_summary["rows"],
        "service_summary_rows": in_kpis["rows"],
        "reject_rows": reject_rows,
        "duplicates_dropped": input_rows - sum(c["kept_rows"] for c in inputs),
    }
    found = {**in_events, "duplicate_event_key": duplicates}
    checks = [
        *[
            Check("vehicle_health_enriched", name, found[name])
            for name in (*row_checks(domain.SEVERITIES), "duplicate_event_key")
        ],
        Check(
            "daily_vehicle_health_summary",
            "summary_reconciliation_delta",
            abs(in_events["enriched_rows"] - in_summary["events"]),
        ),
        *rate_checks(input_rows, reject_rows, max_reject_rate),
    ]

    report = quality_report(spark, checks, counts, run)

    def put(name: str, df: DataFrame, spread: bool = True) -> Callable[[], str]:
        # A run that is repeated under its id takes the place of what it appended before.
        return lambda: publish(df, output, domain.OUTPUTS[name], run.business_date, mode, fmt, run.run_id, spread)

    try:
        enforce(checks)
    except GateError:
        if publish_failed_report:
            spec = domain.OUTPUTS["data_quality_report"]
            publish(report, join_path(output, FAILED), spec, run.business_date, "overwrite", fmt)
        raise

    rejects = all_rejects(
        {c.spec.name: c.invalid for c in (service, vehicles, dealers)},
        event_rejects(events, telemetry_columns, run),
        run,
    )
    together(
        put("vehicle_telemetry_clean", telemetry_clean),
        put("service_events_clean", service.valid),
        put("vehicle_health_enriched", enriched),
        put("daily_vehicle_health_summary", summary),
        put("service_kpi_summary", kpis),
        # Each task reads one staged table, so it holds rejects of one dataset, of events two.
        put("rejects", rejects, spread=False),
    )
    put("data_quality_report", report)()
    if database and fmt == "parquet":
        register_all(spark, output, database, domain.OUTPUTS.values(), run.business_date)
    return Result(run, output, counts, checks)
