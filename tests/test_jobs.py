"""Whole jobs on the given tables."""

import zipfile
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from shared import SF_DIR

from sluice.domains import vehicles as domain
from sluice.operators.quality import GateError
from sluice.plans import cli
from sluice.plans.health import FAILED, run_health, staging_folder
from sluice.plans.warehouse import load_warehouse
from sluice.sources.files import read_slice
from verification import queries as q


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def published(spark, root, name, day=q.BUSINESS_DATE):
    spec = domain.OUTPUTS[name]
    return read_slice(spark, root, name, spec.schema, day).select(*spec.schema.names)


@pytest.fixture(scope="module")
def raw(spark):
    return q.raw_tables(spark, SF_DIR)


@pytest.fixture(scope="module")
def job(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("health"))
    return run_health(spark, raw, root, q.RUN, max_reject_rate=0.5, database="health_db")


def test_job_publishes_what_the_queries_give(spark, job):
    c = q.curation(spark, SF_DIR)
    for name, want in {
        "vehicle_telemetry_clean": c.telemetry.valid,
        "service_events_clean": c.service.valid,
        "vehicle_health_enriched": c.enriched,
        "daily_vehicle_health_summary": c.daily_summary,
        "service_kpi_summary": c.service_kpis,
        "rejects": c.rejects,
    }.items():
        got = published(spark, job.output, name)
        assert rows(got) == rows(want.select(*got.columns)), name
        assert spark.table(f"health_db.{name}").count() == sum(rows(got).values())


def test_counts_add_up(job):
    counts = job.counts
    assert counts["telemetry_input_rows"] + counts["service_input_rows"] > 2000
    assert counts["reject_rows"] > 0 and counts["duplicates_dropped"] > 0
    assert all(check.value == 0 for check in job.checks)


def test_rerun_replaces_its_date_and_no_other(spark, raw, job):
    other = replace(q.RUN, business_date="2026-11-30", run_id="run-2")
    run_health(spark, raw, job.output, other, max_reject_rate=0.5)
    again = replace(q.RUN, run_id="run-3")
    before = rows(published(spark, job.output, "daily_vehicle_health_summary"))
    run_health(spark, raw, job.output, again, max_reject_rate=0.5)
    assert rows(published(spark, job.output, "daily_vehicle_health_summary")) == before
    runs = published(spark, job.output, "rejects").select("pipeline_run_id").distinct()
    assert [r[0] for r in runs.collect()] == ["run-3"]
    kept = published(spark, job.output, "rejects", "2026-11-30").select("pipeline_run_id").distinct()
    assert [r[0] for r in kept.collect()] == ["run-2"]


def test_large_reference_tables_take_the_shuffled_path(spark, raw, job, tmp_path):
    run_health(
        spark,
        raw,
        str(tmp_path),
        replace(q.RUN, run_id="run-4"),
        max_reject_rate=0.5,
        broadcast_bytes=0,
    )
    for name in ("vehicle_health_enriched", "service_kpi_summary", "rejects"):
        columns = [c for c in domain.OUTPUTS[name].schema.names if c not in ("pipeline_run_id", "record_json")]
        got = published(spark, str(tmp_path), name).select(*columns)
        want = published(spark, job.output, name).select(*columns)
        assert rows(got) == rows(want), name


def test_too_many_rejects_publish_nothing(spark, raw, tmp_path):
    run = replace(q.RUN, run_id="run-5")
    with pytest.raises(GateError, match="reject_rate_threshold_exceeded"):
        run_health(spark, raw, str(tmp_path), run, publish_failed_report=True)
    assert [p.name for p in tmp_path.iterdir()] == [FAILED]
    report = published(spark, str(tmp_path / FAILED), "data_quality_report")
    assert report.filter("status = 'FAILED'").count() == 1


def test_a_stopped_run_leaves_the_report_of_the_last_good_one(spark, raw, tmp_path):
    few = replace(raw, **{n: getattr(raw, n).limit(200) for n in ("telemetry", "service")})
    run_health(spark, few, str(tmp_path), replace(q.RUN, run_id="run-8"), max_reject_rate=1.0)
    with pytest.raises(GateError):
        run_health(
            spark, few, str(tmp_path), replace(q.RUN, run_id="run-9"), max_reject_rate=0.0, publish_failed_report=True
        )
    for root, want in ((tmp_path, "run-8"), (tmp_path / FAILED, "run-9")):
        report = published(spark, str(root), "data_quality_report")
        assert {r.pipeline_run_id for r in report.collect()} == {want}


def test_staged_tables_go_after_success_unless_kept(spark, raw, tmp_path):
    empty = replace(
        raw, **{n: getattr(raw, n).filter("1 = 0") for n in ("telemetry", "service", "vehicles", "dealers")}
    )
    for run_id, keep in (("run-10", False), ("run-11", True)):
        run = replace(q.RUN, run_id=run_id)
        run_health(spark, empty, str(tmp_path / run_id), run, keep_staged=keep)
        assert Path(staging_folder(spark, run)).exists() == keep


def test_empty_inputs(spark, raw, tmp_path):
    empty = replace(
        raw, **{n: getattr(raw, n).filter("1 = 0") for n in ("telemetry", "service", "vehicles", "dealers")}
    )
    result = run_health(spark, empty, str(tmp_path), replace(q.RUN, run_id="run-6"))
    assert set(result.counts.values()) == {0}


def test_warehouse(spark, raw, job, tmp_path):
    for _ in range(2):
        v = load_warehouse(
            spark, job.output, str(tmp_path), q.BUSINESS_DATE, "stage_db", "mart_db", fail_on_delta=True
        )
    assert all(r.row_count_delta == 0 and r.target_row_count > 0 for r in v.deltas.collect())
    before = rows(v.deltas)
    other = run_health(spark, raw, job.output, replace(q.RUN, business_date="2026-11-29", run_id="run-12"), max_reject_rate=0.5)
    load_warehouse(spark, other.output, str(tmp_path), "2026-11-29", "stage_db", "mart_db")
    assert rows(v.deltas) == before
    assert rows(v.slice_counts.select("table_name", "row_count")) == rows(
        v.deltas.select("table_name", "target_row_count")
    )
    assert v.quality.count() == 16
    order = [(r.critical_dtc_events, r.warning_or_critical_events, r.telemetry_events) for r in v.risk.collect()]
    assert order == sorted(order, reverse=True)


def test_command_line_reads_archives(spark, raw, tmp_path):
    frames = [
        (domain.TELEMETRY, raw.telemetry),
        (domain.SERVICE, raw.service),
        (domain.VEHICLES, raw.vehicles),
        (domain.DEALERS, raw.dealers),
    ]
    with zipfile.ZipFile(tmp_path / "vehicle_health_2026_12_01.zip", "w") as archive:
        for spec, df in frames:
            text = df.select(*spec.columns).toPandas().to_csv(index=False)
            archive.writestr(spec.file_name, text)
    result = cli.main(
        [f"--input {tmp_path}/{{date}} --output {tmp_path}/out --business-date 2026-12-01 --max-reject-rate 0.5"]
    )
    got = published(spark, result.output, "vehicle_telemetry_clean").drop(
        "source_zip", "pipeline_run_id", "ingested_at"
    )
    want = q.curation(spark, SF_DIR).telemetry.valid.select(*got.columns)
    assert rows(got) == rows(want)
    zips = published(spark, result.output, "service_events_clean").select("source_zip").distinct()
    assert [r[0] for r in zips.collect()] == ["vehicle_health_2026_12_01.zip"]


def test_command_line_needs_a_real_date():
    with pytest.raises(SystemExit):
        cli.parse_args(["--input", "a", "--output", "b", "--business-date", "12/01/2026"])
    args = cli.parse_args(["--input a --output b"])
    assert (args.max_reject_rate, args.write_mode, args.write_format) == (0.10, "overwrite", "parquet")


def test_job_writes_csv(spark, raw, tmp_path):
    run_health(
        spark, raw, str(tmp_path), replace(q.RUN, run_id="run-7"), fmt="csv", max_reject_rate=0.5
    )
    files = list((tmp_path / "service_kpi_summary").rglob("*.csv"))
    assert files and files[0].read_text().startswith("dealer_id,")


def test_a_named_run_can_be_repeated_in_append_mode(spark, raw, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    frames = [(domain.TELEMETRY, raw.telemetry), (domain.SERVICE, raw.service), (domain.VEHICLES, raw.vehicles), (domain.DEALERS, raw.dealers)]
    for spec, df in frames:
        df.select(*spec.columns).limit(300).toPandas().to_csv(folder / spec.file_name, index=False)
    line = f"--input {folder} --output {tmp_path}/out --business-date 2026-12-01 --max-reject-rate 1 --write-mode append"
    for run_id, times in (("a", 1), ("a", 1), ("b", 2)):
        result = cli.main([f"{line} --run-id {run_id}"])
        kept = published(spark, result.output, "vehicle_telemetry_clean")
        assert kept.count() == times * kept.select("vin", "event_timestamp", "dtc_code").distinct().count()
