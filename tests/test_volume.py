"""What jobs shuffle, hold in a task and compute again."""

import re

from pyspark.sql import functions as F
from shared import SF_DIR

from sluice.context import RAW_SPLIT_BYTES, SPLIT_BYTES, small_splits
from sluice.domains import vehicles as domain
from sluice.operators import measures
from sluice.operators.cleaning import curate
from sluice.plans import health
from sluice.sinks import files
from sluice.sinks.tables import OutputSpec
from verification import queries as q


def test_derived_columns_are_not_shuffled(spark, run):
    rows = curate(q.raw_tables(spark, SF_DIR).service, domain.SERVICE, run, ("o_orderkey", "copy_no")).evaluated
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_min" in line)
    assert "service_open_timestamp" in partial
    assert "service_date" not in partial and "service_duration_hours" not in partial


def test_services_meet_their_vehicle_by_one_shuffle(spark, monkeypatch):
    c = q.curation(spark, SF_DIR)
    service, vehicles, dealers = (
        spark.createDataFrame([], df.valid.schema) for df in (c.service, c.vehicles, c.dealers)
    )
    figures = measures.service_kpis(service, vehicles, dealers, True, True)
    plan = figures._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_rejects_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    rows = spark.range(20).select("id", F.lit("2026-12-01").alias("d"), (F.col("id") % 2).cast("string").alias("p"))
    hints, real = [], type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda self, *a: hints.append(a) or real(self, *a))
    spec = OutputSpec("t", "id bigint, d string, p string", ("d", "p"))
    for spread in (False, True):
        root = str(tmp_path / str(spread))
        files.publish(rows, root, spec, "2026-12-01", spread=spread)
        got = spark.read.parquet(f"{root}/t/d=2026-12-01").selectExpr("id", "p = id % 2 as right")
        assert sorted(got.collect()) == [(i, True) for i in range(20)]
        assert bool(hints) == spread


def test_raw_files_are_read_in_small_splits(spark, monkeypatch):
    before, seen = spark.conf.get(SPLIT_BYTES), {}
    real = health.stage

    def noted(df, folder, name):
        seen[name] = int(re.sub(r"\D", "", spark.conf.get(SPLIT_BYTES)))
        return real(df, folder, name)

    monkeypatch.setattr(health, "stage", noted)
    q.health_run(spark, SF_DIR)
    raw = ("service_events", "vehicle_master", "dealer_master", "events")
    assert {seen[name] for name in raw} == {RAW_SPLIT_BYTES}
    assert spark.conf.get(SPLIT_BYTES) == before
    spark.conf.set(SPLIT_BYTES, "1m")
    try:
        with small_splits(spark):
            assert spark.conf.get(SPLIT_BYTES) == str(1 << 20)
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def test_what_is_published_several_times_is_computed_once(spark, monkeypatch):
    assert all("/report-" in f for f in q.staged_kpis(spark, SF_DIR).inputFiles())
    asked = []
    monkeypatch.setattr(q, "curation", lambda *a: asked.append(a))
    q.published(spark, SF_DIR)
    assert not asked
