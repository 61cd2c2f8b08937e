"""Reports from one pass, partitions found level by level, members dealt by size, hot keys."""

import re
import zipfile
from collections import Counter
from dataclasses import replace
from statistics import median

import pytest
from pyspark.sql import functions as F
from shared import SF_DIR

from sluice.operators.cleaning import curate
from sluice.operators.joins import lookup
from sluice.operators.quality import listed, one_row
from sluice.operators.rules import RAW
from sluice.domains import vehicles as domain
from sluice.plans import health
from sluice.sinks import tables
from sluice.sinks.tables import OutputSpec, discovered_partitions, ensure_table, register_partitions, registered_partitions
from sluice.sources import archives
from verification import queries as q


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- reports ----------------------------------------------------------------

#: How often a raw view names each table: reading a view once scans them so often.
VIEW_SCANS = {"events": 2, "supplier": 1}


@pytest.mark.parametrize("name", ["reject_reason_counts", "reject_envelope", "quality_report"])
def test_a_report_reads_each_raw_view_once(spark, monkeypatch, name):
    scans = Counter()
    real = health.stage

    def counted(df, folder, label):
        text = df._jdf.queryExecution().executedPlan().toString()
        scans.update(re.findall(r"sf0\.001/(\w+)\.parquet", text))
        return real(df, folder, label)

    monkeypatch.setattr(health, "stage", counted)
    result = q.QUERIES[name](spark, SF_DIR)
    scans.update(re.findall(r"sf0\.001/(\w+)\.parquet", result._jdf.queryExecution().executedPlan().toString()))
    assert {t: scans[t] for t in VIEW_SCANS} == VIEW_SCANS


def test_counts_side_by_side(spark):
    one = spark.createDataFrame([(3, None)], "a int, b long")
    other = spark.createDataFrame([(7,)], "a long")
    row = one_row({"x": one, "y": other})
    assert row.columns == ["x_a", "x_b", "y_a"] and tuple(row.first()) == (3, 0, 7)
    found = rows(listed(row, {"d": {"bad": F.col("x_a"), "good": F.col("x_b")}}, {"n": F.col("y_a")}))
    assert found == Counter([("d", "bad", 3, "FAILED"), ("d", "good", 0, "PASSED"), ("pipeline", "n", 7, "INFO")])


def test_raw_text_stays_with_rejected_rows_only(spark, run):
    columns = domain.DEALER_COLUMNS
    raw = spark.createDataFrame(
        [(" d1 ", "Name", "de", "EU", "a"), ("d2", " n/a ", "de", "EU", "b"), ("d2", " n/a ", "de", "EU", "b")],
        ", ".join(f"{c} string" for c in columns),
    ).withColumn("source_file", F.lit("f"))
    got = {r.dealer_id: r for r in curate(raw, domain.DEALERS, run, keep_raw=True).evaluated.collect()}
    assert got["D1"][RAW] is None
    assert '"dealer_name":" n/a "' in got["D2"][RAW] and '"dealer_tier":"b"' in got["D2"][RAW]
    plain = curate(raw, domain.DEALERS, run).evaluated
    assert RAW not in plain.columns
    kept = curate(raw, domain.DEALERS, run, keep_raw=True).evaluated.drop(RAW)
    assert rows(kept.select(*plain.columns)) == rows(plain)


# --- partitions -------------------------------------------------------------

SPEC = OutputSpec("t", "id bigint, d string, p string", ("d", "p"))


def test_folders_are_found_to_the_depth_of_the_keys(spark, tmp_path, monkeypatch):
    for day in ("2026-01-01", "2026-01-02", "_hidden", "__HIVE_DEFAULT_PARTITION__"):
        for part in ("a b", "c%2Fd"):
            folder = tmp_path / f"d={day}" / f"p={part}" / "deeper=1"
            folder.mkdir(parents=True)
            (folder / "x.parquet").write_text("")
            if part == "a b" or day == "2026-01-02":
                (folder.parent / "part-0.parquet").write_text("")
    (tmp_path / "d=2026-01-03" / "p=empty").mkdir(parents=True)
    (tmp_path / "d=2026-01-03" / "p=crc").mkdir()
    (tmp_path / "d=2026-01-03" / "p=crc" / ".part.crc").write_text("")
    (tmp_path / "_incoming" / "d=9" / "p=9").mkdir(parents=True)
    (tmp_path / "_incoming" / "d=9" / "p=9" / "part-0.parquet").write_text("")
    monkeypatch.setattr(tables, "_listed_files", None)
    found = rows(discovered_partitions(spark, str(tmp_path), ["d", "p"]))
    assert found == Counter(
        [("d=2026-01-01/p=a b",), ("d=2026-01-02/p=a b",), ("d=2026-01-02/p=c%2Fd",), ("d=_hidden/p=a b",), ("d=__HIVE_DEFAULT_PARTITION__/p=a b",)]
    )
    assert rows(discovered_partitions(spark, str(tmp_path / "none"), ["d", "p"])) == Counter()


def test_many_folders_are_dealt_to_tasks(spark, tmp_path):
    for day in range(40):
        for part in range(50):
            folder = tmp_path / f"d={day}" / f"p={part}"
            folder.mkdir(parents=True)
            (folder / "f.parquet").write_text("")
    found = discovered_partitions(spark, str(tmp_path), ["d", "p"])
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 2000 and max(r["count"] for r in tasks) < 1500


def test_an_unknown_store_is_listed_by_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "d=1" / "p=2").mkdir(parents=True)
    monkeypatch.setattr(tables, "_reached_by_tasks", lambda folder: False)
    (tmp_path / "d=1" / "p=2" / "f.parquet").write_text("x")
    assert rows(discovered_partitions(spark, str(tmp_path), ["d", "p"])) == Counter([("d=1/p=2",)])


def test_vanished_partitions_leave_the_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", "a"), (2, "x", None), (3, "y", "a")], SPEC.schema).write.partitionBy("d", "p").parquet(path)
    table = ensure_table(spark, "vanish_db", SPEC, path)
    assert register_partitions(spark, table, path, SPEC.partition_by) == 3
    q.remove_folder(spark, f"{path}/d=y")
    q.remove_folder(spark, f"{path}/d=x/p=__HIVE_DEFAULT_PARTITION__")
    assert register_partitions(spark, table, path, SPEC.partition_by) == 0
    assert registered_partitions(spark, table).count() == 3
    assert register_partitions(spark, table, path, SPEC.partition_by, "x", drop_vanished=True) == 1
    assert rows(registered_partitions(spark, table)) == Counter([("d=x/p=a",), ("d=y/p=a",)])
    assert register_partitions(spark, table, path, SPEC.partition_by, drop_vanished=True) == 1
    assert rows(spark.table(table)) == Counter([(1, "x", "a")])


# --- archives ---------------------------------------------------------------


def test_members_are_dealt_by_what_they_hold(spark):
    sizes = [5_000_000] + [1000] * 300 + [90_000] * 20 + [0, 0]
    members = spark.createDataFrame([(f"a{i}", "z", f"m{i}", "x.csv", b) for i, b in enumerate(sizes)], archives.MEMBER_SCHEMA).repartition(4)
    dealt = archives.dealt_by_size(members, 100_000)
    assert rows(dealt) == rows(members)
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
    loads = sorted(r.bytes for r in tasks)
    # One task for the large member; small ones fill theirs within a member for each task of the listing.
    assert loads[-1] == 5_000_000 and loads[-2] <= 100_000 + 90_000 * 4
    assert len(loads) >= 15
    assert archives.dealt_by_size(members.limit(0)).count() == 0


def test_all_unfit_archives_are_counted(spark, tmp_path):
    for i in range(13):
        with zipfile.ZipFile(tmp_path / f"{i:02}.zip", "w") as archive:
            archive.writestr("y.csv", "h\n")
    members = archives.list_members(spark, str(tmp_path / "*.zip"))
    with pytest.raises(archives.ArchiveError, match="10 of 13 unfit"):
        archives.check_archives(members, ["x.csv"])
    assert "Window" not in archives.archive_problems(members, ["x.csv"])._jdf.queryExecution().toString()


# --- hot keys ---------------------------------------------------------------


def test_a_hot_vehicle_is_cut_over_tasks(spark):
    """One vehicle has a third of the events, and the reference is too large to broadcast."""
    held = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        n = 600_000
        vin = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") * 7919 % 50_000).cast("string")))
        events = spark.range(0, n, 1, 16).select(vin.alias("vin"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        known = F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id").cast("string")))
        vehicles = spark.range(0, 40_000, 1, 4).select(known.alias("vin"), F.lit(1).alias("known"))
        for how in ("left", "left_anti", "inner"):
            found = lookup(events, vehicles, "vin", how).groupBy(F.spark_partition_id().alias("task")).count()
            counts = [r["count"] for r in found.collect()]
            want = {"left": n, "inner": events.join(vehicles, "vin").count(), "left_anti": events.join(vehicles, "vin", "left_anti").count()}[how]
            assert sum(counts) == want
            if how != "left_anti":
                assert max(counts) <= 3 * median(counts), how
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
