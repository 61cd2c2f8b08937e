"""Files in and out, archives, catalog tables."""

import zipfile
from collections import Counter
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluice.context import (
    INITIAL_PARTITIONS,
    Run,
    planned_bytes,
    resolve_business_date,
    scratch_root,
    sized_shuffles,
)
from sluice.domains import vehicles as domain
from sluice.plans.health import RawTables
from sluice.plans.sales import validate_config
from sluice.sinks.files import conform, publish, replace_slice
from sluice.sinks.tables import (
    OutputSpec,
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
)
from sluice.sources.archives import (
    ArchiveError,
    archive_problems,
    check_archives,
    list_members,
    read_archived_csv,
    read_archives,
)
from sluice.plans.cli import open_inputs
from sluice.sources.files import input_path, join_path, read_raw_csv, read_slice, stored_bytes
from sluice.sources.schema import schema_from_ddl

SPEC = OutputSpec("t", "id bigint, business_date string, part string", ("business_date", "part"))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_schema_from_ddl(spark):
    schema = schema_from_ddl("a string, d decimal(12, 2), p string", ["p"])
    assert schema.simpleString() == "struct<a:string,d:decimal(12,2)>"
    with pytest.raises(ValueError, match="no data columns"):
        schema_from_ddl("p string", ["p"])
    with pytest.raises(Exception, match="(?i)type"):
        schema_from_ddl("a strange_type", [])


def test_paths_and_dates():
    assert join_path("s3a://b/x/", "/y/", "", "z") == "s3a://b/x/y/z"
    assert input_path("/in", "2026-12-01") == "/in/vehicle_health_2026_12_01.zip"
    assert resolve_business_date("2026-12-01") == "2026-12-01"
    assert len(resolve_business_date()) == 10
    with pytest.raises(ValueError):
        resolve_business_date("01.12.2026")
    assert Run.start("2026-12-01").business_date == "2026-12-01"


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_binds_by_position(spark, tmp_path):
    (tmp_path / "x.csv").write_text('h1,h2,h3\n1,"a,b",c\n2\n\n3,x,y,z\n')
    df = read_raw_csv(spark, str(tmp_path), ["a", "b", "c"], "x.csv")
    assert rows(df) == Counter(
        [("1", "a,b", "c", "x.csv"), ("2", None, None, "x.csv"), ("3", "x", "y", "x.csv")]
    )
    semi = tmp_path / "semi"
    semi.mkdir()
    (semi / "x.csv").write_text("h1;h2\n1;2\n")
    assert rows(read_raw_csv(spark, str(semi), ["a", "b"], "x.csv", ";")) == Counter([("1", "2", "x.csv")])


def test_csv_header_check(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path), ["a", "b"], "x.csv", check_header=True).collect()


# --- archives ---------------------------------------------------------------


def make_zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members:
            archive.writestr(name, text)


def test_archive_equals_csv_scan(spark, tmp_path):
    text = 'h1,h2,h3\r\n1,"a,b",c\r\n\r\n2\r\n3, x ,y,z\n,"",Ü\n'
    make_zip(tmp_path / "one.zip", [("in/X.CSV", text), ("readme.txt", "no")])
    make_zip(tmp_path / "two.zip", [("x.csv", "h\n9,8,7\n")])
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "x.csv").write_text(text)
    members = list_members(spark, str(tmp_path / "*.zip"))
    check_archives(members, ["x.csv"])
    got = read_archived_csv(spark, members, "x.csv", ["a", "b", "c"])
    scanned = read_raw_csv(spark, str(tmp_path / "csv"), ["a", "b", "c"], "x.csv")
    from_one = got.filter("source_zip = 'one.zip'").select("a", "b", "c", "source_file")
    assert rows(from_one) == rows(scanned)
    assert rows(got.filter("source_zip = 'two.zip'").select("a", "b", "c", "line_no")) == Counter(
        [("9", "8", "7", 1)]
    )


def test_archive_lines_are_numbered_across_batches(spark, tmp_path):
    lines = "\n".join(str(i) for i in range(45_001))
    make_zip(tmp_path / "big.zip", [("x.csv", "h\n" + lines)])
    members = list_members(spark, str(tmp_path / "big.zip"))
    got = read_archives(spark, members, "x.csv")
    same = got.filter(F.col("line").cast("bigint") == F.col("line_no") - 1)
    assert (got.count(), same.count()) == (45_001, 45_001)


def test_archives_are_dealt_by_size_and_read_by_any_name(spark, tmp_path):
    folder = tmp_path / "with space %41"
    folder.mkdir()
    for i in range(16):
        with zipfile.ZipFile(folder / f"a {i}.zip", "w", zipfile.ZIP_STORED) as archive:
            archive.writestr("x.csv", "h\n" + f"{i}\n" * 1_000_000)
    members = list_members(spark, str(tmp_path / "with space*" / "*.zip"))
    tasks = members.select(F.spark_partition_id().alias("task")).groupBy("task").count()
    sizes = [row["count"] for row in tasks.collect()]
    assert sum(sizes) == 16 and max(sizes) <= 4
    got = read_archives(spark, members, "x.csv").groupBy("source_zip").count()
    assert rows(got) == Counter((f"a {i}.zip", 1_000_000) for i in range(16))


def test_archive_header_check(spark, tmp_path):
    make_zip(tmp_path / "fine.zip", [("x.csv", '"A", b\n1,2\n')])
    make_zip(tmp_path / "swapped.zip", [("y.csv", "b,a\n1,2\n")])
    members = list_members(spark, str(tmp_path / "*.zip"))
    assert read_archived_csv(spark, members, "x.csv", ["a", "b"], check_header=True).first()[:2] == ("1", "2")
    assert read_archived_csv(spark, members, "y.csv", ["a", "b"]).first()[:2] == ("1", "2")
    with pytest.raises(Exception, match="header of y.csv"):
        read_archived_csv(spark, members, "y.csv", ["a", "b"], check_header=True).collect()


def test_archive_problems(spark, tmp_path):
    make_zip(tmp_path / "empty.zip", [("a.txt", "x")])
    make_zip(tmp_path / "twice.zip", [("a/x.csv", "h"), ("b/X.csv", "h"), ("y.csv", "h")])
    make_zip(tmp_path / "lacks.zip", [("x.csv", "h")])
    make_zip(tmp_path / "fine.zip", [("x.csv", "h"), ("d/Y.CSV", "h")])
    members = list_members(spark, str(tmp_path / "*.zip"))
    found = {r.archive.rsplit("/", 1)[-1]: r.problem for r in archive_problems(members, ["x.csv", "y.csv"]).collect()}
    assert found == {
        "empty.zip": "holds no CSV file",
        "twice.zip": "holds two files of the same name",
        "lacks.zip": "lacks y.csv",
    }
    with pytest.raises(ArchiveError, match="lacks y.csv"):
        check_archives(members, ["x.csv", "y.csv"])


def test_damaged_archive_fails(spark, tmp_path):
    path = tmp_path / "bad.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("x.csv", "h\n" + "0123456789\n" * 100)
    data = bytearray(path.read_bytes())
    data[200] ^= 0xFF
    path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="CRC"):
        read_archives(spark, list_members(spark, str(path)), "x.csv").collect()


# --- slices -----------------------------------------------------------------


def frame(spark, data, day):
    return spark.createDataFrame([(i, day, p) for i, p in data], SPEC.schema)


def read(spark, root, day):
    return rows(read_slice(spark, str(root), "t", SPEC.schema, day))


def test_slice_overwrite_keeps_other_dates(spark, tmp_path):
    one, two = "2026-06-24", "2026-06-25"
    publish(frame(spark, [(1, "a"), (2, "b")], one), str(tmp_path), SPEC, one)
    publish(frame(spark, [(3, "a"), (4, "b")], two), str(tmp_path), SPEC, two)
    publish(frame(spark, [(5, "b"), (6, None)], two), str(tmp_path), SPEC, two)
    assert read(spark, tmp_path, one) == Counter([(1, one, "a"), (2, one, "b")])
    assert read(spark, tmp_path, two) == Counter([(5, two, "b"), (6, two, None)])
    parts = {p.name for p in (tmp_path / "t" / f"business_date={two}").iterdir() if p.is_dir()}
    assert parts == {"part=b", "part=__HIVE_DEFAULT_PARTITION__"}


def test_partition_values_stay_text(spark, tmp_path):
    publish(frame(spark, [(1, "2024-01-01")], "2026-06-25"), str(tmp_path), SPEC, "2026-06-25")
    assert read(spark, tmp_path, "2026-06-25") == Counter([(1, "2026-06-25", "2024-01-01")])


def test_write_modes(spark, tmp_path):
    day = "2026-06-25"
    df = frame(spark, [(1, "a")], day)
    publish(df, str(tmp_path), SPEC, day, "append")
    publish(df, str(tmp_path), SPEC, day, "append")
    publish(df, str(tmp_path), SPEC, day, "ignore")
    assert read(spark, tmp_path, day) == Counter({(1, day, "a"): 2})
    with pytest.raises(AnalysisException):
        publish(df, str(tmp_path), SPEC, day, "errorifexists")
    publish(df, str(tmp_path), SPEC, day)
    assert read(spark, tmp_path, day) == Counter({(1, day, "a"): 1})
    with pytest.raises(ValueError, match="unknown write mode"):
        publish(df, str(tmp_path), SPEC, day, "replace")


def test_csv_output(spark, tmp_path):
    df = spark.createDataFrame([(1, "d", ""), (2, "d", None)], "id int, day string, x string")
    folder = replace_slice(df, str(tmp_path / "t"), "day", "d", fmt="csv")
    lines = [line for f in (tmp_path / "t" / "day=d").glob("*.csv") for line in f.read_text().splitlines()]
    assert folder.endswith("day=d")
    # Empty text and NULL are both written as nothing.
    assert sorted(line for line in lines if line != "id,x") == ["1,", "2,"]


def test_conform_checks_types(spark):
    df = spark.createDataFrame([("a", 1, "d")], "part string, id int, business_date string")
    with pytest.raises(TypeError, match="id is int, not bigint"):
        conform(df, SPEC)
    assert conform(df.withColumn("id", F.col("id").cast("bigint")), SPEC).columns == SPEC.schema.names


# --- catalog ----------------------------------------------------------------


def test_load_replaces_one_date_only(spark, tmp_path):
    spec = SPEC.partitioned("business_date")
    target = ensure_table(spark, "load_db", spec, str(tmp_path / "target"))
    assert ensure_table(spark, "load_db", spec, str(tmp_path / "target")) == target
    one, two = "2026-06-24", "2026-06-25"
    load_slice(spark, frame(spark, [(1, "a")], one), target, ["id", "part"], one)
    load_slice(spark, frame(spark, [(2, "a"), (3, "b")], two), target, ["id", "part"], two)
    load_slice(spark, frame(spark, [(4, "c")], two), target, ["id", "part"], two)
    got = spark.table(target).select("id", "business_date", "part")
    assert rows(got) == Counter([(1, one, "a"), (4, two, "c")])


def test_recreate_keeps_the_files(spark, tmp_path):
    day = "2026-06-25"
    publish(frame(spark, [(1, "a")], day), str(tmp_path), SPEC, day)
    table = ensure_table(spark, "re_db", SPEC, str(tmp_path / "t"))
    recover_partitions(spark, table)
    table = ensure_table(spark, "re_db", SPEC, str(tmp_path / "t"), recreate=True)
    assert spark.table(table).count() == 0
    recover_partitions(spark, table)
    assert spark.table(table).count() == 1


def test_partition_diff_both_ways(spark, tmp_path):
    one, two = "2026-06-24", "2026-06-25"
    publish(frame(spark, [(1, "a:b"), (2, None)], one), str(tmp_path), SPEC, one)
    table = ensure_table(spark, "diff_db", SPEC, str(tmp_path / "t"))
    recover_partitions(spark, table)
    publish(frame(spark, [(3, "c")], two), str(tmp_path), SPEC, two)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (business_date='gone', part='x')")
    other = tmp_path / "t" / "other=1" / "part=x"
    other.mkdir(parents=True)
    (other / "f.parquet").write_bytes(b"")
    found = discovered_partitions(spark, str(tmp_path / "t"), SPEC.partition_by)
    assert rows(partition_diff(found, registered_partitions(spark, table))) == Counter(
        [(f"business_date={two}/part=c", "new"), ("business_date=gone/part=x", "vanished")]
    )


def test_found_partitions_are_registered(spark, tmp_path):
    one, two = "2026-06-24", "2026-06-25"
    publish(frame(spark, [(1, "a:b'c"), (2, None)], one), str(tmp_path), SPEC, one)
    table = ensure_table(spark, "found_db", SPEC, str(tmp_path / "t"))
    assert register_partitions(spark, table, str(tmp_path / "t"), SPEC.partition_by) == 2
    assert rows(spark.table(table)) == Counter([(1, one, "a:b'c"), (2, one, None)])
    publish(frame(spark, [(3, f"p{i}") for i in range(250)], two), str(tmp_path), SPEC, two)
    publish(frame(spark, [(4, "late")], one), str(tmp_path), SPEC, one, "append")
    # Only the date that is asked for is looked through.
    assert register_partitions(spark, table, str(tmp_path / "t"), SPEC.partition_by, two) == 250
    assert spark.table(table).count() == 252
    assert register_partitions(spark, table, str(tmp_path / "t"), SPEC.partition_by) == 1
    assert register_partitions(spark, table, str(tmp_path / "t"), SPEC.partition_by) == 0


def test_register_all_can_be_repeated(spark, tmp_path):
    day = "2026-06-25"
    publish(frame(spark, [(1, "a")], day), str(tmp_path), SPEC, day)
    for _ in range(2):
        (name,) = register_all(spark, str(tmp_path), "all_db", [SPEC])
        assert spark.table(name).count() == 1
    wider = replace(SPEC, ddl=SPEC.ddl + ", extra double")
    register_all(spark, str(tmp_path), "all_db", [wider])
    assert rows(spark.table(name).select("id", "extra")) == Counter([(1, None)])
    create_view(spark, full_name("all_db", "v"), f"SELECT count(*) AS n FROM {name}")
    assert spark.table("all_db.v").first().n == 1


def test_output_specs_hold_together(spark):
    for spec in domain.OUTPUTS.values():
        assert set(spec.partition_by) <= set(spec.schema.names)
        assert spec.schema.names[-1] in (spec.partition_by[-1], "total_parts_cost", "reported_at")
    assert len(domain.OUTPUTS["vehicle_health_enriched"].schema) == 35
    assert len(domain.OUTPUTS["daily_vehicle_health_summary"].schema) == 16
    assert len(domain.OUTPUTS["service_kpi_summary"].schema) == 15
    without = domain.OUTPUTS["data_quality_report"].without("business_date")
    assert without.partition_by == () and len(without.schema) == 6


def test_sales_config():
    validate_config("db", "s3a://b/x", "s3a://b/y")
    with pytest.raises(ValueError, match="s3a"):
        validate_config("db", "/x")
    with pytest.raises(ValueError, match="database"):
        validate_config(" ", "s3a://b/x")


def test_shuffles_follow_the_input(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_bytes(b"0" * 100)
    (tmp_path / "y.csv").write_bytes(b"0" * 23)
    assert stored_bytes(spark, [str(tmp_path / "a"), str(tmp_path / "y.csv")]) == 123
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for size, wanted in ((123, own), (2**40, 8192), (100 * 2**40, 819_200)):
        with sized_shuffles(spark, size) as number:
            assert number == wanted == int(spark.conf.get(INITIAL_PARTITIONS))
        assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_sizes_come_from_the_plan_when_none_is_given(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    size = planned_bytes(frame)
    assert size > 100_000
    assert RawTables(frame, frame, frame, frame).bytes() == 4 * size
    assert RawTables(frame, frame, frame, frame, input_bytes=7).bytes() == 7


def test_tables_follow_their_folder(spark, tmp_path):
    spec = OutputSpec("moved", "a bigint, business_date string", ("business_date",))
    for root, n in (("a", 1), ("b", 2)):
        spark.range(n).selectExpr("id as a", "'2026-12-01' as business_date").write.partitionBy("business_date").parquet(
            str(tmp_path / root / "moved")
        )
        register_all(spark, str(tmp_path / root), "moving", [spec])
        assert spark.table("moving.moved").count() == n
    spark.sql("DROP DATABASE moving CASCADE")


def test_folder_of_csv_files_as_input(spark, tmp_path):
    for spec in domain.DATASETS:
        (tmp_path / spec.file_name).write_text(",".join(spec.columns) + "\n")
    raw = open_inputs(spark, str(tmp_path), ",", "2026-12-01")
    assert raw.input_bytes > 0
    assert raw.telemetry.columns == [*domain.TELEMETRY_COLUMNS, "source_file"]


def test_only_a_local_session_may_lack_a_shared_folder():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
        )

    folder = scratch_root(session("local[2]"))
    assert folder == scratch_root(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("local-cluster[2,1,1024]"))
