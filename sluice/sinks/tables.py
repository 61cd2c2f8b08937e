"""Catalog tables and views over published files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import batched
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions import quoted
from sluice.paths import join_path
from sluice.sources.schema import schema_from_ddl


if TYPE_CHECKING:
    import pyarrow as pa

#: Partitions that one statement adds.
ADD_AT_ONCE = 100
#: Fixed value: the folder name of a partition without a value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class OutputSpec:
    """A published table: all its columns in write order, and its layout."""

    name: str
    ddl: str
    partition_by: tuple[str, ...]

    @cached_property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @cached_property
    def data_schema(self) -> StructType:
        return schema_from_ddl(self.ddl, self.partition_by)

    def partitioned(self, *columns: str) -> OutputSpec:
        """The same table with another layout."""
        return replace(self, partition_by=columns)

    def without(self, *columns: str) -> OutputSpec:
        """The same table without some columns."""
        kept = [f for f in self.schema.fields if f.name not in columns]
        ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in kept)
        return replace(
            self, ddl=ddl, partition_by=tuple(c for c in self.partition_by if c not in columns)
        )


def full_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def literal(text: str) -> str:
    """A string literal for SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")


def ensure_table(
    spark: SparkSession, database: str, spec: OutputSpec, location: str, recreate: bool = False
) -> str:
    """Create a Parquet table over a folder if it is not there; give its name.

    ``recreate`` drops the entry first; the files stay.
    """
    ensure_database(spark, database)
    name = full_name(database, spec.name)
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    partitions = [f for f in spec.schema.fields if f.name in spec.partition_by]
    fields = [*spec.data_schema.fields, *partitions]
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    layout = f" PARTITIONED BY ({', '.join(map(quoted, spec.partition_by))})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout} "
        f"LOCATION {literal(location)}"
    )
    return name


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register the partition folders the catalog does not know yet."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.sql(f"REFRESH TABLE {table}")


def qualified(spark: SparkSession, location: str) -> str:
    """A location with its file system, as the catalog keeps it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.makeQualified(path).toString()


def is_outdated(spark: SparkSession, database: str, spec: OutputSpec, location: str) -> bool:
    """Whether a table is registered with other columns, layout or folder than the spec has."""
    name = full_name(database, spec.name)
    if not spark.catalog.tableExists(name):
        return False
    columns = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    layout = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    here = described["Location"].rstrip("/") == qualified(spark, location).rstrip("/")
    return not here or dict(spark.table(name).dtypes) != columns or layout != list(spec.partition_by)


def register_all(
    spark: SparkSession,
    root: str,
    database: str,
    specs: Iterable[OutputSpec],
    business_date: str | None = None,
) -> list[str]:
    """Tables over all published outputs; may be repeated at any time.

    A table whose columns, layout or folder have changed is registered anew; its files stay.
    With a date, only that date's folder of a table that is there is looked through.
    """
    names = []
    ensure_database(spark, database)
    for spec in specs:
        location = join_path(root, spec.name)
        outdated = is_outdated(spark, database, spec, location)
        known = not outdated and spark.catalog.tableExists(full_name(database, spec.name))
        name = ensure_table(spark, database, spec, location, recreate=outdated)
        if spec.partition_by and known and business_date:
            register_partitions(spark, name, location, spec.partition_by, business_date)
        elif spec.partition_by:
            recover_partitions(spark, name)
        names.append(name)
    return names


def load_slice(
    spark: SparkSession, source: DataFrame, target: str, columns: Sequence[str], business_date: str
) -> None:
    """Replace one date of a table, partitioned by date, in one statement.

    ``columns`` are the target's data columns in order.
    """
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION (business_date = {literal(business_date)}) "
        "SELECT * FROM {rows}",
        rows=source.select(*columns),
    )


def create_view(spark: SparkSession, view: str, sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {sql}")


def risk_view_sql(summary_table: str) -> str:
    """The risk story over a summary table, for other tools to query."""
    high = "sum(if(severity = 'HIGH', telemetry_event_count, 0))"
    return f"""
        SELECT business_date, model, customer_region, country,
               sum(telemetry_event_count) AS telemetry_events,
               sum(affected_vehicle_count) AS affected_vehicle_groups,
               sum(critical_dtc_count) AS critical_dtc_events,
               sum(if(severity IN ('HIGH', 'CRITICAL'), telemetry_event_count, 0))
                   AS warning_or_critical_events,
               avg(avg_battery_voltage) AS avg_battery_voltage,
               avg(avg_engine_temp_c) AS avg_engine_temp_c,
               CASE WHEN sum(critical_dtc_count) > 0 THEN 'CRITICAL_ATTENTION'
                    WHEN {high} > 0 THEN 'WATCHLIST' ELSE 'NORMAL' END AS risk_band
        FROM {summary_table}
        GROUP BY business_date, model, customer_region, country"""


def revenue_view_sql(sales_table: str) -> str:
    return f"""
        SELECT order_date, count(DISTINCT order_id) AS order_count,
               sum(quantity) AS units_sold, round(sum(total_amount), 2) AS total_revenue
        FROM {sales_table}
        GROUP BY order_date"""


FOUND = "folder string, partition string"


def _listing(key: str, last: bool):
    """Lists the folders ``key=...`` right below each folder; of the last key those that hold a file."""

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyarrow import fs

        def visible(info) -> bool:
            return not info.base_name.startswith(("_", "."))

        for batch in batches:
            folders, partitions = [], []
            for folder, partition in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, inner = _opened(folder)
                for info in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                    if info.type != fs.FileType.Directory or not info.base_name.startswith(f"{key}="):
                        continue
                    if last:
                        inside = store.get_file_info(fs.FileSelector(info.path))
                        if not any(x.type == fs.FileType.File and visible(x) for x in inside):
                            continue
                    folders.append(f"{folder.rstrip('/')}/{info.base_name}")
                    partitions.append(f"{partition}/{info.base_name}" if partition else info.base_name)
            yield pa.RecordBatch.from_arrays([pa.array(folders, pa.string()), pa.array(partitions, pa.string())], names=["folder", "partition"])

    return listing


def _opened(folder: str):
    """The store of a folder and its path there, as Arrow names them."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, mark, rest = folder.partition(":")
    if not mark or "/" in scheme:
        scheme, rest = "file", folder
    if not rest.startswith("//"):
        rest = "//" + rest
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def _reached_by_tasks(folder: str) -> bool:
    try:
        _opened(folder)
    except Exception:  # noqa: BLE001 - whatever keeps Arrow from it, Spark lists the files then
        return False
    return True


def discovered_partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The partitions that have files, as ``k=v/k=v``; other folders are skipped.

    Folders are listed level by level, each by the task that has the one above it, and no deeper
    than the keys go; file names reach neither the driver nor another task.  Between levels the folders are
    dealt anew, so one date with many partitions is listed by many tasks.  A store that Arrow does not know is
    listed by Spark, with all its files.
    """
    location = qualified(spark, path)
    if not _reached_by_tasks(location):
        return _listed_files(spark, path, keys)
    found = spark.createDataFrame([(location, "")], FOUND)
    for level, key in enumerate(keys):
        if level:
            found = found.repartition(max(2, spark.sparkContext.defaultParallelism), "folder")
        found = found.mapInArrow(_listing(key, level == len(keys) - 1), FOUND)
    return found.select("partition")


def _listed_files(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path")
    )
    # Names starting with _ or . are skipped by the listing itself.
    pattern = "/" + "/".join(f"{key}=[^/]*" for key in keys) + "/[^/]*$"
    folder = F.regexp_replace(F.regexp_extract("path", pattern, 0), "^/|/[^/]*$", "")
    return files.select(folder.alias("partition")).filter("partition <> ''").distinct()


def registered_partitions(spark: SparkSession, table: str, within: str = "") -> DataFrame:
    """All partitions of a table, or those of one slice, given as ``k = 'v'``."""
    return spark.sql(f"SHOW PARTITIONS {table}" + (f" PARTITION ({within})" if within else ""))


def partition_diff(discovered: DataFrame, registered: DataFrame) -> DataFrame:
    """Partitions only found as files (``new``) or only in the catalog (``vanished``)."""
    return (
        discovered.select("partition", F.lit(True).alias("found"))
        .join(registered.select("partition", F.lit(True).alias("known")), "partition", "full")
        .filter(F.col("found").isNull() | F.col("known").isNull())
        .select("partition", F.when(F.col("found"), "new").otherwise("vanished").alias("state"))
    )


def partition_clause(partition: str) -> str:
    """A partition in the form of its folder as the ``k = 'v'`` of a statement."""
    pairs = [part.split("=", 1) for part in partition.split("/")]
    return ", ".join(
        f"{quoted(unquote(key))} = {'NULL' if value == NULL_PARTITION else literal(unquote(value))}"
        for key, value in pairs
    )


def register_partitions(
    spark: SparkSession,
    table: str,
    path: str,
    keys: Sequence[str],
    slice_value: str | None = None,
    drop_vanished: bool = False,
) -> int:
    """Register the partitions that have files and are not in the catalog; gives how many entries changed.

    With a value of the first key only that slice's folder is listed and
    compared.  ``drop_vanished`` also takes entries without files out of the catalog.  The driver
    holds one statement's worth of names at a time.
    """
    if slice_value is None:
        found, known = discovered_partitions(spark, path, keys), registered_partitions(spark, table)
    else:
        slice_name = f"{keys[0]}={slice_value}"
        found = discovered_partitions(spark, join_path(path, slice_name), keys[1:]) if len(keys) > 1 else None
        if found is None:
            found = discovered_partitions(spark, path, keys).filter(F.col("partition") == slice_name)
        else:
            found = found.select(F.concat(F.lit(slice_name + "/"), "partition").alias("partition"))
        known = registered_partitions(spark, table, partition_clause(slice_name))
    diff = partition_diff(found, known)
    changed = 0
    for batch in batched(diff.filter("state = 'new'").select("partition").toLocalIterator(), ADD_AT_ONCE):
        clauses = [
            f"PARTITION ({partition_clause(row.partition)}) LOCATION {literal(join_path(path, row.partition))}"
            for row in batch
        ]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses)}")
        changed += len(clauses)
    if drop_vanished:
        for batch in batched(diff.filter("state = 'vanished'").select("partition").toLocalIterator(), ADD_AT_ONCE):
            clauses = [f"PARTITION ({partition_clause(row.partition)})" for row in batch]
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(clauses)}")
            changed += len(clauses)
    spark.sql(f"REFRESH TABLE {table}")
    return changed
