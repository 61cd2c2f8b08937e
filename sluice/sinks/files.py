"""Publishing one date of a table without touching the others."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluice.sinks.store import Store
from sluice.sinks.swap import drop_leftovers, finish, incoming_folder, swap_in
from sluice.sinks.tables import OutputSpec
from sluice.sources.files import join_path

# How each format is written.
FORMAT_OPTIONS: Mapping[str, Mapping[str, str]] = {
    "parquet": {"compression": "snappy"},
    "csv": {"header": "true", "compression": "none", "emptyValue": "", "nullValue": ""},
}
WRITE_MODES = ("overwrite", "append", "errorifexists", "ignore")


def conform(df: DataFrame, spec: OutputSpec) -> DataFrame:
    """The declared columns in the declared order; a wrong type is an error."""
    out = df.select(*spec.schema.names)
    wrong = [
        f"{have.name} is {have.dataType.simpleString()}, not {want.dataType.simpleString()}"
        for have, want in zip(out.schema.fields, spec.schema.fields)
        if have.dataType != want.dataType
    ]
    if wrong:
        raise TypeError(f"{spec.name}: " + "; ".join(wrong))
    return out


def run_prefix(run_id: str) -> str:
    """How the names of the files of a run begin."""
    return "run-" + re.sub(r"[^A-Za-z0-9-]", "-", run_id) + "."


def replace_slice(
    df: DataFrame,
    path: str,
    slice_column: str,
    slice_value: str,
    sub_partitions: tuple[str, ...] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    run_id: str | None = None,
    spread: bool = True,
) -> str:
    """Write one slice of a table into its own folder and return that folder.

    Overwriting that folder drops what the slice held before, sub-partitions
    that no longer occur included, and leaves every other slice alone.  Modes
    apply to the slice.  The old files count until the new ones are complete
    (see ``sluice.sinks.swap``).  An append with a ``run_id`` takes the place of what a run of that id
    appended before, so it can be repeated; without one every append adds.  Rows of which each task holds few
    sub-partitions anyway need not be shuffled to ``spread`` them.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    spark = df.sparkSession
    name = f"{slice_column}={slice_value}"
    folder = join_path(path, name)
    rows = df.drop(slice_column)
    if sub_partitions and spread:
        # Even, well-filled files: a large partition is cut over several tasks,
        # small ones share a task.
        rows = rows.hint("rebalance", *sub_partitions)
    writer = rows.write.format(fmt).options(**FORMAT_OPTIONS[fmt])
    if sub_partitions:
        writer = writer.partitionBy(*sub_partitions)
    finish(spark, path, name)
    keyed = mode == "append" and run_id is not None
    if mode != "overwrite" and not keyed:
        writer.mode(mode).save(folder)
        return folder
    drop_leftovers(spark, path, name)
    incoming = incoming_folder(path, name)
    writer.mode("errorifexists").save(incoming)
    swap_in(spark, path, name, incoming, run_prefix(run_id) if keyed else "")
    return folder


def publish(
    df: DataFrame,
    root: str,
    spec: OutputSpec,
    business_date: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    run_id: str | None = None,
    spread: bool = True,
) -> str:
    """Write one date of an output table."""
    slice_column, *rest = spec.partition_by
    return replace_slice(
        conform(df, spec),
        join_path(root, spec.name),
        slice_column,
        business_date,
        tuple(rest),
        mode,
        fmt,
        run_id,
        spread,
    )


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    What follows starts from files, so a lost executor costs its own tasks and
    not the whole lineage, and each reader gets only the columns it needs.
    """
    path = join_path(folder, name)
    df.write.mode("errorifexists").parquet(path)
    return read_staged(df.sparkSession, path, df.schema)


def read_staged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of staged tables on whatever store it is."""
    Store(spark).delete(folder)
