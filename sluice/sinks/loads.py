"""Loading one date into several tables as one unit.

All tables' new files are written first, beside their slices, where no reader looks.  Then a log of the load
is put beside the tables; from then on the load counts.  Each table's slice is swapped and the log goes.
A failure before the log leaves every table at the old date's rows; after it, :func:`finish_load` brings all tables to
the new ones.  So tables never stay at different loads of a date.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from sluice.paths import join_path
from sluice.sinks.store import Store
from sluice.sinks.swap import drop_leftovers, finish, incoming_folder, swap_in

#: Folder beside the tables that holds the logs of loads that have not ended.
LOADS = "_loads"


@dataclass(frozen=True)
class Written:
    """New files of one table's slice, complete but not yet in place."""

    table: str
    incoming: str


def _log(root: str, slice_name: str) -> str:
    return join_path(root, LOADS, f"{slice_name}.json")


def write_part(root: str, table: str, slice_name: str, rows: DataFrame) -> Written:
    """Write one table's slice to where no reader looks."""
    folder = join_path(root, table)
    drop_leftovers(rows.sparkSession, folder, slice_name)
    incoming = incoming_folder(folder, slice_name)
    rows.write.mode("errorifexists").parquet(incoming)
    return Written(table, incoming)


def commit_load(spark: SparkSession, root: str, slice_name: str, parts: Sequence[Written]) -> None:
    """From here on the load counts, whatever happens."""
    Store(spark).put(_log(root, slice_name), json.dumps([asdict(p) for p in parts]))


def finish_load(spark: SparkSession, root: str, slice_name: str) -> list[str]:
    """Put the files of a committed load in place; gives the tables, none if there is no such load."""
    store = Store(spark)
    log = store.text(_log(root, slice_name))
    if log is None:
        return []
    parts = [Written(**entry) for entry in json.loads(log)]
    for part in parts:
        folder = join_path(root, part.table)
        if store.exists(part.incoming):
            swap_in(spark, folder, slice_name, part.incoming)
        else:
            finish(spark, folder, slice_name)
    store.delete(_log(root, slice_name))
    return [part.table for part in parts]


def load_together(
    spark: SparkSession, root: str, slice_name: str, rows: Mapping[str, DataFrame], at_once
) -> list[str]:
    """Load a slice of several tables; ``at_once`` runs the writes side by side."""
    finish_load(spark, root, slice_name)
    parts = at_once(*[lambda t=table, df=df: write_part(root, t, slice_name, df) for table, df in rows.items()])
    commit_load(spark, root, slice_name, parts)
    return finish_load(spark, root, slice_name)
