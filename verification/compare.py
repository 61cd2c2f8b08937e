"""Run queries in Spark and DuckDB on the same files and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value: object) -> object:
    """A value as both engines would print it; floats bit for bit."""
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in ALL_TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"create view {table} as select * from '{path}'")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, query, sql: str) -> str:
    """Empty if equal, else what differs."""
    frame = query(spark, sf_dir)
    got = bag(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = bag(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if got == want:
        return ""
    extra, lacking = list((got - want).elements()), list((want - got).elements())
    return f"{len(extra)} extra, {len(lacking)} missing\n  extra   {extra[:2]}\n  missing {lacking[:2]}"


def main() -> None:
    from verification.oracle import oracle
    from verification.queries import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, statements = duck(sf_dir), oracle()
    for name in names:
        started = time.time()
        if name not in statements:
            print(f"{name}: {QUERIES[name](spark, sf_dir).count()} rows, no SQL")
            continue
        try:
            found = difference(spark, con, sf_dir, QUERIES[name], statements[name])
        except Exception as problem:  # noqa: BLE001 - report and go on
            found = f"{type(problem).__name__}: {str(problem)[:1500]}"
        print(f"{name}: {found or 'equal'} ({time.time() - started:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
