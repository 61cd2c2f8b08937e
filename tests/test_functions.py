"""Column helpers on single values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions import (
    as_json,
    hours_between,
    norm_code,
    norm_id,
    nullify,
    quoted,
    risk_band,
    title_case,
    to_dt,
    to_flag,
    to_number,
    to_ts,
    trim_upper,
)


def apply(spark, make, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_null_markers(spark):
    gone = [" na ", "N/A", "none", "null", "UNKNOWN", "unknown ", "", "   ", None]
    assert apply(spark, nullify, gone) == [None] * len(gone)
    kept = ["\tNA", "-", "nan", " a b ", "unknown1", "UNKNOWN-VIN-000000"]
    assert apply(spark, nullify, kept) == ["\tNA", "-", "nan", "a b", "unknown1", "UNKNOWN-VIN-000000"]


def test_own_markers(spark):
    assert apply(spark, lambda c: nullify(c, ("?",)), ["?", "NA", " ? "]) == [None, "NA", None]


NUMBERS = [
    ("1,234.5", 1234.5, None, "1234.50"),
    ("1.5e3", 1.53, None, "1.53"),
    ("-5 km", -5.0, -5, "-5.00"),
    ("(5)", 5.0, 5, "5.00"),
    ("1/2", 12.0, 12, "12.00"),
    ("12-3", None, None, None),
    ("1.2.3", None, None, None),
    ("--", None, None, None),
    ("abc", None, None, None),
    ("", None, None, None),
    ("2024.0", 2024.0, None, "2024.00"),
    ("12.345", 12.345, None, "12.35"),
    ("12.344", 12.344, None, "12.34"),
    ("99999999999.99", 99999999999.99, None, None),
    (None, None, None, None),
]


@pytest.mark.parametrize("kind, position", [("double", 1), ("int", 2), ("decimal(12,2)", 3)])
def test_numbers(spark, kind, position):
    got = apply(spark, lambda c: to_number(c, kind), [n[0] for n in NUMBERS])
    want = [n[position] for n in NUMBERS]
    if kind.startswith("decimal"):
        want = [None if w is None else Decimal(w) for w in want]
    assert got == want


DAY = dt.datetime(2026, 6, 25)
TIMES = [
    ("2026-06-25 10:00:00", DAY.replace(hour=10)),
    ("2026-06-25 10:00", DAY.replace(hour=10)),
    ("2026-06-25T10:00:00+02:00", DAY.replace(hour=8)),
    ("2026-06-25", DAY),
    ("2026-06", dt.datetime(2026, 6, 1)),
    ("2026", dt.datetime(2026, 1, 1)),
    ("2026-6-5 1:2:3", dt.datetime(2026, 6, 5, 1, 2, 3)),
    ("2026-06-25 10:00:00.123456789", DAY.replace(hour=10, microsecond=123456)),
    ("2026-06-25 25:00:00", None),
    ("06/25/2026 10:00:00", None),
    ("20260625", None),
    ("2026-13-01", None),
    ("2026-02-30", None),
    ("12:30", None),
    ("T12:30", None),
    (None, None),
]


def test_timestamps(spark):
    got = apply(spark, lambda c: F.date_format(to_ts(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"), [t[0] for t in TIMES])
    assert got == [None if t[1] is None else t[1].strftime("%Y-%m-%d %H:%M:%S.%f") for t in TIMES]


def test_timestamp_patterns(spark):
    got = apply(
        spark,
        lambda c: to_ts(c, ("dd.MM.yyyy HH:mm",)).cast("string"),
        ["25.06.2026 10:30", "2026-06-25 10:30:00", "x"],
    )
    assert got == ["2026-06-25 10:30:00", "2026-06-25 10:30:00", None]


def test_dates(spark):
    texts = ["2026-06-25", "2026-06", "2026", "2026-06-25 25:00:00", "12:30", "20260625", "2026-02-30"]
    assert apply(spark, to_dt, texts) == [
        dt.date(2026, 6, 25),
        dt.date(2026, 6, 1),
        dt.date(2026, 1, 1),
        dt.date(2026, 6, 25),
        None,
        None,
        None,
    ]


def test_identifiers(spark):
    got = apply(spark, norm_id, [" wp0-zzz 99 ", "---", "äÖ9_x", None])
    assert got == ["WP0ZZZ99", "", "9X", None]


def test_codes_titles_flags(spark):
    assert apply(spark, norm_code, ["in  progress", "a\tb", None]) == ["IN_PROGRESS", "A_B", None]
    assert apply(spark, title_case, ["40 GT7 rs", "rider e-hybrid"]) == ["40 Gt7 Rs", "Rider E-hybrid"]
    assert apply(spark, trim_upper, [" d01 "]) == ["D01"]
    flags = apply(spark, to_flag, ["y", "Yes", "TRUE", "1", "no", "x", None])
    assert flags == [True, True, True, True, False, False, None]


def test_hours_floor_sub_seconds(spark):
    df = spark.sql(
        "select timestamp'2026-01-01 00:00:00.9' as a, timestamp'2026-01-01 01:30:00.1' as b, "
        "cast(null as timestamp) as c"
    )
    row = df.select(
        hours_between(F.col("a"), F.col("b")).alias("ab"),
        hours_between(F.col("b"), F.col("a")).alias("ba"),
        hours_between(F.col("a"), F.col("c")).alias("ac"),
    ).first()
    assert (row.ab, row.ba, row.ac) == (1.5, -1.5, None)


def test_json_leaves_nulls_out(spark):
    df = spark.sql(
        "select cast(null as string) as a, timestamp'2026-01-01 00:00:00' as t, "
        "cast(1.5 as decimal(12,2)) as d, date'2026-01-02' as day"
    )
    text = df.select(as_json(df.columns).alias("j")).first().j
    assert text == '{"t":"2026-01-01T00:00:00.000Z","d":1.50,"day":"2026-01-02"}'


def test_risk_band(spark):
    df = spark.createDataFrame([(1, 1), (0, 2), (0, 0)], "c int, h int")
    bands = [r.b for r in df.select(risk_band(F.col("c"), F.col("h")).alias("b")).collect()]
    assert bands == ["CRITICAL_ATTENTION", "WATCHLIST", "NORMAL"]


def test_quoted():
    assert quoted("a`b") == "`a``b`"
