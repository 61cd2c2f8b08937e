"""Operators on small frames, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import measures
from sluice.operators.cleaning import nullify_strings
from sluice.operators.dedupe import dedupe, duplicate_keys, latest_by
from sluice.operators.joins import lookup, unknown_refs
from sluice.operators.quality import (
    Check,
    GateError,
    count_delta,
    enforce,
    quality_listing,
    quality_report,
    rate_checks,
    reconcile,
)
from sluice.operators.rules import (
    REASON,
    Rule,
    below,
    evaluate,
    invalid_rows,
    missing,
    not_among,
    not_length,
    outside,
    reason_counts,
    reject_envelope,
    split,
    union_all,
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_sweep_touches_strings_only(spark):
    df = spark.createDataFrame([(" n/a ", 1, "x ")], "a string, n int, b string")
    assert [tuple(r) for r in nullify_strings(df).collect()] == [(None, 1, "x")]


# --- rules ------------------------------------------------------------------


def test_reasons_keep_first_seen_order_once(spark):
    df = spark.createDataFrame([(1,)], "x int")
    yes, no = F.col("x") == 1, F.col("x") == 2
    rules = [Rule("b", yes), Rule("x", no), Rule("a", yes), Rule("b", yes)]
    assert evaluate(df, rules).first()[REASON] == "b|a"


def test_repeated_reason_keeps_its_first_place(spark):
    df = spark.createDataFrame([(20.0, 70.0, None)], "a double, b double, c double")
    rules = []
    for name in "abc":
        rules += [missing(name, "missing"), outside(name, 15, 60, "invalid")]
    assert evaluate(df, rules).first()[REASON] == "invalid|missing"


def test_rules_on_null_do_not_fire(spark):
    df = spark.createDataFrame([(None, None)], "s string, n double")
    rules = [
        not_among("s", ["A"], "set"),
        not_length("s", 3, "length"),
        outside("n", 0, 1, "range"),
        below("n", 0, "below"),
    ]
    valid, invalid = split(df, rules)
    assert (valid.count(), invalid.count()) == (1, 0)


def test_nan_is_out_of_range(spark):
    df = spark.createDataFrame([(float("nan"),)], "n double")
    assert evaluate(df, [outside("n", 0, 1, "range")]).first()[REASON] == "range"


def test_split_is_a_partition(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    valid, invalid = split(df, [missing("v", "none"), below("v", 50, "small")])
    assert rows(valid) + rows(invalid.drop(REASON)) == rows(df)
    assert valid.columns == df.columns


def test_envelope_and_reason_counts(spark, run):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    bad = invalid_rows(evaluate(df, [missing("a", "no_a"), missing("b", "no_b")]))
    wrapped = reject_envelope(bad, "things", run)
    assert {r.record_json for r in wrapped.collect()} == {
        '{"a":1,"reject_reason":"no_b"}',
        '{"reject_reason":"no_a|no_b"}',
    }
    assert rows(reason_counts(wrapped)) == Counter([("things", "no_a", 1), ("things", "no_b", 2)])


def test_union_all(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert rows(union_all([a, b, a])) == Counter({(1, "x"): 2, (2, None): 1})
    assert union_all([]) is None


# --- dedupe -----------------------------------------------------------------


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.sampled_from("ab")),
            st.integers(0, 5),
            st.one_of(st.none(), st.integers(0, 2)),
        ),
        max_size=40,
    )
)
def test_dedupe_keeps_the_first_of_each_key(spark, data):
    df = spark.createDataFrame(data, "k int, k2 string, o int, v int").repartition(3)
    got = dedupe(df, ["k", "k2"], ["o"], "n")
    assert got.columns == ["k", "k2", "o", "v", "n"]
    groups = defaultdict(list)
    for row in data:
        groups[row[:2]].append(row)
    # Of copies that tie in the order, one with a value comes before one without.
    want = [
        (*min(members, key=lambda r: (r[2], r[3] is None, r[3] or 0)), len(members))
        for members in groups.values()
    ]
    assert rows(got) == Counter(want)


def test_dedupe_without_order_depends_on_content_alone(spark):
    data = [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, s string, d double").repartition(seed + 1)
        seen.add(frozenset(rows(dedupe(df, ["k"]))))
    assert seen == {frozenset({(1, "a", 3.0), (2, None, 1.0)})}


def test_dedupe_on_all_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(dedupe(df, ["k"], copies="n")) == Counter([(1, 2), (None, 1)])
    assert rows(dedupe(df, ["k"])) == Counter([(1,), (None,)])


def test_latest_and_duplicates(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "q"), ("b", 0, "r")],
        "k string, t int, id string",
    )
    latest = latest_by(df, ["k"], [F.col("t").desc_nulls_last(), F.col("id").asc()])
    assert rows(latest) == Counter([("a", 3, "y"), ("b", 0, "r")])
    assert rows(duplicate_keys(df, ["k"])) == Counter([("a", 3), ("b", 2)])


def test_latest_limits_each_group_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_by(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


# --- joins ------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with two thirds of the rows, rows without a key, unknown keys."""
    left = spark.range(600).select(
        F.when(F.col("id") % 3 < 2, "hot")
        .when(F.col("id") % 30 == 2, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
        .alias("k"),
        "id",
    )
    ref = spark.createDataFrame(
        [("hot", 1), *[(f"k{i}", i) for i in range(0, 40, 2)], ("unused", 0)], "k string, v int"
    )
    return left, ref


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_lookup_of_a_hot_key_equals_a_plain_join(skewed, how):
    left, ref = skewed
    want = left.join(ref, "k", how)
    for small in (False, True):
        assert rows(lookup(left, ref, "k", how, small)) == rows(want)
        assert lookup(left, ref, "k", how, small).columns == want.columns


def test_a_complete_copy_beats_one_with_gaps(spark):
    copies = [("k", None, "x"), ("k", 5.0, "x"), ("k", 7.0, None), ("only", None, None)]
    df = spark.createDataFrame(copies, "k string, v double, w string")
    assert rows(dedupe(df, ["k"])) == Counter([("k", 5.0, "x"), ("only", None, None)])
    assert rows(dedupe(df, ["k"], ["w"])) == Counter([("k", 7.0, None), ("only", None, None)])


def test_unknown_refs_include_rows_without_key(skewed):
    left, ref = skewed
    known = {r.k for r in ref.collect()}
    want = Counter(tuple(r) for r in left.collect() if r.k not in known)
    assert rows(unknown_refs(left, ref, "k")) == want
    assert rows(unknown_refs(left, ref, "k", small=True)) == want


# --- measures ---------------------------------------------------------------

ENRICHED = (
    "business_date string, event_date string, country string, customer_region string, model string, "
    "model_year int, powertrain string, severity string, vin string, odometer_km double, "
    "battery_voltage double, engine_temp_c double"
)


def enriched_rows():
    rng = random.Random(7)
    out = []
    for _ in range(400):
        out.append(
            (
                "2026-12-01",
                rng.choice(["2026-11-30", "2026-12-01"]),
                rng.choice(["DE", None]),
                "EU",
                rng.choice(["A", "B"]),
                rng.choice([2020, None]),
                "EV",
                rng.choice(["LOW", "HIGH", "CRITICAL"]),
                rng.choice([f"v{i}" for i in range(9)]),
                rng.choice([float(rng.randint(0, 999)), None]),
                rng.choice([12.5, None]),
                None,
            )
        )
    return out


@pytest.mark.parametrize("null_safe", [False, True])
def test_daily_summary_equals_plain_python(spark, null_safe):
    data = enriched_rows()
    got = {
        tuple(r)[:8]: tuple(r)[8:]
        for r in measures.daily_summary(spark.createDataFrame(data, ENRICHED), null_safe).collect()
    }
    groups = defaultdict(list)
    for row in data:
        groups[row[:8]].append(row)

    def avg(values):
        values = [v for v in values if v is not None]
        return sum(values) / len(values) if values else None

    assert set(got) == set(groups)
    for key, members in groups.items():
        vins = Counter(m[8] for m in members)
        warns = key[7] in ("HIGH", "CRITICAL")
        repeats = sum(1 for n in vins.values() if n > 1) if warns else 0
        if None in key and not null_safe:
            repeats = 0
        odometers = [m[9] for m in members if m[9] is not None]
        assert got[key] == (
            len(members),
            len(vins),
            len(members) if key[7] == "CRITICAL" else 0,
            avg(odometers),
            max(odometers, default=None),
            avg([m[10] for m in members]),
            None,
            repeats,
        )


def test_service_kpis_equal_a_join_before_the_aggregate(spark):
    service = spark.createDataFrame(
        [
            ("2026-12-01", "v1", "d1", "OIL", "1.10", 1.0, 2.0, True),
            ("2026-12-01", "v1", "d1", "OIL", "2.20", 3.0, 4.0, None),
            ("2026-12-01", "v2", "d1", "OIL", "3.30", None, 6.0, False),
            ("2026-12-01", "v9", "d9", "OIL", "4.40", 7.0, 8.0, True),
            ("2026-12-01", "v2", None, "TYRES", None, 9.0, 1.0, None),
        ],
        "business_date string, vin string, dealer_id string, service_type string, cost string, "
        "service_duration_hours double, labor_hours double, warranty_flag boolean",
    ).withColumn("parts_cost", F.col("cost").cast("decimal(12,2)"))
    vehicles = spark.createDataFrame(
        [("v1", "A", 2020, "EV", "EU"), ("v2", "A", 2020, "EV", "EU")],
        "vin string, model string, model_year int, powertrain string, customer_region string",
    )
    dealers = spark.createDataFrame(
        [("d1", "One", "DE", "EU", "T1")],
        "dealer_id string, dealer_name string, country string, region string, dealer_tier string",
    )
    got = measures.service_kpis(service, vehicles, dealers)
    joined = service.join(vehicles, "vin", "left").join(dealers, "dealer_id", "left")
    want = joined.groupBy(*measures.SERVICE_DIMENSIONS).agg(
        F.count("*"),
        F.avg("service_duration_hours"),
        F.avg("labor_hours"),
        F.sum("parts_cost").cast("decimal(38,2)"),
        F.avg(F.col("warranty_flag").cast("double")),
    )
    assert rows(got) == rows(want)
    assert rows(measures.service_kpis(service, vehicles, dealers, small_vehicles=True)) == rows(want)


def test_daily_revenue_counts_orders_once(spark):
    sales = spark.createDataFrame(
        [("d1", "o1", 1, 0.10), ("d1", "o1", 2, 0.20), ("d1", "o2", 3, 1.254), ("d1", None, 1, 1.0)],
        "order_date string, order_id string, quantity int, total_amount double",
    )
    assert rows(measures.daily_revenue(sales)) == Counter([("d1", 2, 7, 2.55)])


# --- quality ----------------------------------------------------------------


def test_gate(spark, run):
    enforce([Check("t", "m", 0)])
    with pytest.raises(GateError, match="t.m=3"):
        enforce([Check("t", "m", 3)])
    assert rate_checks(0, 0, 0.1) == []
    assert rate_checks(10, 1, 0.1) == []
    assert rate_checks(10, 2, 0.1) == [Check("pipeline", "reject_rate_threshold_exceeded", 1)]
    report = quality_report(spark, [Check("t", "m", 0), Check("t", "k", 2)], {"n": 5}, run)
    assert {(r.metric_name, r.metric_value, r.status) for r in report.collect()} == {
        ("m", 0, "PASSED"),
        ("k", 2, "FAILED"),
        ("n", 5, "INFO"),
    }
    assert quality_listing(report, run.business_date).count() == 3
    assert quality_listing(report, "2000-01-01").count() == 0


def test_reconcile_and_delta(spark):
    detail = spark.range(7)
    summary = spark.createDataFrame([(3,), (5,)], "n bigint")
    empty = summary.filter("n < 0")
    assert tuple(reconcile(detail, summary, "n").first()) == (7, 8, 1)
    assert tuple(reconcile(detail, empty, "n").first()) == (7, 0, 7)
    assert tuple(count_delta(detail, summary, "t").first()) == ("t", 7, 2, -5)
