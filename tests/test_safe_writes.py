"""What a publish or a load leaves behind when it fails, wherever it fails."""

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.sinks import swap
from sluice.sinks.files import publish, run_prefix
from sluice.sinks.loads import commit_load, finish_load, load_together, write_part
from sluice.sinks.store import Store
from sluice.sinks.tables import OutputSpec
from sluice.sources.files import read_slice

DAY = "2026-06-25"
SPEC = OutputSpec("t", "id bigint, business_date string, part string", ("business_date", "part"))
SLICE = f"business_date={DAY}"


def frame(spark, ids):
    return spark.createDataFrame([(i, DAY, "ab"[i % 2]) for i in ids], SPEC.schema)


def ids(spark, root, table="t"):
    df = read_slice(spark, str(root), table, SPEC.schema, DAY)
    return Counter(row.id for row in df.collect())


class Lost(RuntimeError):
    pass


@pytest.fixture
def failing(monkeypatch):
    """Makes the n-th change of a file or folder fail, before or after it is done."""

    def at(n, after):
        left = [n]

        def wrapped(name):
            real = getattr(Store, name)

            def call(self, *args):
                left[0] -= 1
                if left[0] == 0 and not after:
                    raise Lost(name)
                result = real(self, *args)
                if left[0] == 0:
                    raise Lost(name)
                return result

            return call

        for name in ("put", "delete", "rename"):
            monkeypatch.setattr(Store, name, wrapped(name))
        return left

    return at


def test_a_write_that_fails_half_way_leaves_the_slice(spark, tmp_path):
    publish(frame(spark, range(10)), str(tmp_path), SPEC, DAY)
    lost = F.when(F.col("id") == 17, F.raise_error("lost")).otherwise(F.col("id")).cast("bigint")
    with pytest.raises(PySparkException):
        publish(frame(spark, range(10, 20)).repartition(4).withColumn("id", lost), str(tmp_path), SPEC, DAY)
    assert ids(spark, tmp_path) == Counter(range(10))
    publish(frame(spark, [1, 2]), str(tmp_path), SPEC, DAY)
    assert ids(spark, tmp_path) == Counter([1, 2])
    assert not [p for p in (tmp_path / "t" / swap.INCOMING).iterdir()]
    # Whoever reads the table as a whole finds the slice alone.
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


@pytest.mark.parametrize("after", [False, True])
def test_a_failure_at_any_step_of_an_overwrite(spark, tmp_path, failing, after, monkeypatch):
    old, new = Counter(range(4)), Counter(range(10, 15))
    seen = set()
    for step in range(1, 12):
        root = tmp_path / f"{step}"
        publish(frame(spark, old), str(root), SPEC, DAY)
        left = failing(step, after)
        try:
            publish(frame(spark, new), str(root), SPEC, DAY)
            done = True
        except Lost:
            done = False
        monkeypatch.undo()
        found = ids(spark, root)
        assert found in (old, new) and (found == new or not done), step
        seen.add(found == new)
        swap.finish(spark, str(root / "t"), SLICE)
        assert ids(spark, root) == found
        publish(frame(spark, [99]), str(root), SPEC, DAY)
        assert ids(spark, root) == Counter([99])
        if done and left[0] > 0:
            break
    assert seen == {True, False} and done


def test_appends_are_keyed_by_run(spark, tmp_path):
    for run_id, rows in (("a", [1, 2]), ("b/1", [3]), ("a", [4, 5, 6]), ("ab", [7])):
        publish(frame(spark, rows), str(tmp_path), SPEC, DAY, "append", run_id=run_id)
    assert ids(spark, tmp_path) == Counter([3, 4, 5, 6, 7])
    publish(frame(spark, [8]), str(tmp_path), SPEC, DAY, "append")
    assert ids(spark, tmp_path) == Counter([3, 4, 5, 6, 7, 8])
    assert run_prefix("a") != run_prefix("ab") and "/" not in run_prefix("b/1")


@pytest.mark.parametrize("after", [False, True])
def test_a_failure_at_any_step_of_an_append(spark, tmp_path, failing, after, monkeypatch):
    for step in range(1, 14):
        root = tmp_path / f"{step}"
        publish(frame(spark, [1]), str(root), SPEC, DAY, "append", run_id="a")
        publish(frame(spark, [2, 3]), str(root), SPEC, DAY, "append", run_id="b")
        left = failing(step, after)
        try:
            publish(frame(spark, [12, 13]), str(root), SPEC, DAY, "append", run_id="b")
            done = True
        except Lost:
            done = False
        monkeypatch.undo()
        try:
            assert ids(spark, root) in (Counter([1, 2, 3]), Counter([1, 12, 13])), step
        except swap.UnfinishedSwap:
            assert not done
        publish(frame(spark, [22]), str(root), SPEC, DAY, "append", run_id="b")
        assert ids(spark, root) == Counter([1, 22])
        if done and left[0] > 0:
            return
    raise AssertionError("never got through")


def test_tables_are_loaded_together_or_not_at_all(spark, tmp_path):
    from sluice.plans.health import together

    def rows(values):
        return {t: frame(spark, values).drop("business_date") for t in ("t", "u")}

    root = str(tmp_path)
    assert sorted(load_together(spark, root, SLICE, rows([1]), together)) == ["t", "u"]
    # One table's rows cannot be written: neither changes.
    broken = {**rows([2]), "u": rows([2])["u"].withColumn("id", F.raise_error("lost").cast("bigint"))}
    with pytest.raises(PySparkException):
        load_together(spark, root, SLICE, broken, together)
    assert ids(spark, root) == ids(spark, root, "u") == Counter([1])
    assert finish_load(spark, root, SLICE) == []


@pytest.mark.parametrize("after", [False, True])
def test_a_load_that_stops_is_ended_by_the_next(spark, tmp_path, failing, after, monkeypatch):
    for step in range(1, 25):
        root = str(tmp_path / f"{step}")
        parts = [write_part(root, t, SLICE, frame(spark, [7]).drop("business_date")) for t in ("t", "u")]
        commit_load(spark, root, SLICE, parts)
        left = failing(step, after)
        try:
            finish_load(spark, root, SLICE)
            done = True
        except Lost:
            done = False
        monkeypatch.undo()
        assert done or finish_load(spark, root, SLICE) in (["t", "u"], [])
        assert ids(spark, root) == ids(spark, root, "u") == Counter([7]), step
        if done and left[0] > 0:
            return
    raise AssertionError("never got through")
