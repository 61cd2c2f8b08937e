"""What the plans must look like to hold at scale."""

import re

import pytest
from shared import SF_DIR

from sluice.domains import vehicles as domain
from sluice.operators import measures
from sluice.operators.dedupe import duplicate_keys
from sluice.operators.joins import lookup
from sluice.operators.rules import valid_rows
from sluice.sinks.files import publish, stage
from sluice.sources.files import read_slice
from verification import queries as q


RUN_WHEN_CALLED = (
    "slice_counts count_delta slice_overwrite partition_diff register_partitions register_moved_root "
    "write_modes warehouse_counts quality_listing slice_failed_rewrite append_rerun partition_sync warehouse_resume"
).split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, word):
    return len(re.findall(rf"\b{word}\b", text))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staged"))
    c = q.curation(spark, SF_DIR)
    return {
        "events": stage(c.enriched, folder, "events"),
        "telemetry": stage(c.telemetry.evaluated, folder, "telemetry"),
        "service": stage(c.service.valid, folder, "service"),
        "vehicles": stage(c.vehicles.valid, folder, "vehicles"),
        "dealers": stage(c.dealers.valid, folder, "dealers"),
    }


def test_cleaning_and_dedupe_shuffle_once(spark):
    text = plan(q.curation(spark, SF_DIR).telemetry.evaluated)
    assert count(text, "Exchange") == 1
    assert "Python" not in text
    # Copies are dropped before the shuffle too.
    assert text.index("partial_min") > text.index("Exchange")


def test_rules_are_read_back_as_a_pushed_filter(staged):
    text = plan(valid_rows(staged["telemetry"]).select("vin"))
    assert "EqualTo(reject_reason,)" in text
    assert "ReadSchema: struct<vin:string,reject_reason:string>" in text


def test_summary_scans_once_and_reads_what_it_uses(staged):
    text = plan(measures.daily_summary(staged["events"]))
    assert count(text, "FileScan") == 1
    assert count(text, "Exchange") == 2
    assert "Join" not in text
    assert "tire_pressure_fl" not in text


def test_duplicate_check_reads_the_key_alone(staged):
    text = plan(duplicate_keys(staged["events"], domain.EVENT_KEY))
    assert "ReadSchema: struct<vin:string,event_timestamp:timestamp,dtc_code:string>" in text


def test_services_are_summed_before_each_join(staged):
    text = plan(measures.service_kpis(staged["service"], staged["vehicles"], staged["dealers"]))
    assert count(text, "FileScan") == 3
    assert text.index("Join [dealer_id") < text.index("HashAggregate") < text.index("Join [vin")


def test_no_cross_joins(staged):
    for how in ("inner", "left", "left_anti"):
        text = plan(lookup(staged["telemetry"], staged["vehicles"].select("vin"), "vin", how))
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_enrichment_reads_each_branch_of_the_events_once(spark):
    text = plan(q.QUERIES["enriched"](spark, SF_DIR))
    assert count(text, "FileScan") <= 10


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_no_query_has_a_cross_join(spark, name):
    if name in RUN_WHEN_CALLED or name.endswith("_job"):
        pytest.skip("runs its work when called; covered by the oracle tests")
    text = plan(q.QUERIES[name](spark, SF_DIR))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_a_slice_is_read_from_its_own_folder(spark, staged, tmp_path):
    spec = domain.OUTPUTS["service_events_clean"]
    publish(staged["service"], str(tmp_path), spec, q.BUSINESS_DATE)
    df = read_slice(spark, str(tmp_path), spec.name, spec.schema, q.BUSINESS_DATE)
    assert all(f"business_date={q.BUSINESS_DATE}" in f for f in df.inputFiles())
    assert df.select("business_date").distinct().first()[0] == q.BUSINESS_DATE
