"""Every query with an oracle, against DuckDB on the same files."""

import __spark_entry__ as entry_point
import pytest
from shared import SF_DIR

from verification.compare import difference, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    query = entry_point.queries()[name]
    assert difference(spark, con, SF_DIR, query, entry_point.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
