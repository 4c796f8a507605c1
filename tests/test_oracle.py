"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(name, spark, con):
    message, _, fine = compare(entry.queries()[name], entry.oracle_sql().get(name), spark, con, SF_DIR)
    assert fine, message


def test_entry_runs(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert {"daily_metric_id", "city", "metric_date", "rolling_7d_avg_aqi"} <= set(result.columns)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
