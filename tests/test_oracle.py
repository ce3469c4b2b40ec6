"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as entry_points
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry_is_the_monthly_kpis(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["year", "month", "trips", "total_fare", "total_tip", "avg_distance"]
    assert result.count() == 84


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, con, ORACLE_SQL[name]) == []
