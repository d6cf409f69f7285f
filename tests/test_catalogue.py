"""Every registered query against its SQL counterpart on the driver's tables."""

from __future__ import annotations

import pytest
from compare import differences, duckdb_views

import __spark_entry__ as contract
from censusloom.catalog import oracle, queries

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def views(sf_dir):
    return duckdb_views(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry_has_a_stable_schema(spark, sf_dir):
    df = contract.entry(spark)
    assert df.columns[:3] == ["year", "month", "snapshot_month"] and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, views, name):
    assert differences(QUERIES[name](spark, sf_dir), views, ORACLE[name]) == []
