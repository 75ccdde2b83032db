"""Every registered query against its checking SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests import compare
from workload.oracle import ORACLES
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return compare.open_tables("/root/testdata/sf0.001")


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(QUERIES)
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = compare.sql_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
