"""Every registered query against DuckDB, exactly."""

import os

import pytest
from comparing import differences, duck

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_statement():
    assert set(registered._QUERIES) <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(registered.oracle_sql()))
def test_query(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == []


def test_entry(spark):
    fact = registered.entry(spark)
    assert fact.count() > 0 and "row_hash" in fact.columns
