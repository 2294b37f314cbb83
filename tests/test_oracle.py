"""Every registered query against its oracle SQL in DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, oracle_connection
from gleaner.plans import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    ok, note = compare(spark, oracle, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
