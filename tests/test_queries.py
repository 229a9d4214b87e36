"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from starmart.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert driver.queries().keys() >= QUERIES.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
