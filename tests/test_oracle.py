"""Every query against its SQL on DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check import compare, connect
from tidemark import suite

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    entry_points.queries()
    assert set(suite.ORACLE) == set(suite.QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).columns[0] == "product_category"


suite.load()


@pytest.mark.parametrize("name", sorted(suite.QUERIES))
def test_query(spark, con, name):
    status, note, _ = compare(spark, con, name, SF)
    assert status == "ok", note
