"""Every registered query against its SQL on the smallest tables."""

import pytest

import compare
from halocline.queries.oracle import SQL
from halocline.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare.difference(got, con.execute(SQL[name]).df()) is None


def test_entry(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
