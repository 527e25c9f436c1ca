"""Every query with an SQL counterpart gives the same rows at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_points
import check

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check.database(FOLDER)


def test_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns[:2] == ["CUST_CODE", "PROD_CODE"]


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert check.compare(df, db.sql(entry_points.oracle_sql()[name])) == ""
