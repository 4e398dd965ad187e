"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
import oracle
from lectern.catalog import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    sql = entry_points.oracle_sql().get(name)
    assert sql is not None
    assert oracle.compare(df, con, sql) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
