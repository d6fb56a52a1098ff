import os

import pytest

import __spark_entry__ as contract
from compare import canonical, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

QUERIES, SQL = contract.queries(), contract.oracle_sql()


def test_names():
    assert set(SQL) <= set(QUERIES) and contract.FLAGSHIP in SQL


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() == 12 and "rank" in rows.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    with duck(SF) as connection:
        want = connection.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
