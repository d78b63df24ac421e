"""Every registered query gives the rows its SQL gives."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference, from_spark, from_sql

QUERIES = entry.core_queries()
SQL = entry.core_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = connect(data)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


FORBIDDEN = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups", "ExistingRDD")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, duck):
    df = QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []
    found = difference(from_spark(df), from_sql(duck, SQL[name]))
    assert found is None, found


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["repo_id", "repo_name", "activity_date"]
