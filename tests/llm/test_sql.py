"""Queries that SQL can express give its rows."""

import pytest

from compare import connect, difference, from_spark, from_sql
from devsignals.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(name, spark, data):
    con = connect(data)
    found = difference(from_spark(queries.queries()[name](spark, data)), from_sql(con, SQL[name]))
    con.close()
    assert found is None, found


def test_all_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names
