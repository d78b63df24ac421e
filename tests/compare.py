"""Compare a registered query with its SQL on one data folder."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
               "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def from_spark(df):
    header = sorted((name, SPARK_TYPES[kind]) for name, kind in df.dtypes)
    return header, rows_of(df.columns, [tuple(r) for r in df.collect()])


def from_sql(con, sql):
    result = con.sql(sql)
    header = sorted((name, str(kind)) for name, kind in zip(result.columns, result.types))
    return header, rows_of(result.columns, result.fetchall())


def difference(left, right):
    """None when equal, else a short text."""
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return f"columns differ: on one side only {sorted(set(lc) ^ set(rc))}"
    if len(lr) != len(rr):
        return f"{len(lr)} rows against {len(rr)}"
    for a, b in zip(lr, rr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            diff = [(c, x, y) for c, x, y in zip(lc, a, b) if x != y or type(x) is not type(y)]
            return f"first difference {str(diff)[:400]}"
    return None
