"""Approximate distinct counts from sketches that are stored per day and merged over any range of days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LOG_SIZE = 12              # a sketch has 2^12 registers: standard error 1.04 / 2^6, about 1.6 per cent
ERROR_BOUND = 0.05         # three standard errors


def daily_sketches(rows: DataFrame, keys: Sequence[str], column: str, log_size: int = LOG_SIZE) -> DataFrame:
    """`sketch` of the values of a column per key. Its size is bounded whatever the number of values; NULL is no value."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(column, F.lit(log_size)).alias("sketch"))


def distinct_in_range(sketches: DataFrame, keys: Sequence[str], start: dt.date, end: dt.date) -> DataFrame:
    """Estimated number of distinct values per key over a range of days, from the sketches alone."""
    chosen = sketches.filter(F.col("activity_date").between(start, end))
    return chosen.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
