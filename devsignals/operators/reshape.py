"""Long to wide, and dropping measures without content."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def dates_between(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def activity_matrix(facts: DataFrame, start: dt.date, end: dt.date, row: str = "username",
                    value: str = "total_activity_count") -> DataFrame:
    """One row per user, one column per day of the range, 0 where nothing happened.

    The columns come from the range, not from the data: no extra pass to find them.
    """
    days = dates_between(start, end)
    return (
        facts.filter(F.col("activity_date").between(F.lit(start), F.lit(end)))
        .withColumn("_day", F.date_format("activity_date", "yyyy-MM-dd"))
        .groupBy(row)
        .pivot("_day", [d.isoformat() for d in days])
        .agg(F.sum(value))
        .na.fill(0)
    )


def drop_empty_measures(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Drop the measures that add up to zero. Reads one row of sums."""
    sums = df.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]).first()
    return df.drop(*[m for m in measures if sums[m] == 0])
