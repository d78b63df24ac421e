"""Numbering rows over a whole dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from devsignals.session import written


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Row number over all rows without bringing them into one task.

    `order` must be unique. Rows are range-partitioned and sorted, numbered inside
    their partition, and written once so that ranges and numbers stay as drawn. The
    start of a partition is the row count of those before it; that table has one row
    per partition, so it is the only thing put into a single task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = written(
        ranged.select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_pos"),
        ),
        "ranked",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        local.join(starts, "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + 1)
        .select(name, *df.columns)
    )


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int, name: str = "position") -> DataFrame:
    """The first k rows of each group, numbered. Spark cuts each task's share of a group
    to k rows before the shuffle, so a large group is no load."""
    number = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(name, number).filter(F.col(name) <= k)


def first_rows(df: DataFrame, column: str, order: Sequence[Column], k: int, descending: bool = True) -> DataFrame:
    """The first k rows in an order that begins with `column`, NULL first, without reading wide columns of all rows.

    The k-th value of the column is a scalar subquery over that column alone. It bounds the scan of the wide rows, where it skips the
    row groups that lie behind it: nearly all of them in a table that is clustered by the column. Nothing runs while planning.
    """
    first = F.desc_nulls_first(column) if descending else F.asc_nulls_first(column)
    edge = F.min(column) if descending else F.max(column)
    bound = df.select(column).orderBy(first).limit(k).agg(edge.alias("edge")).scalar()
    near = F.col(column) >= bound if descending else F.col(column) <= bound
    return df.filter(F.col(column).isNull() | near).orderBy(*order).limit(k)
