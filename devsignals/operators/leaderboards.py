"""Ranks of contributors, given once when the tables are built."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from devsignals.operators.ranking import global_row_number

ALL = "All"


def _within(rows: DataFrame, group: list[str], name: str) -> DataFrame:
    """Rank by activity, then name, within each group: the place among all rows less the places before the group. No
    group, not even that of all contributors, meets in one task."""
    order = [*[F.asc(c) for c in group], F.desc_nulls_first("total_activity"), F.asc_nulls_last("username")]
    placed = global_row_number(rows, order, "_place")
    starts = placed.groupBy(*group).agg(F.min("_place").alias("_start"))
    return placed.join(starts, group).withColumn(name, (F.col("_place") - F.col("_start") + 1).cast("bigint")).drop("_place", "_start")


def ranked_contributors(contributors: DataFrame, by_repository: DataFrame) -> DataFrame:
    """scope (a repository, or all), rank in it, rank_in_type, and the contributor's totals there. `by_repository` holds
    the totals per repository and user."""
    everywhere = contributors.select(
        F.lit(ALL).alias("scope"), "username", "contrib_type",
        (F.col("total_push_events") + F.col("total_pr_events")).alias("total_activity"), "total_push_events", "total_pr_events")
    inside = by_repository.join(contributors.select("username", "contrib_type"), "username").select(
        F.col("repo_name").alias("scope"), "username", "contrib_type", (F.col("pushes") + F.col("pr_events")).alias("total_activity"),
        F.col("pushes").alias("total_push_events"), F.col("pr_events").alias("total_pr_events"))
    rows = everywhere.unionByName(inside)
    return _within(_within(rows, ["scope"], "rank"), ["scope", "contrib_type"], "rank_in_type")
