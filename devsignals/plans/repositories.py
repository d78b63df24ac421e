"""Reports on repositories: overview, comparison, daily activity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from devsignals.functions import numeric
from devsignals.functions.times import checked_range


def in_range(start: dt.date, end: dt.date, column: str = "activity_date") -> Column:
    """Both ends belong to the range. On facts stored by day this prunes folders."""
    start, end = checked_range(start, end)
    return F.col(column).between(F.lit(start), F.lit(end))


def since(as_of: dt.date, days: int, column: str = "activity_date") -> Column:
    return F.col(column) >= F.date_sub(F.lit(as_of), days)


def total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def platform_kpis(repositories: DataFrame) -> DataFrame:
    return repositories.agg(
        total("total_commits").alias("total_commits"),
        total("total_pushes").alias("total_pushes"),
        total("total_pr_events").alias("total_pr_events"),
        F.count("repo_name").alias("repo_count"),
    )


def daily_activity_all_repos(facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    measures = ("commit_count", "pr_event_count", "push_count", "total_activity_count")
    return (
        facts.filter(in_range(start, end))
        .groupBy("activity_date")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .orderBy("activity_date")
    )


def event_distribution(facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        facts.filter(in_range(start, end))
        .groupBy("activity_date")
        .agg(F.sum("push_count").alias("push_count"), F.sum("pr_event_count").alias("pr_event_count"))
        .orderBy("activity_date")
    )


def repo_comparison(repositories: DataFrame) -> DataFrame:
    return repositories.select("repo_name", "total_commits", "total_pushes", "total_pr_events", "stars").orderBy(
        F.desc_nulls_first("total_commits"), "repo_name"
    )


def repository_list(repositories: DataFrame) -> DataFrame:
    return repositories.select("repo_name").orderBy(F.asc_nulls_last("repo_name"))


def repo_kpis(repositories: DataFrame, repo: str) -> DataFrame:
    return repositories.filter(F.col("repo_name") == repo).select(
        "repo_name", "owner", "language", "stars", "total_pushes", "total_commits", "total_pr_events",
        "first_active_date", "last_active_date",
    )


def repo_daily_activity(facts: DataFrame, repo: str, start: dt.date, end: dt.date) -> DataFrame:
    return (
        facts.filter((F.col("repo_name") == repo) & in_range(start, end))
        .orderBy("activity_date")
        .select(
            F.date_format("activity_date", "yyyy-MM-dd").alias("activity_date"),
            "commit_count", "push_count", "push_avg_commits", "pr_event_count", "pr_opened", "pr_merged",
            "pr_closed", "pr_merged_pct", "total_activity_count",
        )
    )


def repo_summary(facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The merge rate is the plain mean of the daily rates, days without one left out."""
    return (
        facts.filter(in_range(start, end))
        .groupBy("repo_name")
        .agg(
            F.sum("commit_count").alias("total_commits"),
            F.sum("push_count").alias("total_pushes"),
            F.sum("pr_event_count").alias("total_pr_events"),
            F.sum("pr_merged").alias("pr_merged"),
            numeric.mean_of_percents(F.col("pr_merged_pct")).alias("avg_merge_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("total_commits"), "repo_name")
    )


def activity_metric_fallback(repositories: DataFrame, facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Daily commits, or pushes when no commit is known at all (sources cut commit lists).

    The total is a scalar subquery, so it is that of the run and not of the planning.
    """
    has_commits = F.coalesce(platform_kpis(repositories).select("total_commits").scalar(), F.lit(0)) > 0
    return daily_activity_all_repos(facts, start, end).select(
        "activity_date",
        F.when(has_commits, "commit_count").otherwise("push_count").alias("metric_name"),
        F.when(has_commits, F.col("commit_count")).otherwise(F.col("push_count")).alias("metric_value"),
    )


def pr_performance_summary(facts: DataFrame, repo: str, start: dt.date, end: dt.date) -> DataFrame:
    """Here the rate is merged to opened, 0 when nothing was opened."""
    opened, merged = total("pr_opened"), total("pr_merged")
    return facts.filter((F.col("repo_name") == repo) & in_range(start, end)).agg(
        opened.alias("total_opened"), merged.alias("total_merged")
    ).withColumn(
        "merge_rate_pct",
        F.coalesce(numeric.percent(F.col("total_merged"), F.col("total_opened"), 1), F.lit(0.0)),
    )


def repo_scorecard(repositories: DataFrame) -> DataFrame:
    return repositories.select(
        "repo_name", "owner", "language", "stars", "total_pushes", "total_commits", "total_pr_events", "last_active_date"
    ).orderBy(F.desc_nulls_first("total_commits"), "repo_name")


def daily_trend(facts: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    return (
        facts.filter(since(as_of, days))
        .select("activity_date", "repo_name", "commit_count", "pr_event_count", "pr_merged_pct",
                "total_activity_count", "pr_merged")
        .orderBy("repo_name", "activity_date")
    )


def recent_days(facts: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """All measures of the last days, newest first."""
    return (
        facts.filter(since(as_of, days))
        .drop("repo_id", "created_at")
        .orderBy(F.desc_nulls_first("activity_date"), F.desc_nulls_first("commit_count"), "repo_name")
    )


def commits_of_contributor(facts: DataFrame, contributors: DataFrame, username: str) -> DataFrame:
    """Commits of one user, found by the surrogate key of the dimension."""
    key = contributors.filter(F.col("username") == username).select("contrib_id")
    return facts.join(key, "contrib_id", "left_semi").agg(total("commits_in_pushes").alias("commits"))
