"""Reports on news stories and on mentions of repositories."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from devsignals import params
from devsignals.functions import numeric
from devsignals.operators.ranking import first_rows
from devsignals.plans.repositories import in_range, total


def hn_platform_kpis(stories: DataFrame) -> DataFrame:
    return stories.agg(
        F.count("story_id").alias("total_stories"),
        F.coalesce(numeric.mean(F.col("score"), 1), F.lit(0.0)).alias("avg_score"),
        F.countDistinct("author").alias("unique_authors"),
        total("comment_count").alias("total_comments"),
    )


def hn_daily_activity(facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return facts.filter(in_range(start, end)).drop("created_at").orderBy("activity_date")


def _highest() -> list[Column]:
    return [F.desc_nulls_first("score"), F.desc_nulls_first("comment_count"), F.asc("story_id")]


def trending_stories(stories: DataFrame, held: int = params.TRENDING_HELD) -> DataFrame:
    """The `held` stories of the highest scores, for the report below. Written when the tables are built."""
    return first_rows(stories, "score", _highest(), held)


def hn_trending_stories(stories: DataFrame, limit: int = 10, trending: DataFrame | None = None,
                        held: int = params.TRENDING_HELD) -> DataFrame:
    """Read from `trending` if that holds as many rows, else from all stories."""
    rows = stories if trending is None or limit > held else trending
    return first_rows(rows, "score", _highest(), limit).select(
        "story_id", "title", "author", "url", "score", "comment_count", "published_at")


def hn_top_authors(stories: DataFrame, limit: int = 10) -> DataFrame:
    return (
        stories.filter(F.col("author").isNotNull())
        .groupBy("author")
        .agg(F.count("story_id").alias("story_count"), F.sum("score").alias("total_score"))
        .orderBy(F.desc("story_count"), F.desc_nulls_first("total_score"), "author")
        .limit(limit)
    )


def hn_repo_mentions_daily(facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return facts.filter(in_range(start, end)).drop("created_at").orderBy("activity_date", "mentioned_repo")


def hn_mention_summary(facts: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    chosen = facts.filter(in_range(start, end)) if start and end else facts
    return (
        chosen.groupBy("mentioned_repo")
        .agg(
            F.sum("mention_count").alias("total_mentions"),
            F.sum("total_score").alias("total_score"),
            F.sum("total_comments").alias("total_comments"),
        )
        .orderBy(F.desc_nulls_first("total_mentions"), "mentioned_repo")
    )


_LISTED = ("story_id", "title", "author", "score", "comment_count", "published_at", "url")


def _latest() -> list[Column]:
    return [F.desc_nulls_first("published_at"), F.asc("story_id")]


def hn_recent_stories(stories: DataFrame, limit: int = 10) -> DataFrame:
    return first_rows(stories, "published_at", _latest(), limit).select(*_LISTED)


def hn_repo_stories(found: DataFrame, repo: str, limit: int = 5) -> DataFrame:
    """`found` are the stored mentions, of which one repository's folder is read."""
    return found.filter(F.col("mentioned_repo") == repo).select(*_LISTED).orderBy(*_latest()).limit(limit)


def hn_mentions_over_time(facts: DataFrame, repo: str, start: dt.date, end: dt.date) -> DataFrame:
    return (
        facts.filter((F.col("mentioned_repo") == repo) & in_range(start, end))
        .select("activity_date", "mention_count", "total_score", "total_comments")
        .orderBy("activity_date")
    )


def hn_repo_period_totals(facts: DataFrame, repo: str, start: dt.date, end: dt.date) -> DataFrame:
    """Totals of the period, and whether it has enough days to draw a trend."""
    return hn_mentions_over_time(facts, repo, start, end).agg(
        total("mention_count").alias("total_mentions"),
        total("total_score").alias("total_score"),
        total("total_comments").alias("total_comments"),
        (F.count(F.lit(1)) >= params.MIN_TREND_POINTS).alias("show_trend"),
    )
