"""News stories: bronze, silver, mentions, dimension and daily facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from devsignals import params
from devsignals.functions import numeric, text, times


def _stg_columns() -> list[Column]:
    return [
        F.col("story_id"),
        F.col("title"),
        F.col("author"),
        F.col("url"),
        F.col("score"),
        F.coalesce("descendants", F.lit(0)).alias("comment_count"),
        F.col("type").alias("story_type"),
        times.from_epoch_seconds(F.col("time")).alias("published_at"),
        F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        F.col("raw_json"),
    ]


def _silver_columns() -> list[Column]:
    return [
        F.col("story_id"),
        F.col("title"),
        F.col("author"),
        F.col("url"),
        F.col("score"),
        F.col("comment_count"),
        F.col("story_type"),
        F.col("published_at"),
        F.col("fetched_at"),
        text.url_domain(F.col("url")).alias("url_domain"),
        text.has_text(F.col("url")).alias("has_url"),
        F.to_date("published_at").alias("activity_date"),
    ]


def _is_silver() -> Column:
    return (F.col("story_type") == params.STORY) & F.col("title").isNotNull()


def stg_stories(raw: DataFrame) -> DataFrame:
    return raw.select(*_stg_columns())


def silver_stories(stg: DataFrame) -> DataFrame:
    """Stories proper (no jobs or polls) with link domain, link flag and day of publication."""
    return stg.filter(_is_silver()).select(*_silver_columns())


FROM_STORIES = ("hn_stories_raw", "int_hn_stories")


def with_silver(raw: DataFrame) -> DataFrame:
    """Raw and silver stories side by side, from one scan: a struct per dataset and a flag that says whether the
    row belongs to it."""
    bronze, silver = FROM_STORIES
    return raw.select(F.struct(*raw.columns).alias(bronze), *_stg_columns()).select(
        bronze, F.lit(True).alias(f"is_{bronze}"),
        F.struct(*_silver_columns()).alias(silver), _is_silver().alias(f"is_{silver}"),
    )


def mentions(stories: DataFrame, patterns: text.Patterns = params.MENTION_PATTERNS) -> DataFrame:
    """One row per story and repository its title names. No join: one expression that
    knows all patterns drops the stories without any before they are told apart."""
    if not patterns:
        raise ValueError("at least one mention pattern is needed")
    found = stories.filter(text.mentions_any(F.col("title"), patterns))
    return found.select(
        "story_id",
        "title",
        "author",
        "url",
        "score",
        "comment_count",
        "published_at",
        "activity_date",
        "fetched_at",
        F.explode(text.mentioned_names(F.col("title"), patterns)).alias("mentioned_repo"),
    ).filter(F.col("mentioned_repo").isNotNull())


def story_dimension(stories: DataFrame, as_of: dt.datetime) -> DataFrame:
    return stories.select(
        text.surrogate_key(F.col("story_id"), params.STORY_SALT).alias("hn_story_key"),
        "story_id",
        "title",
        "author",
        "url",
        "url_domain",
        "has_url",
        "score",
        "comment_count",
        "story_type",
        "published_at",
        "activity_date",
        "fetched_at",
        times.moment(as_of).alias("created_at"),
    )


def _engagement() -> list:
    score, comments = F.col("score"), F.col("comment_count")
    return [
        F.coalesce(F.sum(score), F.lit(0)).alias("total_score"),
        F.coalesce(numeric.mean(score), F.lit(0.0)).alias("avg_score"),
        F.coalesce(F.sum(comments), F.lit(0)).alias("total_comments"),
        F.coalesce(numeric.mean(comments), F.lit(0.0)).alias("avg_comments"),
        F.coalesce(F.max(score), F.lit(0)).alias("top_score"),
    ]


def story_facts(stories: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per day of publication."""
    daily = stories.filter(F.col("activity_date").isNotNull()).groupBy("activity_date").agg(
        F.count(F.lit(1)).alias("story_count"),
        *_engagement(),
        F.countDistinct("author").alias("unique_authors"),
        F.count_if("has_url").alias("with_url"),
    )
    return daily.select(
        "activity_date", "story_count", "total_score", "avg_score", "total_comments", "avg_comments",
        "unique_authors", "top_score",
        numeric.percent(F.col("with_url"), F.col("story_count")).alias("stories_with_url_pct"),
        times.moment(as_of).alias("created_at"),
    )


def mention_facts(found: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per repository and day of publication."""
    return (
        found.filter(F.col("activity_date").isNotNull())
        .groupBy("mentioned_repo", "activity_date")
        .agg(F.count(F.lit(1)).alias("mention_count"), *_engagement())
        .withColumn("created_at", times.moment(as_of))
    )
