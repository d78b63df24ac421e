"""Readers for landed API answers, field mapping and validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from devsignals import params, schemas
from devsignals.functions import times


def read_events_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EVENTS_RAW).parquet(path)


def read_stories_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STORIES_RAW).parquet(path)


def event_answers(lines: DataFrame, repo_name: str | None = None) -> DataFrame:
    """Text lines of API answers: value, repo_name, events. An answer is a page that names its repository, or a bare
    array of events; the latter's repository is `repo_name`, else what each event says. Events are null
    where an answer cannot be read."""
    bare = F.startswith(F.ltrim(F.col("value")), F.lit("["))
    page = F.from_json("value", schemas.EVENT_PAGE)
    return lines.select(
        "value",
        F.when(bare, F.lit(repo_name)).otherwise(page["repo_name"]).alias("repo_name"),
        F.when(bare, F.from_json("value", "array<string>")).otherwise(page["events"]).alias("events"),
    )


def event_rows(answers: DataFrame, fetched_at: dt.datetime) -> DataFrame:
    """Raw event rows of readable answers; each event stays as text, only its head is taken out."""
    events = answers.select("repo_name", F.explode("events").alias("raw_payload"))
    head = F.from_json("raw_payload", "id string, type string, repo struct<name: string>")
    return events.withColumn("head", head).select(
        F.col("head.id").alias("event_id"),
        F.coalesce("repo_name", "head.repo.name").alias("repo_name"),
        F.col("head.type").alias("event_type"),
        times.moment(fetched_at).alias("fetched_at"),
        "raw_payload",
    )


def read_event_pages(spark: SparkSession, path: str, fetched_at: dt.datetime, repo_name: str | None = None) -> DataFrame:
    """Files of API answers, one answer per line, to raw event rows. What cannot be stored is in `read_event_rejects`."""
    rows = event_rows(event_answers(spark.read.text(path), repo_name), fetched_at)
    return rows.filter(F.col("event_id").isNotNull())


def read_event_rejects(spark: SparkSession, path: str, fetched_at: dt.datetime, repo_name: str | None = None) -> DataFrame:
    """reject_reason and body of the answers that cannot be read and of events without an id."""
    answers = event_answers(spark.read.text(path), repo_name)
    unread = answers.filter(F.col("events").isNull()).select(F.lit("unreadable answer").alias("reject_reason"), F.col("value").alias("body"))
    without_id = event_rows(answers, fetched_at).filter(F.col("event_id").isNull()).select(
        F.lit("missing id").alias("reject_reason"), F.col("raw_payload").alias("body"))
    return unread.unionByName(without_id)


def read_story_items(spark: SparkSession, path: str, fetched_at: dt.datetime) -> DataFrame:
    """Files with one story item per line to raw story rows, valid or not."""
    return story_rows(spark.read.text(path), fetched_at)


def story_rows(lines: DataFrame, fetched_at: dt.datetime) -> DataFrame:
    """Map item fields. A default stands in for an absent key, never for an explicit null."""
    parsed = lines.select(
        F.from_json("value", schemas.STORY_ITEM).alias("item"),
        F.json_object_keys("value").alias("keys"),
        F.col("value").alias("raw_json"),
    )

    def field(name: str, default: Column) -> Column:
        return F.when(F.array_contains("keys", name), F.col(f"item.{name}")).otherwise(default)

    return parsed.select(
        F.col("item.id").alias("story_id"),
        field("title", F.lit("")).alias("title"),
        F.col("item.by").alias("author"),
        F.col("item.url").alias("url"),
        field("score", F.lit(0)).alias("score"),
        F.col("item.time").alias("time"),
        field("descendants", F.lit(0)).alias("descendants"),
        field("type", F.lit(params.STORY)).alias("type"),
        "raw_json",
        times.moment(fetched_at).alias("fetched_at"),
    )


REASONS = ("missing id", "missing title")


def reject_reason() -> Column:
    """Why a story row cannot be stored; NULL for a good one."""
    return (
        F.when(F.coalesce(F.col("story_id") == 0, F.lit(True)), REASONS[0])
        .when(F.coalesce(F.col("title") == "", F.lit(True)), REASONS[1])
    )


def valid_stories(rows: DataFrame) -> DataFrame:
    return rows.filter(reject_reason().isNull())


def rejected_stories(rows: DataFrame) -> DataFrame:
    """The dead-letter rows with their reason."""
    return rows.withColumn("reject_reason", reject_reason()).filter(F.col("reject_reason").isNotNull())


def first_ranked(ids: DataFrame, rank: list[Column], cap: int = params.TOP_STORY_CAP) -> DataFrame:
    """The first `cap` ids of the ranked list: what one poll fetches."""
    return ids.orderBy(*rank).limit(cap)
