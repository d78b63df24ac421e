"""The verification report on raw events, and reads of single document fields."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from devsignals import params
from devsignals.functions import numeric, text, times
from devsignals.operators.ranking import first_rows


def raw_overview(events: DataFrame) -> DataFrame:
    """Counted by repository and type first; the distinct values are then few rows."""
    pairs = events.groupBy("repo_name", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.countDistinct("repo_name").alias("repo_count"),
        F.countDistinct("event_type").alias("event_type_count"),
    )


def raw_events_by_repo(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("repo_name").agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), "repo_name")
    )


def raw_top_event_types(events: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent types with their part of all events. The total is a scalar subquery over the
    same counts, whose shuffle the run uses twice."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    total = F.coalesce(counts.agg(F.sum("event_count")).scalar(), F.lit(0))
    return (
        counts.withColumn("pct_of_total", numeric.percent(F.col("event_count"), total, 1))
        .orderBy(F.desc("event_count"), "event_type")
        .limit(k)
    )


def raw_quality_counts(events: DataFrame) -> DataFrame:
    """Null ids, null documents, ids that occur more than once: one grouping by id."""
    per_id = events.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(F.col("raw_payload").isNull()).alias("no_payload")
    )
    has_id = F.col("event_id").isNotNull()
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum(F.when(~has_id, F.col("copies"))), F.lit(0)).alias("null_event_ids"),
        F.coalesce(F.sum("no_payload"), F.lit(0)).alias("null_payloads"),
        # grouping keeps NULL ids as one group, as SQL does
        F.count_if(F.col("copies") > 1).alias("duplicate_event_ids"),
    )


def raw_freshness(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    return (
        events.agg(F.max("fetched_at").alias("last"))
        .select(F.coalesce(times.minutes_between(F.col("last"), times.moment(as_of)), F.lit(0.0)).alias("minutes_ago"))
        .withColumn("status", F.when(F.col("minutes_ago") < params.INGEST_FRESH_MINUTES, "PASS").otherwise("OLD"))
    )


def raw_latest_events(events: DataFrame, k: int = 3) -> DataFrame:
    return (
        events.orderBy(F.desc_nulls_first("fetched_at"), "event_id")
        .limit(k)
        .select("repo_name", "event_type", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched"))
    )


def raw_verdict(events: DataFrame) -> DataFrame:
    found = F.col("null_event_ids") + F.col("null_payloads") + F.col("duplicate_event_ids")
    return raw_quality_counts(events).withColumn(
        "verdict",
        F.when(F.col("total_events") == 0, "FAILED").when(found == 0, "SUCCESSFUL").otherwise("WARNINGS"),
    )


def raw_last_ingested_by_repo(events: DataFrame) -> DataFrame:
    return events.groupBy("repo_name").agg(
        F.max("fetched_at").alias("last_ingested"), F.count(F.lit(1)).alias("event_count")
    )


def raw_json_preview(events: DataFrame, k: int = 5) -> DataFrame:
    """Type, actor and repository as the documents of the first events give them."""
    fields = "type string, actor struct<login: string>, repo struct<name: string>"
    return (
        first_rows(events, "event_id", [F.asc_nulls_first("event_id")], k, descending=False)
        .withColumn("doc", F.from_json("raw_payload", fields))
        .select("event_id", F.col("doc.type").alias("event_type"), F.col("doc.actor.login").alias("username"),
                F.col("doc.repo.name").alias("repo"))
    )


def event_document_fields(events: DataFrame) -> DataFrame:
    """Leaf values with their types: number of commits named by the source, message of
    the first commit, time of creation. What cannot be read is NULL."""
    fields = "payload struct<size: string, commits: array<struct<message: string>>>, created_at string"
    doc = F.from_json("raw_payload", fields)
    return events.withColumn("doc", doc).select(
        "event_id",
        F.col("doc.payload.size").try_cast("int").alias("payload_size"),
        F.get(F.col("doc.payload.commits"), F.lit(0))["message"].alias("first_commit_message"),
        F.col("doc.created_at").try_cast("timestamp_ntz").alias("created_at"),
    )


def daily_unique_contributors(events: DataFrame) -> DataFrame:
    """Pushes, commits and distinct users per day of creation and repository."""
    fields = "actor struct<login: string>, payload struct<commits: string>, created_at string"
    pushes = events.filter(F.col("event_type") == params.PUSH).withColumn("doc", F.from_json("raw_payload", fields))
    return (
        pushes.select(
            F.to_date(F.col("doc.created_at").try_cast("timestamp_ntz")).alias("activity_date"),
            "repo_name",
            F.coalesce(F.json_array_length("doc.payload.commits"), F.lit(0)).alias("commits"),
            F.col("doc.actor.login").alias("login"),
        )
        .groupBy("activity_date", "repo_name")
        .agg(
            F.count(F.lit(1)).alias("total_push_events"),
            F.sum("commits").alias("total_commits"),
            F.countDistinct("login").alias("unique_contributors"),
        )
    )


def repository_name_check(events: DataFrame) -> DataFrame:
    """Repositories with their events and whether the name has the form owner/name."""
    name = F.col("repo_name")
    return events.groupBy("repo_name").agg(F.count(F.lit(1)).alias("event_count")).withColumn(
        "well_formed", F.coalesce(name.like("%/%") & text.is_repository_name(name), F.lit(False)))
