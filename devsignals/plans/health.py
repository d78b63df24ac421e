"""Reports on the data itself: row counts, freshness, coverage."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from devsignals import params
from devsignals.functions import times
from devsignals.plans.catalog import CODE_GOLD, STORY_GOLD, Catalog


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _statistics(catalog: Catalog, names: tuple[str, ...]) -> DataFrame:
    return _stack([
        catalog[name].agg(F.count(F.lit(1)).alias("row_count"), F.max("created_at").alias("last_updated"))
        .select(F.lit(name).alias("table_name"), "row_count", "last_updated")
        for name in names
    ])


def gold_table_stats(catalog: Catalog) -> DataFrame:
    return _statistics(catalog, CODE_GOLD).orderBy("table_name")


def hn_gold_table_stats(catalog: Catalog) -> DataFrame:
    return _statistics(catalog, STORY_GOLD).orderBy("table_name")


def data_freshness(catalog: Catalog) -> DataFrame:
    return (
        _statistics(catalog, CODE_GOLD)
        .select("table_name", "last_updated")
        .orderBy(F.desc_nulls_first("last_updated"), "table_name")
    )


def _lifecycle(raw: DataFrame, facts: DataFrame, catalog: Catalog, names: tuple[str, ...]) -> DataFrame:
    """Three one-row readings, put under each other and folded into one row."""
    ntz, date = "timestamp_ntz", "date"
    none = F.lit(None)
    ingested = raw.agg(F.max("fetched_at").alias("last_ingested")).select(
        "last_ingested", none.cast(date).alias("coverage"), none.cast(ntz).alias("gold_built_at"))
    covered = facts.agg(F.max("activity_date").alias("coverage")).select(
        none.cast(ntz).alias("last_ingested"), "coverage", none.cast(ntz).alias("gold_built_at"))
    built = _stack([catalog[n].agg(F.max("created_at").alias("gold_built_at")) for n in names]).select(
        none.cast(ntz).alias("last_ingested"), none.cast(date).alias("coverage"), "gold_built_at")
    return _stack([ingested, covered, built]).agg(
        F.max("last_ingested").alias("last_ingested"),
        F.coalesce(F.max("coverage").cast("string"), F.lit(params.UNKNOWN_TEXT)).alias("data_coverage_date"),
        F.max("gold_built_at").alias("gold_built_at"),
    )


def github_lifecycle(catalog: Catalog) -> DataFrame:
    return _lifecycle(catalog["stg_github_events"], catalog["fct_github_daily_activity"], catalog, CODE_GOLD)


def hn_lifecycle(catalog: Catalog) -> DataFrame:
    return _lifecycle(catalog["stg_hn_stories"], catalog["fct_hn_daily_activity"], catalog, STORY_GOLD)


def freshness_summary(catalog: Catalog) -> DataFrame:
    refreshed = _stack([
        catalog[n].agg(F.max("created_at").alias("gold_refresh_time")) for n in CODE_GOLD
    ]).select("gold_refresh_time", F.lit(None).cast("date").alias("coverage"))
    covered = catalog["dim_repository"].agg(F.max("last_active_date").alias("coverage")).select(
        F.lit(None).cast("timestamp_ntz").alias("gold_refresh_time"), "coverage")
    return refreshed.unionByName(covered).agg(
        F.max("gold_refresh_time").alias("gold_refresh_time"),
        F.coalesce(F.max("coverage").cast("string"), F.lit(params.UNKNOWN_TEXT)).alias("data_coverage_date"),
    )


def data_coverage(repositories: DataFrame) -> DataFrame:
    return repositories.select(
        "repo_name", "first_active_date", "last_active_date",
        F.datediff("last_active_date", "first_active_date").alias("days_covered"),
    ).orderBy("repo_name")


def hn_data_coverage(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.min("activity_date").alias("first_active_date"), F.max("activity_date").alias("last_active_date")
    ).select(
        F.lit(params.STORY_SOURCE_LABEL).alias("source_name"), "first_active_date", "last_active_date",
        F.datediff("last_active_date", "first_active_date").alias("days_covered"),
    )


def last_ingestion_date(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.coalesce(F.max("activity_date").cast("string"), F.lit(params.UNKNOWN_TEXT)).alias("last_ingestion_date")
    )


def contributor_count(contributors: DataFrame) -> DataFrame:
    return contributors.agg(F.count(F.lit(1)).alias("contributor_count"))


def gold_table_health(catalog: Catalog, as_of: dt.datetime) -> DataFrame:
    return _statistics(catalog, CODE_GOLD + STORY_GOLD).select(
        "table_name",
        "row_count",
        times.hours_between(F.col("last_updated"), times.moment(as_of)).alias("age_hours"),
        F.when(F.col("row_count") > 0, "Healthy").otherwise("Empty").alias("status"),
    ).orderBy("table_name")


def warehouse_totals(catalog: Catalog) -> DataFrame:
    return _statistics(catalog, CODE_GOLD + STORY_GOLD).agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.sum("row_count").alias("total_rows"),
        F.max(F.when(F.col("table_name") == "dim_contributor", F.col("row_count"))).alias("contributors"),
    )


def freshness_badge(catalog: Catalog, as_of: dt.datetime) -> DataFrame:
    """Per source: age of the last ingestion, as number, text and label."""
    now = times.moment(as_of)
    last = _stack([
        catalog[view].agg(F.max("fetched_at").alias("last_ingested")).select(F.lit(source).alias("source"), "last_ingested")
        for source, view in (("github", "stg_github_events"), ("hackernews", "stg_hn_stories"))
    ])
    return last.withColumn("age_hours", times.hours_between(F.col("last_ingested"), now)).select(
        "source",
        "last_ingested",
        "age_hours",
        times.duration_text(F.col("last_ingested"), now).alias("age_text"),
        times.freshness_label(F.col("age_hours")).alias("freshness"),
    )
