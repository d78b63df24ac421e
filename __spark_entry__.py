
from __future__ import annotations

import datetime as dt
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from devsignals import params  # noqa: E402
from devsignals.functions import text, times  # noqa: E402
from devsignals.operators import activity, quality, reshape  # noqa: E402
from devsignals.operators import stories as story_ops  # noqa: E402
from devsignals.plans import checks, community, contributors, health, ingest_runs, raw_report, repositories  # noqa: E402
from devsignals.plans.catalog import CODE_GOLD, STORY_GOLD, VIEWS, Catalog  # noqa: E402
from devsignals.sources import star_tables  # noqa: E402

START, END = params.RANGE_START, params.RANGE_END
REPO, USER = params.SAMPLE_REPOSITORY, params.SAMPLE_USER
AS_OF = params.AS_OF
REFRESH_SINCE = dt.date(2024, 1, 25)
MID_MONTH = dt.datetime(2024, 1, 16)

_catalogs: dict[tuple[str, str], Catalog] = {}


def catalog(spark: SparkSession, folder: str) -> Catalog:
    """One catalog per session and data folder, so that gold tables are built once."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, folder)
    if key not in _catalogs:
        _catalogs[key] = Catalog(
            spark, star_tables.raw_events(spark, folder), star_tables.raw_stories(spark, folder), AS_OF)
    return _catalogs[key]


def entry(spark: SparkSession) -> DataFrame:
    """Daily activity facts of all repositories, straight from the raw events."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    raw = star_tables.raw_events(spark, "/root/testdata/sf0.001")
    return activity.repository_facts(activity.activity_base(activity.stg_events(raw)), AS_OF)


def _on_catalog(report: Callable[[Catalog], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: report(catalog(spark, folder))


def _on(table: str, report: Callable[..., DataFrame], *args) -> Callable[[SparkSession, str], DataFrame]:
    return _on_catalog(lambda c: report(c[table], *args))


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    repo_dim, user_dim, repo_fct, user_fct = CODE_GOLD
    story_dim, story_fct, mention_fct = STORY_GOLD
    events, items = "stg_github_events", "stg_hn_stories"
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    # datasets
    for name in VIEWS + CODE_GOLD + STORY_GOLD:
        q[name] = _on(name, lambda df: df)
    q["fact_with_dimension_keys"] = _on_catalog(lambda c: activity.look_up_key(
        activity.look_up_key(c[user_fct], c[user_dim], "username", "contrib_id"), c[repo_dim], "repo_name", "repo_id")
        .select("username", "repo_name", "activity_date", "contrib_id", "repo_id"))
    q["mentions_from_silver"] = _on("int_hn_stories", story_ops.mentions)

    # repositories
    q["platform_kpis"] = _on(repo_dim, repositories.platform_kpis)
    q["daily_activity_all_repos"] = _on(repo_fct, repositories.daily_activity_all_repos, START, END)
    q["repo_comparison"] = _on(repo_dim, repositories.repo_comparison)
    q["event_distribution"] = _on(repo_fct, repositories.event_distribution, START, END)
    q["repository_list"] = _on(repo_dim, repositories.repository_list)
    q["repo_kpis"] = _on(repo_dim, repositories.repo_kpis, REPO)
    q["repo_daily_activity"] = _on(repo_fct, repositories.repo_daily_activity, REPO, START, END)
    q["repo_summary"] = _on(repo_fct, repositories.repo_summary, START, END)
    q["activity_metric_fallback"] = _on_catalog(
        lambda c: repositories.activity_metric_fallback(c[repo_dim], c[repo_fct], START, END))
    q["pr_performance_summary"] = _on(repo_fct, repositories.pr_performance_summary, REPO, START, END)
    q["repo_scorecard"] = _on(repo_dim, repositories.repo_scorecard)
    q["daily_trend_90d"] = _on(repo_fct, repositories.daily_trend, AS_OF.date(), 90)
    q["last_7_days"] = _on(repo_fct, repositories.recent_days, AS_OF.date(), 7)

    q["default_window_report"] = _on(repo_fct, repositories.daily_activity_all_repos, *times.date_window(AS_OF.date()))
    q["formatted_totals"] = _on(repo_dim, lambda df: df.select(
        "repo_name", *[text.thousands(F.col(c)).alias(c) for c in ("total_commits", "total_pr_events")]))
    q["nonzero_measures"] = _on(user_fct, lambda df: reshape.drop_empty_measures(
        df.groupBy("username").agg(F.sum("push_count").alias("push_count"), F.sum("pr_event_count").alias("pr_event_count"),
                                   F.sum(F.col("push_count") * 0).alias("empty_measure")),
        ("push_count", "pr_event_count", "empty_measure")))
    q["mentions_custom_patterns"] = _on("int_hn_stories", lambda df: story_ops.mentions(
        df, (("facebook/react", "(?:react|the|and)", None),)).select("story_id", "mentioned_repo"))

    # contributors
    ranks = "contributor_ranks"
    q["contributor_leaderboard_all"] = _on(ranks, contributors.contributor_leaderboard)
    q["contributor_leaderboard_type"] = _on(ranks, contributors.contributor_leaderboard, contributors.ALL, "both")
    q["contributor_leaderboard_repo"] = _on(ranks, contributors.contributor_leaderboard, REPO)
    q["contributor_leaderboard_repo_type"] = _on(ranks, contributors.contributor_leaderboard, REPO, "pr_only")
    q["unique_contributors_sketched"] = _on_catalog(lambda c: contributors.unique_contributors(
        c[user_fct], c["contributor_sketches"], START, END).select("repo_name", "contributors", "within_bound"))
    q["contrib_type_distribution"] = _on(user_dim, contributors.contrib_type_distribution)
    q["contrib_type_labels"] = _on(user_dim, contributors.contrib_type_labels)
    q["top_contributors_all"] = _on(user_fct, contributors.top_contributors)
    q["top_contributors_repo"] = _on(user_fct, contributors.top_contributors, REPO)
    q["contributor_list"] = _on(user_dim, contributors.contributor_list)
    q["contributor_profile"] = _on(user_dim, contributors.contributor_profile, USER)
    q["contributor_timeline"] = _on(user_fct, contributors.contributor_timeline, USER, START, END)
    q["contributor_repo_participation"] = _on(user_fct, contributors.contributor_repo_participation, USER)
    q["leaderboard_headline"] = _on(ranks, contributors.leaderboard_headline)
    q["contributor_summary"] = _on(user_fct, contributors.contributor_summary, USER, START, END)
    q["activity_matrix"] = _on(user_fct, contributors.activity_matrix, START, END)
    q["top20_by_commits"] = _on(user_dim, contributors.top_by_commits)
    q["contributor_detail"] = _on(user_fct, contributors.contributor_detail, USER)
    q["contributor_heatmap"] = _on(user_fct, contributors.contributor_heatmap)
    q["weekly_activity"] = _on(user_fct, contributors.weekly_activity)
    q["contribution_share"] = _on(user_fct, contributors.contribution_share)
    q["contribution_concentration"] = _on(user_fct, contributors.contribution_concentration)
    q["contributor_account_class"] = _on(user_dim, contributors.account_classes)
    q["commits_of_contributor"] = _on_catalog(
        lambda c: repositories.commits_of_contributor(c[user_fct], c[user_dim], USER))

    # community
    q["hn_platform_kpis"] = _on(story_dim, community.hn_platform_kpis)
    q["hn_daily_activity"] = _on(story_fct, community.hn_daily_activity, START, END)
    q["hn_trending_stories"] = _on_catalog(lambda c: community.hn_trending_stories(c[story_dim], trending=c["trending_stories"]))
    q["hn_top_authors"] = _on(story_dim, community.hn_top_authors)
    q["hn_repo_mentions_daily"] = _on(mention_fct, community.hn_repo_mentions_daily, START, END)
    q["hn_mention_summary_all"] = _on(mention_fct, community.hn_mention_summary)
    q["hn_mention_summary_range"] = _on(mention_fct, community.hn_mention_summary, START, dt.date(2024, 1, 15))
    q["hn_recent_stories"] = _on(story_dim, community.hn_recent_stories)
    q["hn_repo_stories"] = _on("int_hn_repo_mentions", community.hn_repo_stories, REPO)
    q["hn_mentions_over_time"] = _on(mention_fct, community.hn_mentions_over_time, REPO, START, END)
    q["hn_repo_period_totals"] = _on(mention_fct, community.hn_repo_period_totals, REPO, START, END)

    # health
    q["data_freshness"] = _on_catalog(health.data_freshness)
    q["gold_table_stats"] = _on_catalog(health.gold_table_stats)
    q["github_lifecycle"] = _on_catalog(health.github_lifecycle)
    q["freshness_summary"] = _on_catalog(health.freshness_summary)
    q["data_coverage"] = _on(repo_dim, health.data_coverage)
    q["last_ingestion_date"] = _on(repo_fct, health.last_ingestion_date)
    q["contributor_count"] = _on(user_dim, health.contributor_count)
    q["hn_gold_table_stats"] = _on_catalog(health.hn_gold_table_stats)
    q["hn_lifecycle"] = _on_catalog(health.hn_lifecycle)
    q["hn_data_coverage"] = _on(story_fct, health.hn_data_coverage)
    q["gold_table_health"] = _on_catalog(lambda c: health.gold_table_health(c, AS_OF + dt.timedelta(hours=30)))
    q["warehouse_totals"] = _on_catalog(health.warehouse_totals)
    q["freshness_badge"] = _on_catalog(lambda c: health.freshness_badge(c, AS_OF))

    # raw report
    q["raw_overview"] = _on(events, raw_report.raw_overview)
    q["raw_events_by_repo"] = _on(events, raw_report.raw_events_by_repo)
    q["raw_top_event_types"] = _on(events, raw_report.raw_top_event_types)
    q["raw_quality_counts"] = _on(events, raw_report.raw_quality_counts)
    q["raw_freshness"] = _on(events, raw_report.raw_freshness, AS_OF)
    q["raw_latest_events"] = _on(events, raw_report.raw_latest_events)
    q["raw_verdict"] = _on(events, raw_report.raw_verdict)
    q["raw_last_ingested_by_repo"] = _on(events, raw_report.raw_last_ingested_by_repo)
    q["raw_json_preview"] = _on(events, raw_report.raw_json_preview)
    q["event_document_fields"] = _on(events, raw_report.event_document_fields)
    q["daily_unique_contributors"] = _on(events, raw_report.daily_unique_contributors)
    q["repository_name_check"] = _on(events, raw_report.repository_name_check)

    # data quality
    for kind in ("not_null", "unique", "accepted_values", "relationships"):
        q[f"dq_{kind}"] = _on_catalog(lambda c, k=kind: checks.report(c, checks.of_kind(k)))
    q["dq_report"] = _on_catalog(checks.report)
    pushes, requests = "int_push_events", "int_pull_requests"
    q["dq_no_future_timestamps"] = _on_catalog(
        lambda c: quality.no_future_timestamps(c[pushes], c[requests], AS_OF))
    q["dq_no_negative_commit_count"] = _on(pushes, quality.no_negative_commit_count)
    q["dq_push_model_integrity"] = _on_catalog(lambda c: quality.push_model_integrity(c[pushes], c[events]))
    # the same rules where they find something: an earlier "now", counts lowered by
    # three, all events taken for pushes
    q["dq_no_future_timestamps_found"] = _on_catalog(
        lambda c: quality.no_future_timestamps(c[pushes], c[requests], MID_MONTH))
    q["dq_no_negative_commit_count_found"] = _on(
        pushes, lambda df: quality.no_negative_commit_count(df.withColumn("commit_count", F.col("commit_count") - 3)))
    q["dq_push_model_integrity_found"] = _on(events, lambda df: quality.push_model_integrity(df, df))
    for kind in ("unique", "accepted_values", "relationships"):
        q[f"dq_{kind}_found"] = _on_catalog(lambda c, k=kind: ingest_runs.checks_on_defects(c, k))
    q["dq_source_freshness"] = _on_catalog(lambda c: quality.source_freshness(
        {"github_events_raw": c[events], "hn_stories_raw": c[items]}, AS_OF))

    # ingestion, streams, refresh
    raw_e, raw_s = (lambda c: c.raw_events), (lambda c: c.raw_stories)
    q["landed_event_pages"] = _on_catalog(lambda c: ingest_runs.landed_event_pages(raw_e(c), AS_OF))
    q["landed_mixed_answers"] = _on_catalog(lambda c: ingest_runs.mixed_answers(raw_e(c), AS_OF, False))
    q["ingest_event_rejects"] = _on_catalog(lambda c: ingest_runs.mixed_answers(raw_e(c), AS_OF, True))
    q["ingest_story_defaults"] = _on_catalog(lambda c: ingest_runs.valid_story_items(raw_s(c), AS_OF))
    q["ingest_rejects"] = _on_catalog(lambda c: ingest_runs.rejected_story_items(raw_s(c), AS_OF))
    q["ranked_story_cap"] = _on_catalog(lambda c: ingest_runs.ranked_story_cap(raw_s(c)))
    q["ingest_insert_if_absent"] = _on_catalog(lambda c: ingest_runs.insert_runs(raw_e(c)))
    q["ingest_load_stats"] = _on_catalog(lambda c: ingest_runs.insert_statistics(raw_e(c)))
    q["ingest_load_stats_by_repository"] = _on_catalog(lambda c: ingest_runs.insert_statistics_by_repository(raw_e(c)))
    q["ingest_story_load_stats"] = _on_catalog(lambda c: ingest_runs.story_load_statistics(raw_s(c)))
    q["ingest_upsert_folded"] = _on_catalog(lambda c: ingest_runs.upsert_with_folds(raw_s(c)))
    q["ingest_upsert_stories"] = _on_catalog(lambda c: ingest_runs.upsert_runs(raw_s(c)))
    q["ingest_upsert_compacted"] = _on_catalog(lambda c: ingest_runs.upsert_after_compaction(raw_s(c)))
    q["ingest_upsert_stats"] = _on_catalog(lambda c: ingest_runs.upsert_statistics(raw_s(c)))
    q["stream_events_first_wins"] = _on_catalog(lambda c: ingest_runs.stream_first_wins(raw_e(c)))
    q["stream_events_within_watermark"] = _on_catalog(lambda c: ingest_runs.stream_within_watermark(raw_e(c)))
    q["stream_load_stats"] = _on_catalog(lambda c: ingest_runs.stream_load_statistics(raw_e(c)))
    q["stream_late_rows"] = _on_catalog(lambda c: ingest_runs.stream_late_rows(raw_e(c)))
    q["stream_stories_upsert"] = _on_catalog(lambda c: ingest_runs.stream_upsert(raw_s(c)))
    q["stream_daily_counts"] = _on_catalog(lambda c: ingest_runs.stream_daily_counts(raw_e(c)))
    q["incremental_fact_refresh"] = _on_catalog(lambda c: ingest_runs.refresh_run(c, REFRESH_SINCE))
    q["incremental_contributor_refresh"] = _on_catalog(
        lambda c: ingest_runs.refresh_run(c, REFRESH_SINCE, "fct_contributor_daily_activity"))
    q["incremental_dimension_refresh"] = _on_catalog(lambda c: ingest_runs.refresh_run(c, REFRESH_SINCE, "dim_contributor"))
    q["packed_fact_days"] = _on_catalog(lambda c: ingest_runs.packed_run(c, REFRESH_SINCE, "fct_contributor_daily_activity"))
    q["repository_history"] = _on_catalog(lambda c: ingest_runs.repository_history(c, MID_MONTH, AS_OF))
    q["repository_history_stored"] = _on_catalog(lambda c: ingest_runs.repository_history(c, MID_MONTH, AS_OF, stored=True))
    q["published_repository_facts"] = _on_catalog(ingest_runs.published_facts)
    q["quarantined_events"] = _on_catalog(lambda c: ingest_runs.quarantined(c, "quarantined_events", "event_id"))
    q["quarantined_stories"] = _on_catalog(lambda c: ingest_runs.quarantined(c, "quarantined_stories", "story_id"))
    q["publish_refused"] = _on_catalog(ingest_runs.publish_refused)
    q["namespace_tables"] = _on_catalog(ingest_runs.namespaces)
    q["published_report"] = _on_catalog(ingest_runs.report_of_published)
    q["csv_export"] = _on_catalog(ingest_runs.csv_export)
    q["sql_over_views"] = _on_catalog(ingest_runs.sql_over_views)
    return q


def _has_llm() -> bool:
    return bool(importlib.util.find_spec("devsignals.llm") and importlib.util.find_spec("corpus_pipeline"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = core_queries()
    if _has_llm():
        import corpus_pipeline
        from devsignals.llm import queries as llm

        q |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return q


def core_sql() -> dict[str, str]:
    from oracle import statements

    return statements()


def oracle_sql() -> dict[str, str]:
    sql = core_sql()
    if _has_llm():
        import corpus_pipeline
        from devsignals.llm import queries as llm

        sql |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
