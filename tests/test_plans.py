"""Properties of plans that matter at scale, and results under heavy skew."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from devsignals import params
from devsignals.operators import activity, quality, sketches, stories
from devsignals.operators.ranking import first_rows
from devsignals.plans import checks, community, contributors, ingest_runs, publish, raw_report, repositories
from devsignals.plans.catalog import Catalog
from devsignals.session import fresh_path, settings_for, shared_folder
from devsignals.sources import landing, sinks, star_tables
from devsignals.sources.keyed import KeyedTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events_table(spark, data):
    path = fresh_path(spark, "raw-events")
    star_tables.raw_events(spark, data).write.parquet(path)
    return activity.stg_events(landing.read_events_table(spark, path))


@pytest.fixture(scope="module")
def catalog(spark, data):
    return entry.catalog(spark, data)


def test_type_filter_reaches_the_scan(events_table):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,PushEvent)]" in plan_of(activity.push_events(events_table))
    assert "In(event_type, [PullRequestEvent,PushEvent])" in plan_of(activity.activity_base(events_table))


def test_counts_take_one_scan_and_one_shuffle(events_table):
    plan = plan_of(activity.activity_base(events_table))
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1 and "partial_" in plan


def test_bronze_and_silver_are_checked_in_one_pass(catalog, events_table):
    source = quality.Source(activity.FROM_EVENTS, activity.with_silver(events_table))
    own = [(n, c) for n, c in enumerate(checks.declared()) if c.table in activity.FROM_EVENTS]
    columns = plan_of(quality.column_faults(source, [(n, c) for n, c in own if c.kind in ("not_null", "accepted_values")]))
    assert columns.count("FileScan") == 1 and columns.count("Exchange ") == 1 and columns.count("from_json") == 1
    keys = plan_of(quality.repeated_keys(source, [(n, c) for n, c in own if c.kind == "unique"]))
    assert keys.count("FileScan") == 1 and keys.count("Exchange ") == 1
    assert "raw_payload" not in keys and "partial_count_if" in keys.replace("partial_count(", "partial_count_if(")


def test_mentions_of_one_repository_read_one_folder(catalog):
    df = catalog["int_hn_repo_mentions"].filter(F.col("mentioned_repo") == params.SAMPLE_REPOSITORY)
    assert "PartitionFilters: [isnotnull(mentioned_repo" in plan_of(df)


def test_no_job_runs_while_a_report_is_planned(spark, catalog, events_table):
    facts, people = catalog["fct_github_daily_activity"], catalog["dim_repository"]
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        raw_report.raw_top_event_types(events_table)
        repositories.activity_metric_fallback(people, facts, params.RANGE_START, params.RANGE_END)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_pushes_stand_in_where_no_commit_is_known(catalog):
    facts = catalog["fct_github_daily_activity"]
    people = catalog["dim_repository"].withColumn("total_commits", F.lit(0).cast("bigint"))
    rows = repositories.activity_metric_fallback(people, facts, params.RANGE_START, params.RANGE_END)
    pushes = repositories.daily_activity_all_repos(facts, params.RANGE_START, params.RANGE_END)
    assert {(r.activity_date, r.metric_name, r.metric_value) for r in rows.collect()} == {
        (r.activity_date, "push_count", r.push_count) for r in pushes.collect()}


def test_unused_columns_are_not_read(events_table):
    assert "ReadSchema: struct<repo_name:string>" in plan_of(raw_report.raw_events_by_repo(events_table))
    assert "ReadSchema: struct<repo_name:string,event_type:string>" in plan_of(raw_report.raw_overview(events_table))


def test_date_range_prunes_folders(catalog):
    facts = catalog["fct_contributor_daily_activity"]
    day = dt.date(2024, 1, 5)
    df = contributors.contributor_timeline(facts, "user_8", day, day)
    df.collect()
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(activity_date" in plan and "EqualTo(username,user_8)" in plan
    assert len(repositories.daily_activity_all_repos(catalog["fct_github_daily_activity"], day, day).inputFiles()) > 0


def test_refresh_reads_recent_events_only(events_table):
    since = F.lit(dt.date(2024, 1, 25)).cast("timestamp_ntz")
    plan = plan_of(activity.activity_base(events_table.filter(F.col("fetched_at") >= since)))
    assert "GreaterThanOrEqual(fetched_at,2024-01-25T00:00)" in plan


def test_mentions_need_no_join(catalog):
    plan = plan_of(stories.mentions(catalog.silver_of_gold()))
    assert "Join" not in plan and "Exchange" not in plan


def test_large_target_is_not_shuffled(spark, events_table):
    """A small batch is broadcast to the key scan of the target."""
    path = fresh_path(spark, "batch")
    events_table.limit(5).write.parquet(path)
    batch = landing.read_events_table(spark, path)
    df = sinks.present_keys(events_table, batch, "event_id")
    assert "BroadcastHashJoin" in plan_of(df) and "ReadSchema: struct<event_id:string>" in plan_of(df)


def test_grouping_combines_before_the_shuffle(catalog):
    for report in (contributors.weekly_activity, contributors.contributor_heatmap, contributors.top_contributors):
        assert "partial_sum" in plan_of(report(catalog["fct_contributor_daily_activity"]))


# --- skew: one user, one repository and one day hold most rows ------------------

def skewed_events(spark, n=30000):
    hot = F.col("id") % 3 == 0
    body = F.concat(F.lit('{"actor":{"login":"'), F.when(hot, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 997)),
                    F.lit('"},"payload":{"commits":[{}]}}'))
    return spark.range(n).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 5 != 0, "facebook/react").otherwise(F.concat(F.lit("x/r"), F.col("id") % 101)).alias("repo_name"),
        F.lit(params.PUSH).alias("event_type"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("fetched_at"),
        body.alias("raw_payload"),
    )


def test_skewed_counts(spark):
    base = activity.activity_base(activity.stg_events(skewed_events(spark)))
    users = activity.contributor_facts(base, params.AS_OF)
    assert users.agg(F.sum("push_count")).first()[0] == 30000
    assert contributors.top_contributors(users, top_n=1).first().username == "hot"
    share = contributors.contribution_share(users)
    assert share.agg(F.sum("commits")).first()[0] == 30000


def test_copies_of_one_event_are_cut_before_the_shuffle(spark):
    copies = skewed_events(spark).withColumn("event_id", F.when(F.col("event_id") % 3 == 0, "0").otherwise(F.col("event_id")))
    path = fresh_path(spark, "skew")
    KeyedTable(spark, path).insert(copies)
    stored = KeyedTable(spark, path).read()
    assert stored.count() == stored.select("event_id").distinct().count() == 20001
    assert plan_of(sinks.first_per_key(copies, "event_id", ["fetched_at"])).count("WindowGroupLimit") == 2


def test_copies_are_not_paired_with_each_other(spark):
    copies = spark.range(20000).select(F.lit("1").alias("event_id"), F.lit("a/b").alias("repo_name"),
                                       F.lit("IssuesEvent").alias("event_type"))
    assert quality.push_model_integrity(copies, copies).count() == 20000


def test_event_pages_stay_small(spark, data):
    pages = star_tables.event_pages(star_tables.raw_events(spark, data)).collect()
    sizes = [len(json.loads(p.value)["events"]) for p in pages]
    assert max(sizes) <= star_tables.PAGE_SIZE and sum(sizes) == star_tables.raw_events(spark, data).count()


def test_settings_grow_with_the_input():
    assert settings_for(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert int(settings_for(100 * 10**12)["spark.sql.shuffle.partitions"]) > 50_000


def test_refresh_reads_the_replaced_days_only(spark, data):
    """All fact files of other days are made unreadable first."""
    since = dt.date(2024, 1, 25)
    own = entry.catalog(spark, data)
    root = ingest_runs.early_build(own, since)
    path = root.removeprefix("file:")
    spoiled = 0
    for file in glob.glob(f"{path}/fct_*/activity_date=*/*.parquet"):
        if file.split("activity_date=")[1][:10] < str(since):
            with open(file, "r+b") as f:          # the pages; the footer stays, as the schema is read from one of them
                body = f.read()
                f.seek(4)
                f.write(b"\xff" * (len(body) - 12 - int.from_bytes(body[-8:-4], "little")))
            spoiled += 1
            os.path.exists(crc := f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc") and os.remove(crc)
    assert spoiled > 10
    with pytest.raises(Exception):
        Catalog.open(spark, root, own.as_of)["fct_contributor_daily_activity"].agg(F.max("username")).collect()
    publish.refresh_recent_days(own["stg_github_events"], root, since, own.as_of, own.repositories)
    now = Catalog.open(spark, root, own.as_of)
    for name in ("dim_contributor", "dim_repository", "contributor_ranks"):
        want = own[name]
        assert sorted(map(repr, now[name].select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_a_leaderboard_writes_nothing(spark, catalog):
    ranks = catalog["contributor_ranks"]
    written = lambda: set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/devsignals/*/*"))
    before = written()
    df = contributors.contributor_leaderboard(ranks, params.SAMPLE_REPOSITORY, "both")
    assert [r["rank"] for r in df.collect()] == list(range(1, df.count() + 1))
    assert written() == before
    assert "PartitionFilters: [isnotnull(scope" in plan_of(df) and "Window" not in plan_of(df)


def test_sketches_merge_over_any_range(spark):
    rows = spark.range(200_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("activity_date"), F.lit("a/b").alias("repo_name"),
        F.concat(F.lit("u"), F.hash("id") % 40_000).alias("username"))
    stored = sketches.daily_sketches(rows, ["repo_name", "activity_date"], "username")
    for first, last in ((1, 20), (3, 9), (7, 7)):
        start, end = dt.date(2024, 1, first), dt.date(2024, 1, last)
        row = contributors.unique_contributors(rows, stored, start, end).first()
        assert row.contributors > 1000 and row.within_bound
        assert abs(row.estimate / row.contributors - 1) < sketches.ERROR_BOUND
    assert max(r.n for r in stored.select(F.octet_length("sketch").alias("n")).collect()) < 1 << 14


def scanned_rows(df):
    """Rows that the scans of a collected frame gave out."""
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_first_rows_skip_row_groups(spark):
    """In a table clustered by the column only the last row groups give out wide rows, and no job runs while planning."""
    path = fresh_path(spark, "clustered")
    rows = spark.range(200_000).select(F.col("id").alias("published_at"), F.repeat(F.lit("wide"), 50).alias("wide"))
    rows.repartitionByRange(8, "published_at").sortWithinPartitions("published_at").write.parquet(path)
    table = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        df = first_rows(table, "published_at", [F.desc("published_at")], 10)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert [r.published_at for r in df.collect()] == list(range(199_999, 199_989, -1))
    (wide,) = scanned_rows(df)
    assert wide <= 30_000


def test_trending_reads_the_stored_rows(catalog):
    report = lambda held: community.hn_trending_stories(catalog["dim_hn_story"], 5, catalog["trending_stories"], held)
    few, all_rows = report(1000), report(4)
    assert {f.split("/")[-2] for f in few.inputFiles()} == {"trending_stories"}
    assert {f.split("/")[-2] for f in all_rows.inputFiles()} == {"dim_hn_story"} and few.collect() == all_rows.collect()


def test_packed_days_are_few_files_and_still_pruned(spark, data):
    own = entry.catalog(spark, data)
    root = ingest_runs.early_build(own, dt.date(2024, 1, 25))
    name = "fct_contributor_daily_activity"
    files = lambda: len(glob.glob(f"{root.removeprefix('file:')}/{name}*/**/*.parquet", recursive=True))
    before, rows = files(), sorted(map(repr, Catalog.open(spark, root, own.as_of)[name].select(*own[name].columns).collect()))
    publish.pack_old_days(spark, root, dt.date(2024, 1, 20))
    publish.pack_old_days(spark, root, dt.date(2024, 1, 10))            # nothing: these days are packed
    table = Catalog.open(spark, root, own.as_of)[name]
    assert sorted(map(repr, table.select(*own[name].columns).collect())) == rows and files() < before / 2
    one = table.filter(F.col("activity_date") == dt.date(2024, 1, 5))
    assert "EqualTo(activity_date,2024-01-05)" in plan_of(one) and one.count() > 0
    with pytest.raises(ValueError, match="packed"):
        publish.refresh_recent_days(own["stg_github_events"], root, dt.date(2024, 1, 15), own.as_of, own.repositories)
    # a pointer that is not there yet: the folders count
    half = ingest_runs.early_build(own, dt.date(2024, 1, 25))
    table.limit(1).write.parquet(f"{half}/{name}-packed/upto=2024-01-20")
    assert sorted(map(repr, Catalog.open(spark, half, own.as_of)[name].select(*own[name].columns).collect())) == rows
