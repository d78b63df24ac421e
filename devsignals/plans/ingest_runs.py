"""Ingestion end to end on two overlapping polls of a source, in batch and as streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from devsignals import params, schemas
from devsignals.operators import activity, history
from devsignals.plans import publish
from devsignals.plans.catalog import CODE_GOLD, Catalog, repository_metadata
from devsignals.operators.quality import QualityError
from devsignals.operators.quality import run as run_checks
from devsignals.plans.checks import CheckedTables, gold_checks, of_kind
from devsignals.plans.checks import report as declared_report
from devsignals.session import fresh_path, written
from devsignals.sources import landing, sinks, star_tables
from devsignals.sources.keyed import KeyedTable, read_loads, record_load
from devsignals.streaming import events as event_streams
from devsignals.streaming import stories as story_streams


# --- landed files -----------------------------------------------------------

def landed_event_pages(raw_events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Land API answers as files and read the events back out of them."""
    spark = raw_events.sparkSession
    path = fresh_path(spark, "event-pages")
    star_tables.event_pages(raw_events).write.text(path)
    return landing.read_event_pages(spark, path, as_of)


def mixed_answers(raw_events: DataFrame, as_of: dt.datetime, rejects: bool) -> DataFrame:
    """Pages and bare arrays, some of them broken: the events read, or what could not be stored."""
    spark = raw_events.sparkSession
    path = fresh_path(spark, "mixed-answers")
    star_tables.mixed_answers(raw_events).write.text(path)
    if rejects:
        return landing.read_event_rejects(spark, path, as_of)
    return landing.read_event_pages(spark, path, as_of).drop("raw_payload")


def landed_story_items(raw_stories: DataFrame, as_of: dt.datetime) -> DataFrame:
    spark = raw_stories.sparkSession
    path = fresh_path(spark, "story-items")
    star_tables.story_items(raw_stories).write.text(path)
    return landing.read_story_items(spark, path, as_of)


def valid_story_items(raw_stories: DataFrame, as_of: dt.datetime) -> DataFrame:
    return landing.valid_stories(landed_story_items(raw_stories, as_of)).drop("raw_json")


def rejected_story_items(raw_stories: DataFrame, as_of: dt.datetime) -> DataFrame:
    return landing.rejected_stories(landed_story_items(raw_stories, as_of)).select("story_id", "title", "reject_reason")


def ranked_story_cap(raw_stories: DataFrame, cap: int = params.TOP_STORY_CAP) -> DataFrame:
    rank = [F.desc_nulls_last("score"), F.asc("story_id")]
    return landing.first_ranked(raw_stories.select("story_id", "score"), rank, cap)


# --- insert if absent -------------------------------------------------------

def _landed(polls: Iterable[DataFrame]) -> list[DataFrame]:
    """Each poll as the files it would arrive in; a load reads them more than once."""
    return [written(poll, "poll") for poll in polls]


def insert_runs(raw_events: DataFrame) -> DataFrame:
    """First poll, second poll, second poll once more: what is stored in the end, after small files were merged."""
    spark = raw_events.sparkSession
    first, second = _landed(star_tables.event_polls(raw_events))
    table = KeyedTable(spark, fresh_path(spark, "events"))
    for poll in (first, second, second):
        table.insert(poll)
    table.merge_files(1)
    return table.read()


def _recorded_loads(polls: Iterable[DataFrame]) -> DataFrame:
    """What the loads of the polls, the last one twice, have counted themselves."""
    landed = _landed(polls)
    spark = landed[0].sparkSession
    path = fresh_path(spark, "events")
    table = KeyedTable(spark, path)
    for number, poll in enumerate([*landed, landed[-1]], start=1):
        record_load(spark, path, number, table.insert(poll, params.REPOSITORY_NAMES))
    return read_loads(spark, path).withColumn("load", F.col("load").cast("int"))


def insert_statistics(raw_events: DataFrame) -> DataFrame:
    """Received, inserted and duplicate rows of the three loads."""
    return _recorded_loads(star_tables.event_polls(raw_events)).where("repo_name is null").drop("repo_name")


def insert_statistics_by_repository(raw_events: DataFrame) -> DataFrame:
    """The same per repository; some events of the polls have lost their id."""
    lost = F.when(F.col("event_id").cast("long") % 97 != 0, F.col("event_id"))
    polls = [poll.withColumn("event_id", lost) for poll in star_tables.event_polls(raw_events)]
    return _recorded_loads(polls).where("repo_name is not null")


# --- upsert -----------------------------------------------------------------

STORY_REPORT = ("story_id", "title", "author", "url", "score", "time", "descendants", "type", "fetched_at")


def _reported(changes: DataFrame) -> DataFrame:
    """The state of a change log. The raw score is taken out of the document before changes are moved."""
    scored = changes.withColumn("raw_score", F.get_json_object("raw_json", "$.score"))
    mutable = [c for c in sinks.STORY_MUTABLE if c != "raw_json"]
    return sinks.current_state(scored, mutable=(*mutable, "raw_score")).select(*STORY_REPORT, "raw_score")


def upsert_runs(raw_stories: DataFrame) -> DataFrame:
    spark = raw_stories.sparkSession
    first, second = star_tables.story_polls(raw_stories)
    path = fresh_path(spark, "stories")
    for seq, poll in enumerate((first, second, second)):
        sinks.store_stories(poll, path, seq)
    return _reported(sinks.read_changes(spark, path, schemas.STORIES_RAW))


def upsert_after_compaction(raw_stories: DataFrame) -> DataFrame:
    """The same state when the log was folded between the polls."""
    spark = raw_stories.sparkSession
    first, second = star_tables.story_polls(raw_stories)
    old, new = fresh_path(spark, "stories"), fresh_path(spark, "stories-compacted")
    sinks.store_stories(first, old, 0)
    sinks.compact(spark, old, new, schemas.STORIES_RAW)
    sinks.store_stories(second, new, 1)
    return _reported(sinks.read_changes(spark, new, schemas.STORIES_RAW))


def upsert_statistics(raw_stories: DataFrame) -> DataFrame:
    first, second = star_tables.story_polls(raw_stories)
    none = first.filter(F.lit(False))
    return (
        sinks.upsert_statistics(first, none).withColumn("load", F.lit(1))
        .unionByName(sinks.upsert_statistics(second, first).withColumn("load", F.lit(2)))
    )


def story_load_statistics(raw_stories: DataFrame) -> DataFrame:
    """Rows that each poll brought, stored, and rejected, as its write has counted them. Some stories have lost id or title."""
    spark = raw_stories.sparkSession
    path = fresh_path(spark, "stories")
    for seq, poll in enumerate(star_tables.story_polls(raw_stories)):
        n = F.col("story_id")
        broken = poll.withColumns({"title": F.when(n % 31 == 3, "").otherwise(F.col("title")), "story_id": F.when(n % 29 != 1, n)})
        sinks.store_stories(written(broken, "poll"), path, seq)
    return sinks.read_story_loads(spark, path)


def upsert_with_folds(raw_stories: DataFrame) -> DataFrame:
    """The state when the log is folded behind the first poll and the second one arrives twice, on top of the base."""
    spark = raw_stories.sparkSession
    path = fresh_path(spark, "stories")
    first, second = star_tables.story_polls(raw_stories)
    for seq, poll in enumerate((first, second, second)):
        sinks.store_stories(poll, path, seq, fold_every=1 if seq < 2 else None)
    return _reported(sinks.read_changes(spark, path, schemas.STORIES_RAW))


# --- streams ----------------------------------------------------------------

def stream_first_wins(raw_events: DataFrame) -> DataFrame:
    """Both polls land one after the other, and the second lands again."""
    spark = raw_events.sparkSession
    root = fresh_path(spark, "event-stream")
    first, second = star_tables.event_polls(raw_events)
    for poll in (first, second, second):
        poll.write.mode("append").parquet(f"{root}/landing")
        stream = event_streams.read_event_stream(spark, f"{root}/landing")
        event_streams.store_first(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return KeyedTable(spark, f"{root}/table").read().drop("raw_payload")


def stream_load_statistics(raw_events: DataFrame) -> DataFrame:
    """Both polls as micro-batches of a few files: what all of them received and inserted per repository."""
    spark = raw_events.sparkSession
    root = fresh_path(spark, "counted-stream")
    for poll in star_tables.event_polls(raw_events):
        poll.write.mode("append").parquet(f"{root}/landing")
        stream = event_streams.read_event_stream(spark, f"{root}/landing", max_files=4)
        event_streams.store_first(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return read_loads(spark, f"{root}/table").where("repo_name is not null").groupBy("repo_name").agg(
        *[F.sum(c).alias(c) for c in ("received", "inserted", "duplicates", "errors")])


def stream_late_rows(raw_events: DataFrame, delay: dt.timedelta = dt.timedelta(days=5)) -> DataFrame:
    """Both polls through a watermark: per day the events in time and those behind it. Together they are all that landed."""
    spark = raw_events.sparkSession
    root = fresh_path(spark, "late-stream")
    for poll in star_tables.event_polls(raw_events):
        poll.write.mode("append").parquet(f"{root}/landing")
        stream = event_streams.read_event_stream(spark, f"{root}/landing")
        event_streams.split_late(stream, root, f"{root}/checkpoint", delay).awaitTermination()
    both = event_streams.read_split(spark, root, False).withColumn("late", F.lit(False)).unionByName(
        event_streams.read_split(spark, root, True).withColumn("late", F.lit(True)))
    return both.groupBy(F.to_date("fetched_at").alias("activity_date"), "late").agg(F.count(F.lit(1)).alias("event_count"))


def stream_within_watermark(raw_events: DataFrame, delay: str = "30 days") -> DataFrame:
    """The same landing through the form with bounded state; which events are kept."""
    spark = raw_events.sparkSession
    root = fresh_path(spark, "bounded-stream")
    for poll in star_tables.event_polls(raw_events):
        poll.write.mode("append").parquet(f"{root}/landing")
        kept = event_streams.first_within(event_streams.read_event_stream(spark, f"{root}/landing"), delay)
        event_streams.append_to(kept, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{root}/table").select("event_id", "repo_name", "event_type")


def stream_upsert(raw_stories: DataFrame) -> DataFrame:
    spark = raw_stories.sparkSession
    root = fresh_path(spark, "story-stream")
    for poll in star_tables.story_polls(raw_stories):
        poll.write.mode("append").option("compression", "zstd").parquet(f"{root}/landing")
        stream = story_streams.read_story_stream(spark, f"{root}/landing")
        story_streams.upsert(stream, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return _reported(sinks.read_changes(spark, f"{root}/log", schemas.STORIES_RAW))


def stream_daily_counts(raw_events: DataFrame) -> DataFrame:
    spark = raw_events.sparkSession
    root = fresh_path(spark, "daily-stream")
    raw_events.write.parquet(f"{root}/landing")
    counts = event_streams.daily_counts(event_streams.read_event_stream(spark, f"{root}/landing"))
    event_streams.append_to(counts, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/table")


# --- refresh and history ----------------------------------------------------

def early_build(catalog: Catalog, since: dt.date) -> str:
    """The tables on code activity as they were on a day: the folder of that build."""
    root = fresh_path(catalog.spark, "refreshed")
    early = catalog.raw_events.filter(F.col("fetched_at").cast("timestamp_ntz") < F.lit(since).cast("timestamp_ntz"))
    replace(catalog, raw_events=early, root=root, _frames={}).build(CODE_GOLD)
    return root


def refresh_run(catalog: Catalog, since: dt.date, name: str = "fct_github_daily_activity") -> DataFrame:
    """A table of an early build, brought up to date by recomputing the days from `since` less a week."""
    root = early_build(catalog, since)
    columns = catalog[name].columns
    publish.refresh_recent_days(catalog["stg_github_events"], root, since - dt.timedelta(days=7), catalog.as_of, catalog.repositories)
    return Catalog.open(catalog.spark, root, catalog.as_of)[name].select(*columns)


def packed_run(catalog: Catalog, since: dt.date, name: str) -> DataFrame:
    """An early build whose old days are packed, in two steps, and which is then brought up to date."""
    root = early_build(catalog, since)
    for before in (since - dt.timedelta(days=14), since - dt.timedelta(days=7)):
        publish.pack_old_days(catalog.spark, root, before)
    publish.refresh_recent_days(catalog["stg_github_events"], root, since - dt.timedelta(days=7), catalog.as_of, catalog.repositories)
    return Catalog.open(catalog.spark, root, catalog.as_of)[name].select(*catalog[name].columns)


def _with_defects(catalog: Catalog) -> Catalog:
    """The catalog over raw rows some of which have lost their document, name an unknown repository or lie in the future;
    some stories have lost title or time."""
    n, story = F.col("event_id").cast("long"), F.col("story_id")
    events = catalog.raw_events.withColumns({
        "repo_name": F.when(n % 50 == 3, "other/repo").otherwise(F.col("repo_name")),
        "raw_payload": F.when(n % 53 != 5, F.col("raw_payload")),
        "fetched_at": F.col("fetched_at") + F.make_dt_interval(days=F.when(n % 59 == 7, 400).otherwise(0))})
    stories = catalog.raw_stories.withColumns({
        "title": F.when(story % 40 != 2, F.col("title")), "time": F.when(story % 41 != 3, F.col("time"))})
    return replace(catalog, raw_events=events, raw_stories=stories, root=None, _frames={})


def _published_beside_quarantine(catalog: Catalog) -> tuple[Catalog, str]:
    """All tables through the full gate, from raw rows with defects."""
    root = fresh_path(catalog.spark, "published")
    publish.build_and_publish(_with_defects(catalog), root, catalog.as_of, quarantine=True)
    return publish.open_published(catalog.spark, root, catalog.as_of), root


def published_facts(catalog: Catalog) -> DataFrame:
    """Repository facts as readers see them after quarantine, build, the full gate and publication."""
    counts = activity.activity_base(activity.stg_events(catalog.raw_events))
    columns = activity.repository_facts(counts, catalog.as_of).columns
    return _published_beside_quarantine(catalog)[0]["fct_github_daily_activity"].select(*columns)


def quarantined(catalog: Catalog, name: str, key: str) -> DataFrame:
    """What the same publication has set aside, and why."""
    root = _published_beside_quarantine(catalog)[1]
    return publish.published_table(catalog.spark, root, name).select(key, F.array_join("faults", "; ").alias("faults"))


# --- declared checks on planted defects ----------------------------------------

def checks_on_defects(catalog: Catalog, kind: str) -> DataFrame:
    """The report of one kind of check where there is something to find: rows stored twice, values outside the lists,
    dimensions that lack rows."""
    if kind == "unique":
        again = replace(catalog, root=None, _frames={},
                        raw_events=catalog.raw_events.unionByName(catalog.raw_events.filter(F.col("event_id").cast("long") % 50 == 1)),
                        raw_stories=catalog.raw_stories.unionByName(catalog.raw_stories.filter(F.col("story_id") % 40 == 2)))
        tables = CheckedTables(again)
        tables["dim_repository"] = again["dim_repository"].unionByName(again["dim_repository"].filter(F.col("repo_name") == params.SAMPLE_REPOSITORY))
    elif kind == "accepted_values":
        odd = replace(catalog, root=None, _frames={}, raw_events=catalog.raw_events.withColumns({
            "repo_name": F.when(F.col("event_id").cast("long") % 40 == 3, "other/repo").otherwise(F.col("repo_name")),
            "raw_payload": F.replace("raw_payload", F.lit('"action":"labeled"'), F.lit('"action":"pinned"'))}))
        tables = CheckedTables(odd)
        tables["dim_contributor"] = odd["dim_contributor"].withColumn(
            "contrib_type", F.when(F.col("username").like("user_1%"), "robot").otherwise(F.col("contrib_type")))
    else:
        tables = CheckedTables(catalog)
        tables["dim_contributor"] = catalog["dim_contributor"].filter(~F.col("username").like("user_1%"))
        tables["dim_repository"] = catalog["dim_repository"].filter(F.col("repo_name") != params.SAMPLE_REPOSITORY)
    return run_checks(tables, of_kind(kind))


def publish_refused(catalog: Catalog) -> DataFrame:
    """The data as they are, through the full gate: the failing checks, and how many versions readers then see."""
    root = fresh_path(catalog.spark, "refused")
    build = replace(catalog, root=None, _frames={})
    publish.build_and_publish(build, root, catalog.as_of, [c for c in gold_checks() if c.table in CODE_GOLD], CODE_GOLD)
    before = publish.published_version(catalog.spark, root)
    refused = replace(catalog, root=None, _frames={})
    try:
        publish.build_and_publish(refused, root, catalog.as_of + dt.timedelta(days=1))
    except QualityError:
        pass
    unchanged = publish.published_version(catalog.spark, root) == before
    failing = declared_report(refused).filter((F.col("severity") == "error") & ~F.col("passed"))
    return failing.withColumn("version_unchanged", F.lit(unchanged))


HISTORY_ATTRIBUTES = ("language", "stars", "total_pushes", "total_commits", "total_pr_events")


def repository_history(catalog: Catalog, first_seen: dt.datetime, next_seen: dt.datetime, stored: bool = False) -> DataFrame:
    """History of the repository attributes over two looks at the facts; with `stored` as a table, to which the
    second look is applied twice."""
    facts = catalog["fct_github_daily_activity"]
    metadata = repository_metadata(catalog.spark, catalog.repositories)

    def snapshot(seen: dt.datetime) -> DataFrame:
        known = facts.filter(F.col("activity_date") < F.lit(seen.date()))
        return activity.repository_dimension(known, metadata, catalog.as_of)

    start = history.start_history(snapshot(first_seen), "repo_name", HISTORY_ATTRIBUTES, first_seen)
    if not stored:
        return history.apply_snapshot(start, snapshot(next_seen), "repo_name", HISTORY_ATTRIBUTES, next_seen)
    path = fresh_path(catalog.spark, "history")
    for number, seen in ((0, first_seen), (1, next_seen), (1, next_seen)):
        history.store_snapshot(path, number, snapshot(seen), "repo_name", HISTORY_ATTRIBUTES, seen)
    return history.read_history(catalog.spark, path, 1, start.schema)


# --- export and SQL ---------------------------------------------------------

def namespaces(catalog: Catalog) -> DataFrame:
    """Two builds side by side: one with the metadata of all repositories, one with that of the first; each root keeps its own tables."""
    spark, name, frames = catalog.spark, "dim_repository", []
    for label, repositories in (("full", catalog.repositories), ("one", catalog.repositories[:1])):
        root = fresh_path(spark, f"namespace-{label}")
        replace(catalog, root=root, _frames={}, repositories=repositories).build((name,))
        frames.append(Catalog.open(spark, root, catalog.as_of)[name].select(F.lit(label).alias("namespace"), "repo_name", "stars"))
    return frames[0].unionByName(frames[1])


def report_of_published(catalog: Catalog) -> DataFrame:
    """A report on the published version, opened for reading while a later version is published."""
    root = fresh_path(catalog.spark, "published-report")
    own_checks = [c for c in gold_checks() if c.table in CODE_GOLD]
    for day in (0, 1):
        publish.build_and_publish(replace(catalog, root=None, _frames={}), root, catalog.as_of + dt.timedelta(days=day), own_checks, CODE_GOLD)
        if not day:
            reader = publish.open_published(catalog.spark, root, catalog.as_of)
    return reader["dim_repository"].select("repo_name", "total_commits", "total_pr_events")


def csv_export(catalog: Catalog) -> DataFrame:
    """A dimension written as CSV and read again."""
    df = catalog["dim_repository"].drop("created_at")
    path = fresh_path(catalog.spark, "export")
    sinks.export_csv(df, path)
    return catalog.spark.read.schema(df.schema).option("header", True).csv(path)


def sql_over_views(catalog: Catalog) -> DataFrame:
    """The datasets as SQL views, used in one statement with bound values."""
    sinks.register_views({n: catalog[n] for n in ("fct_contributor_daily_activity", "dim_contributor")})
    return catalog.spark.sql(
        """
        SELECT f.repo_name, d.contrib_type, count(DISTINCT f.username) AS users,
               sum(f.total_activity_count) AS activity
        FROM fct_contributor_daily_activity f JOIN dim_contributor d ON f.contrib_id = d.contrib_id
        WHERE f.activity_date BETWEEN :first AND :last
        GROUP BY f.repo_name, d.contrib_type
        """,
        args={"first": params.RANGE_START, "last": params.RANGE_END},
    )
