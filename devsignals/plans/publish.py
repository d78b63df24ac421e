"""Build, check, publish: readers see a new version of the gold tables only after all
checks passed, and all tables of a version together."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from devsignals import params
from devsignals.functions import times
from devsignals.operators import activity, leaderboards, quality, sketches, stories
from devsignals.plans import checks as declared_checks
from devsignals.plans.catalog import GOLD, LAYOUTS, Catalog, packed_upto, read_table, repository_metadata
from devsignals.session import drop_partition, intermediates_dropped, written
from devsignals.sources import sinks

_VERSIONS = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])


QUARANTINE = {"github_events_raw": "quarantined_events", "hn_stories_raw": "quarantined_stories"}


def set_aside(catalog: Catalog, root: str, now: dt.datetime) -> Catalog:
    """Route raw rows that break a row-level rule of severity error to tables of their own in `root`, each with the names of the
    rules it breaks. Returns the catalog over all other rows.

    Rules are the declared ones of bronze and silver columns, and for pushes and pull requests the gold tables' list of
    repositories and that nothing lies behind `now`. The good rows are `written` once, so that what follows does not
    parse and judge them at each read. Keys that occur twice are left to the gate: ingestion does not store them.
    """
    active = F.col("is_int_push_events") | F.col("is_int_pull_requests")
    row = activity.FROM_EVENTS[0]
    rules = [("repo_name: accepted_values", active & ~F.col(f"{row}.repo_name").isin(*params.REPOSITORY_NAMES)),
             ("fetched_at: no_future_timestamps", active & (F.col(f"{row}.fetched_at") > times.moment(now)))]
    good = {}
    for source in declared_checks.shared_sources(catalog, {row, stories.FROM_STORIES[0]}):
        own = rules if source.tables == activity.FROM_EVENTS else []
        name = QUARANTINE[source.tables[0]]
        marked = quality.row_faults(source, declared_checks.row_rules(source.tables), own)
        sinks.write_table(marked.filter(F.size("faults") > 0), f"{root}/{name}")
        good[name] = written(marked.filter(F.size("faults") == 0).drop("faults"), f"{name}-kept", "zstd")
    return replace(catalog, raw_events=good["quarantined_events"], raw_stories=good["quarantined_stories"], root=None, _frames={})


def build_and_publish(catalog: Catalog, root: str, published_at: dt.datetime, checks: Sequence[quality.Check] | None = None,
                      names: Sequence[str] = GOLD, quarantine: bool = False) -> str:
    """Write a new version of all tables, check it, and only then announce it.

    Without `checks` the gate is the full suite: all declared checks of bronze, silver and gold tables, and the three
    business rules. With `quarantine`, raw rows that break a row-level rule are set aside first, beside the version's tables,
    so that single bad rows do not hold up the others.

    The announcement is one appended row, so it is there as a whole or not at all; a
    version that failed stays unannounced, and readers keep the last good one.
    """
    spark = catalog.spark
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    with intermediates_dropped(spark):
        if quarantine:
            catalog = set_aside(catalog, folder, published_at)
        catalog.root = folder
        catalog.build(names)
        quality.enforce(declared_checks.report(catalog, list(checks) if checks else None))
        if not checks:
            quality.enforce_rules(catalog["int_push_events"], catalog["int_pull_requests"], catalog["stg_github_events"], published_at)
    row = spark.range(1).select(
        F.lit(version).alias("version"), F.lit(published_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("published_at"),
        F.lit(time.time_ns()).alias("seq"))
    row.write.mode("append").parquet(f"{root}/published")
    return version


def published_version(spark: SparkSession, root: str) -> str:
    versions = spark.read.schema(_VERSIONS).parquet(f"{root}/published")
    return versions.agg(F.max_by("version", F.struct("published_at", "seq")).alias("version")).first()["version"]


def open_published(spark: SparkSession, root: str, as_of: dt.datetime) -> Catalog:
    """The tables of the version published last. A later publication has its own folder, so an open catalog goes on working."""
    return Catalog.open(spark, f"{root}/versions/{published_version(spark, root)}", as_of)


def published_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/versions/{published_version(spark, root)}/{name}")


# facts: (totals, their keys), ..., and the name of the commit count
TOTALS = {
    "fct_github_daily_activity": ((("repository_totals", ["repo_name"]),), "commit_count"),
    "fct_contributor_daily_activity": (
        (("contributor_totals", ["username"]), ("contributor_repository_totals", ["repo_name", "username"])), "commits_in_pushes"),
}


def pack_old_days(spark: SparkSession, root: str, before: dt.date) -> None:
    """Store the days of both facts before a day as few files, each a range of days, instead of a folder a day.

    The number of files then follows from their bytes however many days there are. The packed files are written, then pointed to;
    from then on readers take the days before `before` from them, and the days' folders go. Packing again, later, takes
    up what is packed already. Packed days cannot be refreshed.
    """
    for name in TOTALS:
        path, layout = f"{root}/{name}", LAYOUTS[name]
        upto = packed_upto(spark, path)
        if upto is not None and before <= upto:
            continue
        old = read_table(spark, path).filter(F.col("activity_date") < F.lit(before))
        sinks.write_table(old, f"{path}-packed/upto={before}", cluster_by=("activity_date", *layout.sort_by))
        spark.range(1).select(F.lit(before).alias("upto")).write.mode("append").parquet(f"{path}-packed-upto")
        days = spark.read.parquet(path).filter(F.col("activity_date") < F.lit(before)).select("activity_date").distinct()
        for (day,) in days.collect():                # a date each
            drop_partition(spark, path, f"activity_date={day}")


def refresh_recent_days(stg_events: DataFrame, root: str, since: dt.date, as_of: dt.datetime,
                        repositories: Sequence[tuple[str, str, int]] = params.TRACKED_REPOSITORIES) -> None:
    """Bring the tables on code activity in `root` up to date: recompute both facts from `since` on, replace just
    these days, and carry the difference over into totals, dimensions, ranks and sketches.

    The events are read and counted once; the date limit reaches their scan. Of the facts only the folders of the replaced
    days are read, unless a first or last date lay there and has gone (then those keys are looked up in the other days).
    Tables change in place: meant for a version before its publication.
    """
    with intermediates_dropped(stg_events.sparkSession):
        _refresh(stg_events, root, since, as_of, repositories)


def _refresh(stg_events: DataFrame, root: str, since: dt.date, as_of: dt.datetime, repositories: Sequence[tuple[str, str, int]]) -> None:
    spark = stg_events.sparkSession
    recent = stg_events.filter(F.col("fetched_at") >= F.lit(since).cast("timestamp_ntz"))
    base = written(activity.activity_base(recent), "recent-activity")
    days = [r[0] for r in base.select("activity_date").distinct().collect()]     # a date each
    if not days:
        return
    if any(day < upto for name in TOTALS if (upto := packed_upto(spark, f"{root}/{name}")) for day in days):
        raise ValueError("days that are packed cannot be refreshed")
    stored = Catalog.open(spark, root, as_of)

    def put(name: str, df: DataFrame, dynamic: bool = False) -> None:
        layout = LAYOUTS[name]
        sinks.write_table(df, f"{root}/{name}", layout.partition_by, layout.sort_by, dynamic, layout.cluster_by)

    fresh = {"fct_github_daily_activity": activity.repository_facts(base, as_of),
             "fct_contributor_daily_activity": activity.contributor_facts(base, as_of)}

    inside = F.col("activity_date").isin(days)

    def carry_over(name: str, summed: str, keys: list[str], commits: str) -> None:
        totals = written(activity.replaced_days(
            stored[summed], activity.totals(stored[name].filter(inside), keys, commits), activity.totals(fresh[name], keys, commits),
            keys, days), "replaced-days")
        if not totals.filter("unsure").isEmpty():
            totals = written(activity.sure_dates(totals, stored[name].filter(~inside), keys, commits), "sure-dates")
        put(summed, totals.drop("unsure"))

    def together(*steps: Callable[[], None]) -> None:
        """Steps that do not need each other, side by side."""
        with ThreadPoolExecutor(len(steps)) as pool:
            for run in [pool.submit(copy_context().run, step) for step in steps]:
                run.result()

    def contributors() -> None:
        put("dim_contributor", activity.contributor_dimension_of(now["contributor_totals"], as_of))
        put("contributor_ranks", leaderboards.ranked_contributors(now["dim_contributor"], now["contributor_repository_totals"]))

    def daily_sketches() -> None:
        other_days = stored["contributor_sketches"].filter(~inside)
        new_days = sketches.daily_sketches(fresh["fct_contributor_daily_activity"], ("repo_name", "activity_date"), "username")
        put("contributor_sketches", written(other_days.unionByName(new_days), "sketches"))

    # totals first: they need the days as they were
    together(*[partial(carry_over, name, summed, keys, commits)
               for name, (kinds, commits) in TOTALS.items() for summed, keys in kinds])
    now = Catalog.open(spark, root, as_of)
    together(
        *[partial(put, name, df, dynamic=True) for name, df in fresh.items()], contributors, daily_sketches,
        lambda: put("dim_repository", activity.repository_dimension_of(
            now["repository_totals"], repository_metadata(spark, repositories), as_of)))
