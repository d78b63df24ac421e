"""Code-hosting events: bronze, silver, and the counts behind dimensions and facts.

All gold activity data comes from one aggregation over one scan of the events
(`activity_base`); coarser tables add its rows up and never read events again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from devsignals import params, schemas
from devsignals.functions import numeric, text, times

MEASURES = ("push_count", "commit_count", "pr_event_count", "pr_opened", "pr_closed", "pr_merged", "pr_other_events")


# --- bronze and silver ------------------------------------------------------

def stg_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        "repo_name",
        "event_type",
        F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        "raw_payload",
    )


def _with_document(events: DataFrame, schema: str = schemas.EVENT_DOCUMENT) -> DataFrame:
    return events.withColumn("doc", F.from_json("raw_payload", schema))


def _commit_count() -> Column:
    """Length of the commit list; 0 when it is missing, null or no list."""
    return F.coalesce(F.json_array_length("doc.payload.commits"), F.lit(0))


def _push_columns() -> list[Column]:
    return [
        F.col("event_id"),
        F.col("repo_name"),
        F.col("fetched_at"),
        F.col("doc.actor.login").alias("actor_username"),
        F.col("doc.payload.push_id").alias("push_id"),
        F.col("doc.payload.ref").alias("commit_ref"),
        _commit_count().alias("commit_count"),
    ]


def _request_columns() -> list[Column]:
    request = "doc.payload.pull_request"
    return [
        F.col("event_id"),
        F.col("repo_name"),
        F.col("fetched_at"),
        F.col("doc.payload.action").alias("pr_action"),
        F.col(f"{request}.id").alias("pull_request_id"),
        F.col(f"{request}.title").alias("pr_title"),
        F.col(f"{request}.user.login").alias("pr_author"),
    ]


def push_events(stg: DataFrame) -> DataFrame:
    return _with_document(stg.filter(F.col("event_type") == params.PUSH)).select(*_push_columns())


def pull_requests(stg: DataFrame) -> DataFrame:
    return _with_document(stg.filter(F.col("event_type") == params.PULL_REQUEST)).select(*_request_columns())


FROM_EVENTS = ("github_events_raw", "int_push_events", "int_pull_requests")


def with_silver(stg: DataFrame) -> DataFrame:
    """Bronze and both silver datasets side by side, from one scan and one parse: a struct per dataset
    and a flag that says whether the row belongs to it."""
    kind = F.col("event_type")
    document = F.from_json(F.when(kind.isin(params.PUSH, params.PULL_REQUEST), F.col("raw_payload")), schemas.EVENT_DOCUMENT)
    bronze, pushes, requests = FROM_EVENTS
    return stg.withColumn("doc", document).select(
        F.struct(*stg.columns).alias(bronze), F.lit(True).alias(f"is_{bronze}"),
        F.struct(*_push_columns()).alias(pushes), (kind == params.PUSH).alias(f"is_{pushes}"),
        F.struct(*_request_columns()).alias(requests), (kind == params.PULL_REQUEST).alias(f"is_{requests}"),
    )


# --- one row per push or pull-request event, then counts ---------------------

def activity_rows(stg: DataFrame) -> DataFrame:
    """Pushes and pull-request events side by side, from one scan and one parse.

    `username` is who pushed or who opened the pull request; the day is the day of
    ingestion.
    """
    both = stg.filter(F.col("event_type").isin(params.PUSH, params.PULL_REQUEST))
    is_push = F.col("event_type") == params.PUSH
    return _with_document(both, schemas.ACTIVITY_DOCUMENT).select(
        "repo_name",
        F.to_date("fetched_at").alias("activity_date"),
        F.when(is_push, F.col("doc.actor.login"))
        .otherwise(F.col("doc.payload.pull_request.user.login")).alias("username"),
        is_push.alias("is_push"),
        F.when(is_push, _commit_count()).alias("commits"),
        F.when(~is_push, F.col("doc.payload.action")).alias("pr_action"),
    )


def activity_rows_from_silver(pushes: DataFrame, requests: DataFrame) -> DataFrame:
    """The same rows from the two silver datasets."""
    left = pushes.select(
        "repo_name", F.to_date("fetched_at").alias("activity_date"), F.col("actor_username").alias("username"),
        F.lit(True).alias("is_push"), F.col("commit_count").alias("commits"),
        F.lit(None).cast("string").alias("pr_action"),
    )
    right = requests.select(
        "repo_name", F.to_date("fetched_at").alias("activity_date"), F.col("pr_author").alias("username"),
        F.lit(False).alias("is_push"), F.lit(None).cast("int").alias("commits"), "pr_action",
    )
    return left.unionByName(right)


def count_activity(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per key. An unknown action is counted as an event but in no action group."""
    action, request = F.col("pr_action"), ~F.col("is_push")
    return rows.groupBy(*keys).agg(
        F.count_if("is_push").alias("push_count"),
        F.coalesce(F.sum("commits"), F.lit(0)).alias("commit_count"),
        F.count_if(request).alias("pr_event_count"),
        F.count_if(action == "opened").alias("pr_opened"),
        F.count_if(action.isin("closed", "merged")).alias("pr_closed"),
        F.count_if(action == "merged").alias("pr_merged"),
        F.count_if(~action.isin("opened", "closed", "merged")).alias("pr_other_events"),
    )


def activity_base(stg: DataFrame) -> DataFrame:
    """Counts per user (unknown users included), repository and day."""
    return count_activity(activity_rows(stg), ("username", "repo_name", "activity_date"))


def roll_up(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


# --- facts ------------------------------------------------------------------

def _derived(counts: DataFrame) -> DataFrame:
    return counts.withColumn("total_activity_count", F.col("push_count") + F.col("pr_event_count")).withColumn(
        "pr_merged_pct", numeric.percent(F.col("pr_merged"), F.col("pr_event_count"))
    )


def repository_facts(base: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Repository and day. The key is computed, as it depends on the name alone."""
    counts = roll_up(base, ("repo_name", "activity_date"))
    return _derived(counts).select(
        text.surrogate_key(F.col("repo_name"), params.REPOSITORY_SALT).alias("repo_id"),
        "repo_name",
        "activity_date",
        "push_count",
        "commit_count",
        F.coalesce(numeric.ratio(F.col("commit_count"), F.col("push_count")), F.lit(0.0)).alias("push_avg_commits"),
        "pr_event_count",
        "pr_opened",
        "pr_closed",
        "pr_merged",
        "pr_other_events",
        "pr_merged_pct",
        "total_activity_count",
        times.moment(as_of).alias("created_at"),
    )


def contributor_facts(base: DataFrame, as_of: dt.datetime) -> DataFrame:
    """User, repository and day; events without a user are left out."""
    known = base.filter(F.col("username").isNotNull()).withColumnRenamed("commit_count", "commits_in_pushes")
    return _derived(known).select(
        text.surrogate_key(F.col("username"), params.CONTRIBUTOR_SALT).alias("contrib_id"),
        text.surrogate_key(F.col("repo_name"), params.REPOSITORY_SALT).alias("repo_id"),
        "username",
        "repo_name",
        "activity_date",
        "push_count",
        "commits_in_pushes",
        "pr_event_count",
        "pr_opened",
        "pr_closed",
        "pr_merged",
        "pr_other_events",
        "total_activity_count",
        "pr_merged_pct",
        text.contribution_type(F.col("commits_in_pushes"), F.col("pr_event_count")).alias("contribution_type"),
        times.moment(as_of).alias("created_at"),
    )


def look_up_key(facts: DataFrame, dimension: DataFrame, business_key: str, key: str) -> DataFrame:
    """The surrogate key as the dimension holds it, for facts and dimensions of different
    builds. A plain left join: Spark broadcasts the dimension only when it is small."""
    return facts.drop(key).join(dimension.select(business_key, key), business_key, "left")


# --- dimensions -------------------------------------------------------------

SUMS = ("days", "pushes", "commits", "pr_events")
SPANS = ("push", "request")


def totals(facts: DataFrame, keys: Sequence[str], commits: str) -> DataFrame:
    """All-time totals per key, and the span of its pushes and of its pull requests."""
    pushed = F.when(F.col("push_count") > 0, F.col("activity_date"))
    requested = F.when(F.col("pr_event_count") > 0, F.col("activity_date"))
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("push_count").alias("pushes"),
        F.sum(commits).alias("commits"),
        F.sum("pr_event_count").alias("pr_events"),
        F.min(pushed).alias("first_push"), F.max(pushed).alias("last_push"),
        F.min(requested).alias("first_request"), F.max(requested).alias("last_request"),
    )


def _active_dates() -> list[Column]:
    """The dates of pull requests count only for keys without any push."""
    return [F.coalesce("first_push", "first_request").alias("first_active_date"),
            F.coalesce("last_push", "last_request").alias("last_active_date")]


def replaced_days(stored: DataFrame, before: DataFrame, after: DataFrame, keys: Sequence[str], days: Sequence[dt.date]) -> DataFrame:
    """Totals when the rows of `days` are replaced: `stored` less `before`, the totals of the replaced rows, plus `after`,
    those of the new ones. One grouping of three small frames; the facts are not read.

    A first or last date is kept if it lies outside the days, and moves with the new rows if they reach as far. Where it
    lay within the days and the new rows fall short of it, only the other days know: `unsure` is true then.
    """
    columns = [f"{end}_{kind}" for kind in SPANS for end in ("first", "last")]
    sides = (("stored", stored, 1), ("before", before, -1), ("after", after, 1))
    rows = None
    for name, df, sign in sides:
        part = df.select(*keys, *[(F.col(c) * sign).alias(c) for c in SUMS], *[
            (F.col(c) if name == side else F.lit(None).cast("date")).alias(f"{side}_{c}") for side, _, _ in sides for c in columns])
        rows = part if rows is None else rows.unionByName(part)
    added = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *[
        F.max(f"{side}_{c}").alias(f"{side}_{c}") for side in ("stored", "after") for c in columns])
    dates, unsure = [], F.lit(False)
    for c in columns:
        old, new = F.col(f"stored_{c}"), F.col(f"after_{c}")
        pick, reaches = (F.least, new <= old) if c.startswith("first") else (F.greatest, new >= old)
        inside = F.coalesce(old.isin(*days), F.lit(False))
        dates.append(F.when(inside, new).otherwise(pick(old, new)).alias(c))
        unsure = unsure | (inside & ~F.coalesce(reaches, F.lit(False)))
    return added.filter("days > 0").select(*keys, *SUMS, *dates, unsure.alias("unsure"))


def sure_dates(replaced: DataFrame, other_days: DataFrame, keys: Sequence[str], commits: str) -> DataFrame:
    """The totals of `replaced_days` with the dates of unsure keys taken from the facts of all other days as well."""
    wanted = replaced.filter("unsure").select(*keys)
    rest = totals(other_days.join(wanted, list(keys), "left_semi"), keys, commits).select(
        *keys, *[F.col(f"{end}_{kind}").alias(f"rest_{end}_{kind}") for kind in SPANS for end in ("first", "last")])
    joined = replaced.join(rest, list(keys), "left")
    dates = [pick(f"{end}_{kind}", f"rest_{end}_{kind}").alias(f"{end}_{kind}")
             for kind in SPANS for end, pick in (("first", F.least), ("last", F.greatest))]
    return joined.select(*keys, *SUMS, *dates)


def repository_dimension(facts: DataFrame, metadata: DataFrame, as_of: dt.datetime) -> DataFrame:
    """`metadata` holds repo_name, language and stars of the repositories that have them."""
    return repository_dimension_of(totals(facts, ["repo_name"], "commit_count"), metadata, as_of)


def contributor_dimension(facts: DataFrame, as_of: dt.datetime) -> DataFrame:
    return contributor_dimension_of(totals(facts, ["username"], "commits_in_pushes"), as_of)


def repository_dimension_of(summed: DataFrame, metadata: DataFrame, as_of: dt.datetime) -> DataFrame:
    return summed.join(metadata, "repo_name", "left").select(
        text.surrogate_key(F.col("repo_name"), params.REPOSITORY_SALT).alias("repo_id"),
        "repo_name",
        F.split_part("repo_name", F.lit("/"), F.lit(1)).alias("owner"),
        F.coalesce("language", F.lit(params.UNKNOWN_LANGUAGE)).alias("language"),
        F.coalesce("stars", F.lit(0)).alias("stars"),
        F.col("pushes").alias("total_pushes"),
        F.col("commits").alias("total_commits"),
        F.col("pr_events").alias("total_pr_events"),
        *_active_dates(),
        times.moment(as_of).alias("created_at"),
    )


def contributor_dimension_of(summed: DataFrame, as_of: dt.datetime) -> DataFrame:
    return summed.select(
        text.surrogate_key(F.col("username"), params.CONTRIBUTOR_SALT).alias("contrib_id"),
        "username",
        F.col("pushes").alias("total_push_events"),
        F.col("commits").alias("total_commits"),
        F.col("pr_events").alias("total_pr_events"),
        text.contribution_type(F.col("commits"), F.col("pr_events")).alias("contrib_type"),
        *_active_dates(),
        times.moment(as_of).alias("created_at"),
    )
