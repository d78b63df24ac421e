"""The declared checks of every table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from devsignals import params
from devsignals.operators import activity, quality, stories
from devsignals.operators.quality import ERROR, WARN, Check
from devsignals.plans.catalog import GOLD, Catalog

# --- fixed values: the checks ---------------------------------------------------

# table: (columns that must be present, of severity error), (of severity warn)
NOT_NULL = {
    "github_events_raw": (
        ("event_id", "repo_name", "event_type", "fetched_at", "raw_payload"),
        ()),
    "hn_stories_raw": (
        ("story_id", "title", "time", "raw_json", "fetched_at"),
        ()),
    "int_push_events": (
        ("event_id", "repo_name", "commit_count", "fetched_at"),
        ("actor_username", "push_id", "commit_ref")),
    "int_pull_requests": (
        ("event_id", "repo_name", "pr_action", "pull_request_id", "fetched_at"),
        ()),
    "int_hn_stories": (
        ("story_id", "title", "score", "comment_count", "activity_date", "published_at", "fetched_at"),
        ("author",)),
    "int_hn_repo_mentions": (
        ("story_id", "mentioned_repo", "activity_date"),
        ()),
    "dim_repository": (
        ("repo_id", "repo_name", "total_pushes", "total_commits", "total_pr_events", "created_at"),
        ("owner", "language", "stars", "first_active_date", "last_active_date")),
    "dim_contributor": (
        ("contrib_id", "username", "total_push_events", "total_commits", "total_pr_events", "contrib_type",
         "created_at"),
        ("first_active_date", "last_active_date")),
    "fct_github_daily_activity": (
        ("repo_id", "repo_name", "activity_date", "push_count", "commit_count", "push_avg_commits",
         "pr_event_count", "pr_opened", "pr_closed", "pr_merged", "pr_other_events", "total_activity_count",
         "created_at"),
        ()),
    "fct_contributor_daily_activity": (
        ("contrib_id", "repo_id", "username", "repo_name", "activity_date", "push_count",
         "commits_in_pushes", "pr_event_count", "pr_opened", "pr_closed", "pr_merged", "pr_other_events",
         "total_activity_count", "contribution_type", "created_at"),
        ()),
    "dim_hn_story": (
        ("hn_story_key", "story_id", "title", "score", "comment_count", "published_at", "created_at"),
        ("author",)),
    "fct_hn_daily_activity": (
        ("activity_date", "story_count", "total_score", "avg_score", "total_comments", "unique_authors",
         "created_at"),
        ()),
    "fct_hn_repo_mentions": (
        ("mentioned_repo", "activity_date", "mention_count", "total_score", "total_comments", "created_at"),
        ()),
}

UNIQUE = {
    "github_events_raw": ("event_id",),
    "hn_stories_raw": ("story_id",),
    "int_push_events": ("event_id",),
    "int_pull_requests": ("event_id",),
    "int_hn_stories": ("story_id",),
    "dim_repository": ("repo_id", "repo_name"),
    "dim_contributor": ("contrib_id", "username"),
    "dim_hn_story": ("hn_story_key", "story_id"),
    "fct_hn_daily_activity": ("activity_date",),
}

# keys of several columns: the grain of the facts
GRAIN = {
    "int_hn_repo_mentions": ("story_id", "mentioned_repo"),
    "fct_github_daily_activity": ("repo_name", "activity_date"),
    "fct_contributor_daily_activity": ("username", "repo_name", "activity_date"),
    "fct_hn_repo_mentions": ("mentioned_repo", "activity_date"),
}

# table, column, accepted values, severity
ACCEPTED = (
    ("int_push_events", "repo_name", params.REPOSITORY_NAMES, WARN),
    ("int_pull_requests", "repo_name", params.REPOSITORY_NAMES, WARN),
    ("int_pull_requests", "pr_action", params.ACCEPTED_PR_ACTIONS, WARN),
    ("int_hn_repo_mentions", "mentioned_repo", params.REPOSITORY_NAMES, ERROR),
    ("dim_repository", "repo_name", params.REPOSITORY_NAMES, ERROR),
    ("dim_contributor", "contrib_type", params.CONTRIBUTION_TYPES, ERROR),
    ("fct_github_daily_activity", "repo_name", params.REPOSITORY_NAMES, ERROR),
    ("fct_contributor_daily_activity", "repo_name", params.REPOSITORY_NAMES, ERROR),
    ("fct_contributor_daily_activity", "contribution_type", params.CONTRIBUTION_TYPES, ERROR),
    ("fct_hn_repo_mentions", "mentioned_repo", params.REPOSITORY_NAMES, ERROR),
)

# child table, key, parent table, parent key
RELATIONSHIPS = (
    ("fct_github_daily_activity", "repo_id", "dim_repository", "repo_id"),
    ("fct_contributor_daily_activity", "contrib_id", "dim_contributor", "contrib_id"),
    ("fct_contributor_daily_activity", "repo_id", "dim_repository", "repo_id"),
)


def declared() -> list[Check]:
    checks = [
        Check(table, "not_null", (column,), severity)
        for table, groups in NOT_NULL.items()
        for severity, columns in zip((ERROR, WARN), groups)
        for column in columns
    ]
    checks += [Check(table, "unique", (column,)) for table, columns in UNIQUE.items() for column in columns]
    checks += [Check(table, "unique", columns) for table, columns in GRAIN.items()]
    checks += [Check(t, "accepted_values", (c,), severity, tuple(v)) for t, c, v, severity in ACCEPTED]
    checks += [Check(t, "relationships", (c,), ERROR, (pc,), p) for t, c, p, pc in RELATIONSHIPS]
    return checks


def of_kind(kind: str) -> list[Check]:
    return [c for c in declared() if c.kind == kind]


def row_rules(tables: Sequence[str]) -> list[Check]:
    """The checks of severity error that a row of these tables passes or breaks by itself."""
    return [c for c in declared() if c.table in tables and c.severity == ERROR and c.kind in ("not_null", "accepted_values")]


def gold_checks() -> list[Check]:
    return [c for c in declared() if c.table in GOLD]


class CheckedTables(dict):
    """The tables of a catalog under the names the checks use."""

    def __init__(self, catalog: Catalog):
        super().__init__(github_events_raw=catalog.raw_events, hn_stories_raw=catalog.raw_stories)
        self._catalog = catalog

    def __missing__(self, name: str) -> DataFrame:
        return self._catalog[name]


def shared_sources(catalog: Catalog, names: set[str]) -> list[quality.Source]:
    """Bronze and silver tables that can be checked in one pass over their raw table."""
    sources = []
    if names & set(activity.FROM_EVENTS):
        sources.append(quality.Source(activity.FROM_EVENTS, activity.with_silver(catalog["stg_github_events"])))
    if names & set(stories.FROM_STORIES):
        sources.append(quality.Source(stories.FROM_STORIES, stories.with_silver(catalog.raw_stories)))
    return sources


def report(catalog: Catalog, checks: list[Check] | None = None) -> DataFrame:
    checks = checks or declared()
    return quality.run(CheckedTables(catalog), checks, shared_sources(catalog, {c.table for c in checks}))
