"""SQL for the declared checks, from a list of its own: a check that the engine lost would be missing there."""

from __future__ import annotations

from dataclasses import dataclass

from oracle.datasets import AS_OF, ratio, with_datasets


@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple[str, ...] = ()
    parent: str = ""


# --- fixed values: what is checked ---------------------------------------------------

MUST_BE_THERE = {
    "github_events_raw": ["event_id", "repo_name", "event_type", "fetched_at", "raw_payload"],
    "hn_stories_raw": ["story_id", "title", "time", "raw_json", "fetched_at"],
    "int_push_events": ["event_id", "repo_name", "commit_count", "fetched_at"],
    "int_pull_requests": ["event_id", "repo_name", "pr_action", "pull_request_id", "fetched_at"],
    "int_hn_stories": ["story_id", "title", "score", "comment_count", "activity_date", "published_at", "fetched_at"],
    "int_hn_repo_mentions": ["story_id", "mentioned_repo", "activity_date"],
    "dim_repository": ["repo_id", "repo_name", "total_pushes", "total_commits", "total_pr_events", "created_at"],
    "dim_contributor": ["contrib_id", "username", "total_push_events", "total_commits", "total_pr_events", "contrib_type", "created_at"],
    "fct_github_daily_activity": [
        "repo_id", "repo_name", "activity_date", "push_count", "commit_count", "push_avg_commits", "pr_event_count", "pr_opened",
        "pr_closed", "pr_merged", "pr_other_events", "total_activity_count", "created_at"],
    "fct_contributor_daily_activity": [
        "contrib_id", "repo_id", "username", "repo_name", "activity_date", "push_count", "commits_in_pushes", "pr_event_count",
        "pr_opened", "pr_closed", "pr_merged", "pr_other_events", "total_activity_count", "contribution_type", "created_at"],
    "dim_hn_story": ["hn_story_key", "story_id", "title", "score", "comment_count", "published_at", "created_at"],
    "fct_hn_daily_activity": ["activity_date", "story_count", "total_score", "avg_score", "total_comments", "unique_authors", "created_at"],
    "fct_hn_repo_mentions": ["mentioned_repo", "activity_date", "mention_count", "total_score", "total_comments", "created_at"],
}
SHOULD_BE_THERE = {
    "int_push_events": ["actor_username", "push_id", "commit_ref"],
    "int_hn_stories": ["author"],
    "dim_repository": ["owner", "language", "stars", "first_active_date", "last_active_date"],
    "dim_contributor": ["first_active_date", "last_active_date"],
    "dim_hn_story": ["author"],
}
KEYS = [
    ("github_events_raw", "event_id"), ("hn_stories_raw", "story_id"), ("int_push_events", "event_id"), ("int_pull_requests", "event_id"),
    ("int_hn_stories", "story_id"), ("dim_repository", "repo_id"), ("dim_repository", "repo_name"), ("dim_contributor", "contrib_id"),
    ("dim_contributor", "username"), ("dim_hn_story", "hn_story_key"), ("dim_hn_story", "story_id"), ("fct_hn_daily_activity", "activity_date"),
    ("int_hn_repo_mentions", "story_id", "mentioned_repo"), ("fct_github_daily_activity", "repo_name", "activity_date"),
    ("fct_contributor_daily_activity", "username", "repo_name", "activity_date"), ("fct_hn_repo_mentions", "mentioned_repo", "activity_date"),
]
REPOSITORIES = ("facebook/react", "microsoft/vscode", "vercel/next.js")
ACTIONS = ("opened", "closed", "reopened", "synchronize", "assigned", "unassigned", "review_requested", "review_request_removed",
           "labeled", "unlabeled", "edited", "merged")
KINDS = ("push_only", "pr_only", "both", "unknown")
LISTED = [
    ("int_push_events", "repo_name", REPOSITORIES, "warn"), ("int_pull_requests", "repo_name", REPOSITORIES, "warn"),
    ("int_pull_requests", "pr_action", ACTIONS, "warn"), ("int_hn_repo_mentions", "mentioned_repo", REPOSITORIES, "error"),
    ("dim_repository", "repo_name", REPOSITORIES, "error"), ("dim_contributor", "contrib_type", KINDS, "error"),
    ("fct_github_daily_activity", "repo_name", REPOSITORIES, "error"), ("fct_contributor_daily_activity", "repo_name", REPOSITORIES, "error"),
    ("fct_contributor_daily_activity", "contribution_type", KINDS, "error"), ("fct_hn_repo_mentions", "mentioned_repo", REPOSITORIES, "error"),
]
PARENTS = [
    ("fct_github_daily_activity", "repo_id", "dim_repository"), ("fct_contributor_daily_activity", "contrib_id", "dim_contributor"),
    ("fct_contributor_daily_activity", "repo_id", "dim_repository"),
]

RULES = [
    *[Rule(t, "not_null", (c,)) for t, columns in MUST_BE_THERE.items() for c in columns],
    *[Rule(t, "not_null", (c,), "warn") for t, columns in SHOULD_BE_THERE.items() for c in columns],
    *[Rule(t, "unique", tuple(columns)) for t, *columns in KEYS],
    *[Rule(t, "accepted_values", (c,), severity, values) for t, c, values, severity in LISTED],
    *[Rule(t, "relationships", (c,), parent=p) for t, c, p in PARENTS],
]
TABLES = {"github_events_raw": "stg_github_events", "hn_stories_raw": "raw_stories"}


def failing(rule: Rule) -> str:
    table, first, keys = TABLES.get(rule.table, rule.table), rule.columns[0], ", ".join(rule.columns)
    if rule.kind == "not_null":
        return f"SELECT count(*) AS n FROM {table} WHERE {first} IS NULL"
    if rule.kind == "unique":
        present = " AND ".join(f"{c} IS NOT NULL" for c in rule.columns)
        return f"SELECT count(*) AS n FROM (SELECT {keys} FROM {table} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"
    if rule.kind == "accepted_values":
        allowed = ", ".join(f"'{v}'" for v in rule.values)
        return f"SELECT count(DISTINCT {first}) AS n FROM {table} WHERE {first} NOT IN ({allowed})"
    return (f"SELECT count(*) AS n FROM {table} c WHERE c.{first} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {rule.parent} p WHERE p.{first} = c.{first})")


def report(kind: str | None = None) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{r.table}' AS table_name, '{r.kind}' AS check_type, '{', '.join(r.columns)}' AS column_name, '{r.severity}' AS severity, "
        f"n AS failing_rows, n = 0 AS passed FROM ({failing(r)})"
        for r in RULES if kind in (None, r.kind))


# --- the same rules where rows are stored twice, values are not listed, dimensions lack rows ---

PLANTED = {
    "unique": {
        "typed_events": "SELECT * FROM {} UNION ALL SELECT * FROM {} WHERE n % 50 = 1",
        "raw_stories": "SELECT * FROM {} UNION ALL SELECT * FROM {} WHERE story_id % 40 = 2",
        "dim_repository": "SELECT * FROM {} UNION ALL SELECT * FROM {} WHERE repo_name = 'facebook/react'"},
    "accepted_values": {
        "typed_events": """SELECT * REPLACE (CASE WHEN n % 40 = 3 THEN 'other/repo' ELSE repo_name END AS repo_name,
            CASE WHEN action = 'labeled' THEN 'pinned' ELSE action END AS action) FROM {}""",
        "dim_contributor": """SELECT * REPLACE (CASE WHEN username LIKE 'user_1%' THEN 'robot' ELSE contrib_type END AS contrib_type)
            FROM {}"""},
    "relationships": {
        "dim_contributor": "SELECT * FROM {} WHERE username NOT LIKE 'user_1%'",
        "dim_repository": "SELECT * FROM {} WHERE repo_name <> 'facebook/react'"},
}


def planted_statements() -> dict[str, str]:
    return {f"dq_{kind}_found": with_datasets(report(kind), changed) for kind, changed in PLANTED.items()}


def statements() -> dict[str, str]:
    q = {f"dq_{kind}": report(kind) for kind in ("not_null", "unique", "accepted_values", "relationships")}
    q["dq_report"] = report()
    q["publish_refused"] = f"SELECT *, true AS version_unchanged FROM ({report()}) WHERE severity = 'error' AND NOT passed"
    age = ratio(f"epoch_us({AS_OF}) - epoch_us(loaded_at)", "3600000000", 1)
    q["dq_source_freshness"] = f"""SELECT *, CASE WHEN age_hours IS NULL OR age_hours > 12 THEN 'error'
        WHEN age_hours > 6 THEN 'warn' ELSE 'pass' END AS status FROM (
        SELECT source_name, loaded_at, {age} AS age_hours FROM (
        SELECT 'github_events_raw' AS source_name, max(fetched_at) AS loaded_at FROM stg_github_events
        UNION ALL SELECT 'hn_stories_raw', max(fetched_at) FROM stg_hn_stories))"""
    return q
