"""The datasets as SQL, each under its name, and their assembly into WITH lists.

Written apart from the Spark code: facts come from joined aggregates, counts from
plain columns instead of documents, rounding from whole numbers.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def ratio(a: str, b: str, decimals: int = 2, scale: int = 1) -> str:
    """Half-up rounding of a*scale/b in whole numbers; NULL for b = 0."""
    shift = 10 ** decimals
    return (f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST((CAST({a} AS BIGINT) * {2 * shift * scale} + CAST({b} AS BIGINT))"
            f" // (2 * CAST({b} AS BIGINT)) AS DOUBLE) / {float(shift)} END)")


def percent(a: str, b: str, decimals: int = 2) -> str:
    return ratio(a, b, decimals, 100)


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def mean_of_percents(column: str) -> str:
    whole = f"CAST(round({column} * 100) AS BIGINT)"
    return f"({ratio(f'sum({whole})', f'count({column})', 0)} / 100.0)"


# --- fixed values: repository, and what names it in a lower-cased title ---
PATTERNS = {
    "facebook/react": r"""(?:^|[\s\-\.,;:!?\(/"'])(?:react(?:\.?js)?)(?:$|[\s\-\.,;:!?\)/"'])""",
    "microsoft/vscode": r"""(?:^|[\s\-\.,;:!?\(/"'])(?:vscode|vs\s*code|visual\s+studio\s+code)(?:$|[\s\-\.,;:!?\)/"'])""",
    "vercel/next.js": r"""(?:^|[\s\-\.,;:!?\(/"'])(?:next[\.\s]?js)(?:$|[\s\-\.,;:!?\)/"'])""",
}
_pattern_rows = ", ".join("('%s', '%s')" % (repo, p.replace("'", "''")) for repo, p in PATTERNS.items())

VALID = "coalesce(story_id, 0) <> 0 AND coalesce(title, '') <> ''"


def upserted(first: str, second: str) -> str:
    """Identity columns from the first poll that has the story, all others from the last."""
    return f"""
        SELECT coalesce(a.story_id, b.story_id) AS story_id,
               CASE WHEN a.story_id IS NULL THEN b.title ELSE a.title END AS title,
               CASE WHEN a.story_id IS NULL THEN b.author ELSE a.author END AS author,
               CASE WHEN a.story_id IS NULL THEN b.url ELSE a.url END AS url,
               CASE WHEN b.story_id IS NULL THEN a.score ELSE b.score END AS score,
               coalesce(a.time, b.time) AS time,
               CASE WHEN b.story_id IS NULL THEN a.descendants ELSE b.descendants END AS descendants,
               coalesce(a.type, b.type) AS type,
               CASE WHEN b.story_id IS NULL THEN a.fetched_at ELSE b.fetched_at END AS fetched_at,
               CAST(CASE WHEN b.story_id IS NULL THEN a.score ELSE b.score END AS VARCHAR) AS raw_score
        FROM (SELECT DISTINCT * FROM {first}) a FULL JOIN (SELECT DISTINCT * FROM {second}) b ON a.story_id = b.story_id"""


DATASETS = {
    # --- raw events as columns ---
    "source_events": """
        SELECT event_id AS n, user_id, event_type AS kind, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "typed_events": """
        SELECT n, CAST(n AS VARCHAR) AS event_id,
               CASE n % 3 WHEN 0 THEN 'facebook/react' WHEN 1 THEN 'microsoft/vscode' ELSE 'vercel/next.js' END AS repo_name,
               CASE WHEN user_id % 7 = 2 THEN 'PullRequestEvent' WHEN user_id % 7 = 3 THEN 'PushEvent'
                    WHEN kind IN ('click', 'signup') THEN 'PushEvent'
                    WHEN kind IN ('view', 'purchase') THEN 'PullRequestEvent' ELSE 'IssuesEvent' END AS event_type,
               ts AS fetched_at, date_trunc('second', ts - to_minutes(k)) AS created, user_id, k,
               CASE WHEN k % 10 <> 9 THEN 'user_' || user_id END AS login,
               CASE WHEN user_id % 5 = 1 THEN 0 WHEN k % 6 = 5 THEN NULL ELSE k % 6 END AS commits,
               CASE WHEN k % 25 <> 24 THEN ['opened', 'closed', 'merged', 'labeled', 'synchronize'][k % 5 + 1] END AS action,
               CASE WHEN k % 4 <> 3 THEN 'PR ' || n END AS pr_name
        FROM source_events""",
    "stg_github_events": """
        SELECT event_id, repo_name, event_type, fetched_at,
               '{"id":"' || event_id || '","type":"' || event_type || '","actor":{' || coalesce('"login":"' || login || '"', '')
               || '},"repo":{"name":"' || repo_name || '"},"payload":{'
               || CASE event_type
                  WHEN 'PushEvent' THEN '"push_id":' || n || ',"ref":"refs/heads/main"' || coalesce(',"commits":[' ||
                       array_to_string(['{"sha":"' || n || '-' || i || '","message":"commit ' || i || '"}'
                                        FOR i IN range(1, commits + 1)], ',') || ']', '')
                  WHEN 'PullRequestEvent' THEN coalesce('"action":"' || action || '",', '') || '"pull_request":{"id":' || n
                       || coalesce(',"title":"' || pr_name || '"', '') || ',"user":{'
                       || coalesce('"login":"' || login || '"', '') || '}}'
                  ELSE '' END
               || '},"created_at":"' || strftime(created, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS raw_payload
        FROM typed_events""",
    # --- silver ---
    "int_push_events": """
        SELECT event_id, repo_name, fetched_at, login AS actor_username, event_id AS push_id,
               'refs/heads/main' AS commit_ref, coalesce(commits, 0) AS commit_count
        FROM typed_events WHERE event_type = 'PushEvent'""",
    "int_pull_requests": """
        SELECT event_id, repo_name, fetched_at, action AS pr_action, event_id AS pull_request_id, pr_name AS pr_title,
               login AS pr_author
        FROM typed_events WHERE event_type = 'PullRequestEvent'""",
    # --- gold: pushes and pull requests counted apart, then joined ---
    "user_pushes": """
        SELECT actor_username AS username, repo_name, CAST(fetched_at AS DATE) AS activity_date,
               count(*) AS pushes, sum(commit_count) AS commits
        FROM int_push_events GROUP BY ALL""",
    "user_requests": """
        SELECT pr_author AS username, repo_name, CAST(fetched_at AS DATE) AS activity_date, count(*) AS requests,
               count(*) FILTER (pr_action = 'opened') AS opened,
               count(*) FILTER (pr_action IN ('closed', 'merged')) AS closed,
               count(*) FILTER (pr_action = 'merged') AS merged,
               count(*) FILTER (pr_action NOT IN ('opened', 'closed', 'merged')) AS other
        FROM int_pull_requests GROUP BY ALL""",
    "fct_github_daily_activity": f"""
        SELECT md5(repo_name || '|2026-07-13') AS repo_id, repo_name, activity_date,
               {big("coalesce(p.pushes, 0)")} AS push_count, {big("coalesce(p.commits, 0)")} AS commit_count,
               coalesce({ratio("p.commits", "p.pushes")}, 0.0) AS push_avg_commits,
               {big("coalesce(r.requests, 0)")} AS pr_event_count, {big("coalesce(r.opened, 0)")} AS pr_opened,
               {big("coalesce(r.closed, 0)")} AS pr_closed, {big("coalesce(r.merged, 0)")} AS pr_merged,
               {big("coalesce(r.other, 0)")} AS pr_other_events, {percent("r.merged", "r.requests")} AS pr_merged_pct,
               {big("coalesce(p.pushes, 0) + coalesce(r.requests, 0)")} AS total_activity_count, {AS_OF} AS created_at
        FROM (SELECT repo_name, activity_date, sum(pushes) AS pushes, sum(commits) AS commits
              FROM user_pushes GROUP BY ALL) p
        FULL JOIN (SELECT repo_name, activity_date, sum(requests) AS requests, sum(opened) AS opened,
                          sum(closed) AS closed, sum(merged) AS merged, sum(other) AS other
                   FROM user_requests GROUP BY ALL) r USING (repo_name, activity_date)""",
    "fct_contributor_daily_activity": f"""
        SELECT md5(username || '|2026-07-13') AS contrib_id, md5(repo_name || '|2026-07-13') AS repo_id, username,
               repo_name, activity_date, {big("coalesce(p.pushes, 0)")} AS push_count,
               {big("coalesce(p.commits, 0)")} AS commits_in_pushes, {big("coalesce(r.requests, 0)")} AS pr_event_count,
               {big("coalesce(r.opened, 0)")} AS pr_opened, {big("coalesce(r.closed, 0)")} AS pr_closed,
               {big("coalesce(r.merged, 0)")} AS pr_merged, {big("coalesce(r.other, 0)")} AS pr_other_events,
               {big("coalesce(p.pushes, 0) + coalesce(r.requests, 0)")} AS total_activity_count,
               {percent("r.merged", "r.requests")} AS pr_merged_pct,
               CASE WHEN coalesce(p.commits, 0) > 0 AND r.requests IS NOT NULL THEN 'both'
                    WHEN coalesce(p.commits, 0) > 0 THEN 'push_only'
                    WHEN r.requests IS NOT NULL THEN 'pr_only' ELSE 'unknown' END AS contribution_type,
               {AS_OF} AS created_at
        FROM (SELECT * FROM user_pushes WHERE username IS NOT NULL) p
        FULL JOIN (SELECT * FROM user_requests WHERE username IS NOT NULL) r USING (username, repo_name, activity_date)""",
    "dim_repository": f"""
        SELECT md5(repo_name || '|2026-07-13') AS repo_id, repo_name, split_part(repo_name, '/', 1) AS owner,
               coalesce(m.language, 'Unknown') AS language, coalesce(m.stars, 0) AS stars,
               {big("coalesce(p.n, 0)")} AS total_pushes, {big("coalesce(p.c, 0)")} AS total_commits,
               {big("coalesce(r.n, 0)")} AS total_pr_events, coalesce(p.d1, r.d1) AS first_active_date,
               coalesce(p.d2, r.d2) AS last_active_date, {AS_OF} AS created_at
        FROM (SELECT repo_name, count(*) AS n, sum(commit_count) AS c, CAST(min(fetched_at) AS DATE) AS d1,
                     CAST(max(fetched_at) AS DATE) AS d2 FROM int_push_events GROUP BY ALL) p
        FULL JOIN (SELECT repo_name, count(*) AS n, CAST(min(fetched_at) AS DATE) AS d1, CAST(max(fetched_at) AS DATE) AS d2
                   FROM int_pull_requests GROUP BY ALL) r USING (repo_name)
        LEFT JOIN (VALUES ('facebook/react', 'JavaScript', 225000), ('microsoft/vscode', 'TypeScript', 165000),
                          ('vercel/next.js', 'JavaScript', 125000)) AS m(repo_name, language, stars) USING (repo_name)""",
    "dim_contributor": f"""
        SELECT md5(username || '|2026-07-13') AS contrib_id, username, {big("coalesce(p.n, 0)")} AS total_push_events,
               {big("coalesce(p.c, 0)")} AS total_commits, {big("coalesce(r.n, 0)")} AS total_pr_events,
               CASE WHEN coalesce(p.c, 0) > 0 AND r.n IS NOT NULL THEN 'both' WHEN coalesce(p.c, 0) > 0 THEN 'push_only'
                    WHEN r.n IS NOT NULL THEN 'pr_only' ELSE 'unknown' END AS contrib_type,
               coalesce(p.d1, r.d1) AS first_active_date, coalesce(p.d2, r.d2) AS last_active_date, {AS_OF} AS created_at
        FROM (SELECT actor_username AS username, count(*) AS n, sum(commit_count) AS c, CAST(min(fetched_at) AS DATE) AS d1,
                     CAST(max(fetched_at) AS DATE) AS d2
              FROM int_push_events WHERE actor_username IS NOT NULL GROUP BY ALL) p
        FULL JOIN (SELECT pr_author AS username, count(*) AS n, CAST(min(fetched_at) AS DATE) AS d1,
                          CAST(max(fetched_at) AS DATE) AS d2
                   FROM int_pull_requests WHERE pr_author IS NOT NULL GROUP BY ALL) r USING (username)""",
    # --- stories ---
    "raw_stories": """
        SELECT doc_id AS story_id,
               CASE WHEN doc_id % 7 = 0 THEN 'React vs Next.js: ' ELSE '' END
               || CASE WHEN doc_id % 13 = 0 THEN 'VS Code tips - ' ELSE '' END
               || CASE WHEN doc_id % 17 = 0 THEN 'Reactive programming ' ELSE '' END || text AS title,
               CASE WHEN doc_id % 50 <> 0 THEN source END AS author, pages.url AS url,
               CAST(n_chars % 500 AS INTEGER) AS score, 1704067200 + (doc_id * 2592) % 2592000 AS time,
               CASE WHEN doc_id % 11 <> 0 THEN CAST(n_chars % 37 AS INTEGER) END AS descendants,
               CASE WHEN doc_id % 20 = 19 THEN 'job' ELSE 'story' END AS type, TIMESTAMP '2024-02-01' AS fetched_at,
               '{' || concat_ws(',', '"id":' || story_id, '"title":' || CAST(to_json(title) AS VARCHAR), '"by":' || CAST(to_json(author) AS VARCHAR),
                   '"url":' || CAST(to_json(url) AS VARCHAR), '"score":' || score, '"time":' || time, '"descendants":' || descendants,
                   '"type":' || CAST(to_json(type) AS VARCHAR)) || '}' AS raw_json
        FROM documents LEFT JOIN pages ON doc_id = page_id""",
    "stg_hn_stories": """
        SELECT story_id, title, author, url, score, coalesce(descendants, 0) AS comment_count, type AS story_type,
               TIMESTAMP '1970-01-01' + to_seconds(time) AS published_at, fetched_at, raw_json
        FROM raw_stories""",
    "int_hn_stories": """
        SELECT story_id, title, author, url, score, comment_count, story_type, published_at, fetched_at,
               CASE WHEN url <> '' THEN regexp_replace(regexp_replace(url, '^https?://', ''), '(?s)/.*$', '') END AS url_domain,
               coalesce(url <> '', false) AS has_url, CAST(published_at AS DATE) AS activity_date
        FROM stg_hn_stories WHERE story_type = 'story' AND title IS NOT NULL""",
    "int_hn_repo_mentions": f"""
        SELECT story_id, title, author, url, score, comment_count, published_at, activity_date, fetched_at,
               v.repo AS mentioned_repo
        FROM int_hn_stories, (VALUES {_pattern_rows}) AS v(repo, pattern)
        WHERE regexp_matches(lower(title), v.pattern)""",
    "dim_hn_story": f"""
        SELECT md5(CAST(story_id AS VARCHAR) || '|2026-07-18') AS hn_story_key, *, {AS_OF} AS created_at
        FROM int_hn_stories""",
    "fct_hn_daily_activity": f"""
        SELECT activity_date, count(*) AS story_count, {big("coalesce(sum(score), 0)")} AS total_score,
               coalesce({ratio("sum(score)", "count(score)")}, 0.0) AS avg_score,
               {big("coalesce(sum(comment_count), 0)")} AS total_comments,
               coalesce({ratio("sum(comment_count)", "count(comment_count)")}, 0.0) AS avg_comments,
               count(DISTINCT author) AS unique_authors, coalesce(max(score), 0) AS top_score,
               {percent("count(*) FILTER (has_url)", "count(*)")} AS stories_with_url_pct, {AS_OF} AS created_at
        FROM int_hn_stories WHERE activity_date IS NOT NULL GROUP BY activity_date""",
    "fct_hn_repo_mentions": f"""
        SELECT mentioned_repo, activity_date, count(*) AS mention_count, {big("coalesce(sum(score), 0)")} AS total_score,
               coalesce({ratio("sum(score)", "count(score)")}, 0.0) AS avg_score,
               {big("coalesce(sum(comment_count), 0)")} AS total_comments,
               coalesce({ratio("sum(comment_count)", "count(comment_count)")}, 0.0) AS avg_comments,
               coalesce(max(score), 0) AS top_score, {AS_OF} AS created_at
        FROM int_hn_repo_mentions WHERE activity_date IS NOT NULL GROUP BY ALL""",
    # --- the two polls ---
    "first_events": "SELECT * FROM stg_github_events WHERE fetched_at < TIMESTAMP '2024-01-20'",
    "second_events": """
        SELECT event_id, repo_name, event_type, fetched_at + INTERVAL 1 DAY AS fetched_at, raw_payload
        FROM stg_github_events WHERE fetched_at >= TIMESTAMP '2024-01-10'""",
    "stored_events": """
        SELECT event_id, repo_name, event_type, fetched_at, raw_payload
        FROM (SELECT *, 1 AS poll FROM first_events UNION ALL SELECT *, 2 FROM second_events)
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY poll, fetched_at, raw_payload) = 1""",
    "first_stories": "SELECT * FROM raw_stories WHERE time < epoch(TIMESTAMP '2024-01-20')",
    "second_stories": """
        SELECT story_id, 'Edited: ' || title AS title, author, url, score + 10 AS score, time,
               CAST(NULL AS INTEGER) AS descendants, type, fetched_at + INTERVAL 1 DAY AS fetched_at
        FROM raw_stories WHERE time >= epoch(TIMESTAMP '2024-01-10')""",
    "valid_first_stories": f"SELECT * FROM first_stories WHERE {VALID}",
    "valid_second_stories": f"SELECT * FROM second_stories WHERE {VALID}",
    "stored_stories": upserted("first_stories", "second_stories"),
    "stored_valid_stories": upserted("valid_first_stories", "valid_second_stories"),
    "story_items": """
        SELECT CASE WHEN story_id % 29 = 1 THEN NULL WHEN story_id % 29 = 2 THEN 0 ELSE story_id END AS id,
               CASE WHEN story_id % 31 = 3 THEN '' WHEN story_id % 31 <> 4 THEN title END AS given_title,
               story_id % 2 = 1 AS spelled_out, author, url, time, descendants AS given_descendants,
               CASE WHEN story_id % 5 <> 2 THEN score END AS given_score,
               CASE WHEN story_id % 3 <> 1 THEN type END AS given_type
        FROM raw_stories""",
    "landed_items": f"""
        SELECT id AS story_id, coalesce(given_title, CASE WHEN spelled_out THEN NULL ELSE '' END) AS title, author, url,
               coalesce(given_score, CASE WHEN spelled_out THEN NULL ELSE 0 END) AS score, time,
               coalesce(given_descendants, CASE WHEN spelled_out THEN NULL ELSE 0 END) AS descendants,
               coalesce(given_type, CASE WHEN spelled_out THEN NULL ELSE 'story' END) AS type, {AS_OF} AS fetched_at
        FROM story_items""",
}


def with_datasets(body: str, changed: dict[str, str] | None = None) -> str:
    """Prefix a statement with the definitions it uses, in order. `changed` replaces some: `{}` stands for the usual one."""
    datasets = DATASETS | {name: sql.replace("{}", f"({DATASETS[name]})") for name, sql in (changed or {}).items()}
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", sql)):
            if word in datasets and word not in needed:
                visit(datasets[word])
                needed[word] = None

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({datasets[name].strip()})" for name in needed)
    return f"WITH {parts}\n{body.strip()}"
