"""One SQL statement per registered query."""

from __future__ import annotations

import datetime as dt

from oracle.datasets import AS_OF, big, mean_of_percents, percent, ratio, with_datasets

REPO, USER = "'facebook/react'", "'user_8'"
RANGE = "activity_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"
CODE_GOLD = ("dim_repository", "dim_contributor", "fct_github_daily_activity", "fct_contributor_daily_activity")
STORY_GOLD = ("dim_hn_story", "fct_hn_daily_activity", "fct_hn_repo_mentions")
VIEWS = ("stg_github_events", "int_push_events", "int_pull_requests", "stg_hn_stories", "int_hn_stories",
         "int_hn_repo_mentions")


def total(column: str) -> str:
    return f"{big(f'coalesce(sum({column}), 0)')} AS {column}"


def summed(column: str, name: str | None = None) -> str:
    return f"{big(f'sum({column})')} AS {name or column}"


def minutes(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start}))"


def _stats(tables) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, max(created_at) AS last_updated FROM {t}" for t in tables)


def _lifecycle(raw: str, fact: str, tables) -> str:
    built = " UNION ALL ".join(f"SELECT max(created_at) AS t FROM {t}" for t in tables)
    return f"""SELECT (SELECT max(fetched_at) FROM {raw}) AS last_ingested,
        coalesce(CAST((SELECT max(activity_date) FROM {fact}) AS VARCHAR), 'Unknown') AS data_coverage_date,
        (SELECT max(t) FROM ({built})) AS gold_built_at"""


def _leaderboard(rows: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY total_activity DESC, username) AS rank, * FROM ({rows})"


_ALL_USERS = """SELECT username, contrib_type, total_push_events + total_pr_events AS total_activity, total_push_events,
    total_pr_events FROM dim_contributor"""
_REPO_USERS = f"""SELECT f.username, d.contrib_type, {summed('f.total_activity_count', 'total_activity')},
    {summed('f.push_count', 'total_push_events')}, {summed('f.pr_event_count', 'total_pr_events')}
    FROM fct_contributor_daily_activity f JOIN dim_contributor d ON f.username = d.username
    WHERE f.repo_name = {REPO} %s GROUP BY f.username, d.contrib_type"""
_STORY = "story_id, title, author, url, score, comment_count, published_at"
_DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
_USER_COMMITS = """SELECT repo_name, username, sum(commits_in_pushes) AS commits,
    row_number() OVER (PARTITION BY repo_name ORDER BY sum(commits_in_pushes) DESC, username) AS place,
    sum(sum(commits_in_pushes)) OVER (PARTITION BY repo_name) AS whole
    FROM fct_contributor_daily_activity GROUP BY repo_name, username"""


def _reports() -> dict[str, str]:
    rd, ud, rf, uf = CODE_GOLD
    sd, sf, mf = STORY_GOLD
    q: dict[str, str] = {}
    for name in VIEWS + CODE_GOLD + STORY_GOLD:
        q[name] = f"SELECT * FROM {name}"
    q["fact_with_dimension_keys"] = f"""SELECT f.username, f.repo_name, f.activity_date, d.contrib_id, r.repo_id FROM {uf} f
        LEFT JOIN {ud} d ON f.username = d.username LEFT JOIN {rd} r ON f.repo_name = r.repo_name"""
    q["mentions_from_silver"] = q["int_hn_repo_mentions"]

    q["platform_kpis"] = f"""SELECT {total('total_commits')}, {total('total_pushes')}, {total('total_pr_events')},
        count(repo_name) AS repo_count FROM {rd}"""
    daily = f"""SELECT activity_date, {summed('commit_count')}, {summed('pr_event_count')}, {summed('push_count')},
        {summed('total_activity_count')} FROM {rf} WHERE {RANGE} GROUP BY activity_date"""
    q["daily_activity_all_repos"] = daily
    q["default_window_report"] = daily.replace(RANGE, "activity_date BETWEEN DATE '2024-02-01' - 30 AND DATE '2024-02-01'")
    q["formatted_totals"] = f"""SELECT repo_name, format('{{:,}}', total_commits) AS total_commits,
        format('{{:,}}', total_pr_events) AS total_pr_events FROM {rd}"""
    q["nonzero_measures"] = f"""SELECT username, {summed('push_count')}, {summed('pr_event_count')} FROM {uf} GROUP BY username"""
    q["mentions_custom_patterns"] = """SELECT story_id, 'facebook/react' AS mentioned_repo FROM int_hn_stories
        WHERE regexp_matches(lower(title), '(?:^|[\\s\\-\\.,;:!?\\(/"''])(?:react|the|and)(?:$|[\\s\\-\\.,;:!?\\)/"''])')"""
    q["repo_comparison"] = f"SELECT repo_name, total_commits, total_pushes, total_pr_events, stars FROM {rd}"
    q["event_distribution"] = f"SELECT activity_date, push_count, pr_event_count FROM ({daily})"
    q["repository_list"] = f"SELECT repo_name FROM {rd}"
    q["repo_kpis"] = f"SELECT * EXCLUDE (repo_id, created_at) FROM {rd} WHERE repo_name = {REPO}"
    q["repo_daily_activity"] = f"""SELECT strftime(activity_date, '%Y-%m-%d') AS activity_date, commit_count, push_count,
        push_avg_commits, pr_event_count, pr_opened, pr_merged, pr_closed, pr_merged_pct, total_activity_count
        FROM {rf} f WHERE repo_name = {REPO} AND f.{RANGE}"""
    q["repo_summary"] = f"""SELECT repo_name, {summed('commit_count', 'total_commits')}, {summed('push_count', 'total_pushes')},
        {summed('pr_event_count', 'total_pr_events')}, {summed('pr_merged')},
        {mean_of_percents('pr_merged_pct')} AS avg_merge_rate_pct FROM {rf} WHERE {RANGE} GROUP BY repo_name"""
    q["activity_metric_fallback"] = f"""SELECT activity_date, CASE WHEN t.c > 0 THEN 'commit_count' ELSE 'push_count' END
        AS metric_name, CASE WHEN t.c > 0 THEN commit_count ELSE push_count END AS metric_value
        FROM ({daily}), (SELECT sum(total_commits) AS c FROM {rd}) t"""
    q["pr_performance_summary"] = f"""SELECT {big('coalesce(sum(pr_opened), 0)')} AS total_opened,
        {big('coalesce(sum(pr_merged), 0)')} AS total_merged,
        coalesce({percent('sum(pr_merged)', 'sum(pr_opened)', 1)}, 0.0) AS merge_rate_pct
        FROM {rf} WHERE repo_name = {REPO} AND {RANGE}"""
    q["repo_scorecard"] = f"""SELECT repo_name, owner, language, stars, total_pushes, total_commits, total_pr_events,
        last_active_date FROM {rd}"""
    q["daily_trend_90d"] = f"""SELECT activity_date, repo_name, commit_count, pr_event_count, pr_merged_pct,
        total_activity_count, pr_merged FROM {rf} WHERE activity_date >= DATE '2024-02-01' - 90"""
    q["last_7_days"] = f"""SELECT * EXCLUDE (repo_id, created_at) FROM {rf} WHERE activity_date >= DATE '2024-02-01' - 7"""

    q["contributor_leaderboard_all"] = _leaderboard(_ALL_USERS)
    q["contributor_leaderboard_type"] = _leaderboard(_ALL_USERS + " WHERE contrib_type = 'both'")
    q["contributor_leaderboard_repo"] = _leaderboard(_REPO_USERS % "")
    q["contributor_leaderboard_repo_type"] = _leaderboard(_REPO_USERS % "AND d.contrib_type = 'pr_only'")
    q["unique_contributors_sketched"] = f"""SELECT repo_name, count(DISTINCT username) AS contributors, true AS within_bound
        FROM {uf} WHERE {RANGE} GROUP BY repo_name"""
    types = f"SELECT contrib_type, count(*) AS contributor_count FROM {ud} GROUP BY contrib_type"
    q["contrib_type_distribution"] = types
    q["contrib_type_labels"] = f"""SELECT CASE WHEN contrib_type = 'unknown' THEN 'Unclassified' ELSE contrib_type END
        AS contrib_type, contributor_count FROM ({types})"""
    top = f"""SELECT username, {summed('total_activity_count')} FROM {uf} %s GROUP BY username
        ORDER BY total_activity_count DESC NULLS FIRST, username LIMIT 10"""
    q["top_contributors_all"] = top % ""
    q["top_contributors_repo"] = top % f"WHERE repo_name = {REPO}"
    q["contributor_list"] = f"SELECT username FROM {ud}"
    q["contributor_profile"] = f"""SELECT username, contrib_type, total_push_events, total_pr_events, first_active_date,
        last_active_date FROM {ud} WHERE username = {USER}"""
    q["contributor_timeline"] = f"""SELECT strftime(activity_date, '%Y-%m-%d') AS activity_date, repo_name, push_count,
        pr_event_count, pr_opened, pr_merged, pr_merged_pct, contribution_type, total_activity_count
        FROM {uf} f WHERE username = {USER} AND f.{RANGE}"""
    q["contributor_repo_participation"] = f"""SELECT repo_name, {summed('push_count', 'total_pushes')},
        {summed('pr_event_count', 'total_pr_events')}, {summed('pr_merged')},
        {mean_of_percents('pr_merged_pct')} AS avg_merge_rate_pct FROM {uf} WHERE username = {USER} GROUP BY repo_name"""
    q["leaderboard_headline"] = f"""SELECT count(*) AS total_contributors,
        coalesce((SELECT username FROM ({_ALL_USERS}) ORDER BY total_activity DESC, username LIMIT 1), '—') AS top_contributor,
        coalesce({ratio('sum(total_activity)', 'count(total_activity)', 1)}, 0.0) AS avg_activity FROM ({_ALL_USERS})"""
    q["contributor_summary"] = f"""SELECT greatest(count(DISTINCT repo_name), 1) AS repositories,
        count(DISTINCT activity_date) FILTER ({RANGE}) AS active_days, {total('pr_merged')} FROM {uf} WHERE username = {USER}"""
    days = ", ".join(
        f"""{big(f"coalesce(sum(total_activity_count) FILTER (activity_date = DATE '{d}'), 0)")} AS "{d}" """ for d in _DAYS)
    q["activity_matrix"] = f"SELECT username, {days} FROM {uf} WHERE {RANGE} GROUP BY username"
    q["top20_by_commits"] = f"""SELECT username, contrib_type, total_push_events, total_commits, total_pr_events,
        first_active_date, last_active_date FROM {ud} ORDER BY total_commits DESC NULLS FIRST, username LIMIT 20"""
    q["contributor_detail"] = f"""SELECT repo_name, count(*) AS days_active, {summed('push_count', 'total_pushes')},
        {summed('commits_in_pushes', 'total_commits')}, {summed('pr_event_count', 'total_pr_events')},
        {mean_of_percents('pr_merged_pct')} AS avg_pr_merge_rate FROM {uf} WHERE username = {USER} GROUP BY repo_name"""
    q["contributor_heatmap"] = f"""SELECT a.*, b.contribution_type AS primary_contribution_type FROM
        (SELECT username, repo_name, {summed('push_count', 'total_pushes')}, {summed('commits_in_pushes', 'total_commits')},
                {summed('pr_event_count', 'total_pr_events')}, {summed('total_activity_count', 'total_activity')},
                count(DISTINCT activity_date) AS days_active FROM {uf} GROUP BY username, repo_name) a
        JOIN (SELECT * FROM (
                SELECT username, repo_name, contribution_type, row_number() OVER
                    (PARTITION BY username, repo_name ORDER BY count(*) DESC, contribution_type) AS place
                FROM {uf} GROUP BY username, repo_name, contribution_type) WHERE place = 1) b
        USING (username, repo_name)"""
    q["weekly_activity"] = f"""SELECT username, repo_name, CAST(date_trunc('week', activity_date) AS DATE) AS week_start,
        {summed('total_activity_count', 'weekly_activity')} FROM {uf} GROUP BY ALL"""
    q["contribution_share"] = f"""SELECT repo_name, CASE WHEN place <= 5 THEN username ELSE 'Others' END AS contributor_group,
        {summed('commits')} FROM ({_USER_COMMITS}) GROUP BY ALL"""
    q["contribution_concentration"] = f"""SELECT repo_name, max(pct) AS top_contributor_pct,
        CAST(sum(CAST(round(pct * 100) AS BIGINT)) FILTER (place <= 5) AS DOUBLE) / 100.0 AS top_5_pct,
        CASE WHEN max(pct) > 50 THEN 'High Risk - Bottleneck' WHEN max(pct) > 30 THEN 'Medium Risk'
             ELSE 'Healthy - Distributed' END AS diversity_assessment
        FROM (SELECT *, {percent('commits', 'whole')} AS pct FROM ({_USER_COMMITS})) GROUP BY repo_name"""
    q["contributor_account_class"] = f"""SELECT username,
        CASE WHEN ends_with(username, '[bot]') THEN 'Bot' ELSE 'User' END AS account_class FROM {ud}"""
    q["commits_of_contributor"] = f"""SELECT {big('coalesce(sum(commits_in_pushes), 0)')} AS commits FROM {uf}
        WHERE contrib_id = (SELECT contrib_id FROM {ud} WHERE username = {USER})"""

    q["hn_platform_kpis"] = f"""SELECT count(story_id) AS total_stories,
        coalesce({ratio('sum(score)', 'count(score)', 1)}, 0.0) AS avg_score, count(DISTINCT author) AS unique_authors,
        {big('coalesce(sum(comment_count), 0)')} AS total_comments FROM {sd}"""
    q["hn_daily_activity"] = f"SELECT * EXCLUDE (created_at) FROM {sf} WHERE {RANGE}"
    q["hn_trending_stories"] = f"""SELECT {_STORY} FROM {sd}
        ORDER BY score DESC NULLS FIRST, comment_count DESC NULLS FIRST, story_id LIMIT 10"""
    q["hn_top_authors"] = f"""SELECT author, count(story_id) AS story_count, {summed('score', 'total_score')} FROM {sd}
        WHERE author IS NOT NULL GROUP BY author ORDER BY story_count DESC, total_score DESC NULLS FIRST, author LIMIT 10"""
    q["hn_repo_mentions_daily"] = f"SELECT * EXCLUDE (created_at) FROM {mf} WHERE {RANGE}"
    summary = f"""SELECT mentioned_repo, {summed('mention_count', 'total_mentions')}, {summed('total_score')},
        {summed('total_comments')} FROM {mf} %s GROUP BY mentioned_repo"""
    q["hn_mention_summary_all"] = summary % ""
    q["hn_mention_summary_range"] = summary % "WHERE activity_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'"
    q["hn_recent_stories"] = f"SELECT {_STORY} FROM {sd} ORDER BY published_at DESC NULLS FIRST, story_id LIMIT 10"
    q["hn_repo_stories"] = f"""SELECT {_STORY} FROM int_hn_repo_mentions WHERE mentioned_repo = {REPO}
        ORDER BY published_at DESC NULLS FIRST, story_id LIMIT 5"""
    over_time = f"""SELECT activity_date, mention_count, total_score, total_comments FROM {mf}
        WHERE mentioned_repo = {REPO} AND {RANGE}"""
    q["hn_mentions_over_time"] = over_time
    q["hn_repo_period_totals"] = f"""SELECT {big('coalesce(sum(mention_count), 0)')} AS total_mentions, {total('total_score')},
        {total('total_comments')}, count(*) >= 4 AS show_trend FROM ({over_time})"""

    q["data_freshness"] = f"SELECT table_name, last_updated FROM ({_stats(CODE_GOLD)})"
    q["gold_table_stats"] = _stats(CODE_GOLD)
    q["github_lifecycle"] = _lifecycle("stg_github_events", rf, CODE_GOLD)
    q["freshness_summary"] = f"""SELECT (SELECT max(last_updated) FROM ({_stats(CODE_GOLD)})) AS gold_refresh_time,
        coalesce(CAST((SELECT max(last_active_date) FROM {rd}) AS VARCHAR), 'Unknown') AS data_coverage_date"""
    q["data_coverage"] = f"""SELECT repo_name, first_active_date, last_active_date,
        CAST(last_active_date - first_active_date AS INTEGER) AS days_covered FROM {rd}"""
    q["last_ingestion_date"] = f"SELECT coalesce(CAST(max(activity_date) AS VARCHAR), 'Unknown') AS last_ingestion_date FROM {rf}"
    q["contributor_count"] = f"SELECT count(*) AS contributor_count FROM {ud}"
    q["hn_gold_table_stats"] = _stats(STORY_GOLD)
    q["hn_lifecycle"] = _lifecycle("stg_hn_stories", sf, STORY_GOLD)
    q["hn_data_coverage"] = f"""SELECT 'Hacker News Top Stories' AS source_name, min(activity_date) AS first_active_date,
        max(activity_date) AS last_active_date, CAST(max(activity_date) - min(activity_date) AS INTEGER) AS days_covered FROM {sf}"""
    q["gold_table_health"] = f"""SELECT table_name, row_count,
        {ratio(minutes('last_updated', "TIMESTAMP '2024-02-02 06:00:00'"), '3600000000', 1)} AS age_hours,
        CASE WHEN row_count > 0 THEN 'Healthy' ELSE 'Empty' END AS status FROM ({_stats(CODE_GOLD + STORY_GOLD)})"""
    q["warehouse_totals"] = f"""SELECT count(*) AS total_tables, {summed('row_count', 'total_rows')},
        max(row_count) FILTER (table_name = 'dim_contributor') AS contributors FROM ({_stats(CODE_GOLD + STORY_GOLD)})"""
    q["freshness_badge"] = f"""SELECT source, last_ingested, {ratio('gap', '3600000000', 1)} AS age_hours,
        CASE WHEN gap >= 3600000000 THEN (gap // 3600000000) || 'h ' ELSE '' END || (gap % 3600000000 // 60000000) || 'm' AS age_text,
        CASE WHEN {ratio('gap', '3600000000', 1)} <= 24 THEN 'fresh' WHEN {ratio('gap', '3600000000', 1)} <= 48 THEN 'stale'
             ELSE 'error' END AS freshness
        FROM (SELECT *, {minutes('last_ingested', AS_OF)} AS gap FROM (
            SELECT 'github' AS source, max(fetched_at) AS last_ingested FROM stg_github_events
            UNION ALL SELECT 'hackernews', max(fetched_at) FROM stg_hn_stories))"""

    ev = "stg_github_events"
    q["raw_overview"] = f"""SELECT count(*) AS total_events, count(DISTINCT repo_name) AS repo_count,
        count(DISTINCT event_type) AS event_type_count FROM {ev}"""
    q["raw_events_by_repo"] = f"SELECT repo_name, count(*) AS event_count FROM {ev} GROUP BY repo_name"
    q["raw_top_event_types"] = f"""SELECT event_type, count(*) AS event_count,
        {percent('count(*)', f'(SELECT count(*) FROM {ev})', 1)} AS pct_of_total
        FROM {ev} GROUP BY event_type ORDER BY event_count DESC, event_type LIMIT 10"""
    counts = f"""SELECT count(*) AS total_events, count(*) FILTER (event_id IS NULL) AS null_event_ids,
        count(*) FILTER (raw_payload IS NULL) AS null_payloads,
        (SELECT count(*) FROM (SELECT event_id FROM {ev} GROUP BY event_id HAVING count(*) > 1)) AS duplicate_event_ids FROM {ev}"""
    q["raw_quality_counts"] = counts
    q["raw_freshness"] = f"""SELECT minutes_ago, CASE WHEN minutes_ago < 60 THEN 'PASS' ELSE 'OLD' END AS status
        FROM (SELECT CAST({minutes('max(fetched_at)', AS_OF)} AS DOUBLE) / 6e7 AS minutes_ago FROM {ev})"""
    q["raw_latest_events"] = f"""SELECT repo_name, event_type, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched FROM
        (SELECT * FROM {ev} ORDER BY fetched_at DESC NULLS FIRST, event_id LIMIT 3)"""
    q["raw_verdict"] = f"""SELECT *, CASE WHEN total_events = 0 THEN 'FAILED'
        WHEN null_event_ids = 0 AND null_payloads = 0 AND duplicate_event_ids = 0 THEN 'SUCCESSFUL'
        ELSE 'WARNINGS' END AS verdict FROM ({counts})"""
    q["raw_last_ingested_by_repo"] = f"""SELECT repo_name, max(fetched_at) AS last_ingested, count(*) AS event_count
        FROM {ev} GROUP BY repo_name"""
    q["raw_json_preview"] = f"""SELECT event_id, json_extract_string(raw_payload, '$.type') AS event_type,
        json_extract_string(raw_payload, '$.actor.login') AS username, json_extract_string(raw_payload, '$.repo.name') AS repo
        FROM {ev} ORDER BY event_id LIMIT 5"""
    q["event_document_fields"] = """SELECT event_id, CAST(NULL AS INTEGER) AS payload_size,
        CASE WHEN event_type = 'PushEvent' AND commits > 0 THEN 'commit 1' END AS first_commit_message,
        created AS created_at FROM typed_events"""
    q["daily_unique_contributors"] = f"""SELECT CAST(created AS DATE) AS activity_date, repo_name, count(*) AS total_push_events,
        {big('sum(coalesce(commits, 0))')} AS total_commits, count(DISTINCT login) AS unique_contributors
        FROM typed_events WHERE event_type = 'PushEvent' GROUP BY ALL"""
    q["repository_name_check"] = f"""SELECT repo_name, count(*) AS event_count,
        coalesce(regexp_full_match(repo_name, '[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+'), false) AS well_formed FROM {ev} GROUP BY repo_name"""
    return q


def _checks() -> dict[str, str]:
    q: dict[str, str] = {}
    both = """SELECT 'int_push_events' AS model_name, event_id, repo_name, fetched_at FROM int_push_events
        UNION ALL SELECT 'int_pull_requests', event_id, repo_name, fetched_at FROM int_pull_requests"""

    def future(now: str) -> str:
        return f"""SELECT *, {now} AS "current_time", epoch_us(fetched_at) - epoch_us({now}) AS time_difference_us
            FROM ({both}) WHERE fetched_at > {now}"""

    q["dq_no_future_timestamps"] = future(AS_OF)
    q["dq_no_future_timestamps_found"] = future("TIMESTAMP '2024-01-16 00:00:00'")
    negative = "SELECT event_id, repo_name, commit_count - {d} AS commit_count, fetched_at FROM int_push_events WHERE commit_count < {d}"
    q["dq_no_negative_commit_count"] = negative.format(d=0)
    q["dq_no_negative_commit_count_found"] = negative.format(d=3)
    q["dq_push_model_integrity"] = """SELECT p.event_id, p.repo_name, e.event_type FROM int_push_events p
        JOIN (SELECT DISTINCT event_id, event_type FROM stg_github_events) e ON p.event_id = e.event_id
        WHERE e.event_type <> 'PushEvent'"""
    q["dq_push_model_integrity_found"] = """SELECT event_id, repo_name, event_type FROM stg_github_events
        WHERE event_type <> 'PushEvent'"""

    # declared checks, spelled out per table
    from oracle import declared

    q.update(declared.statements())
    return q


def _ingestion() -> dict[str, str]:
    q: dict[str, str] = {}
    story = "story_id, title, author, url, score, time, descendants, type, fetched_at, raw_score"
    q["landed_event_pages"] = f"SELECT event_id, repo_name, event_type, {AS_OF} AS fetched_at, raw_payload FROM stg_github_events"
    n = "CAST(event_id AS BIGINT)"
    q["landed_mixed_answers"] = f"""SELECT event_id, repo_name, event_type, {AS_OF} AS fetched_at FROM stg_github_events
        WHERE {n} % 20 NOT IN (0, 1)"""
    q["ingest_event_rejects"] = f"""SELECT 'unreadable answer' AS reject_reason,
        '{{"repo_name":"' || repo_name || '","events":[' || substr(raw_payload, 1, 20) AS body FROM stg_github_events WHERE {n} % 20 = 0
        UNION ALL SELECT 'missing id', '{{"type":"PushEvent"}}' FROM stg_github_events WHERE {n} % 20 = 1"""
    q["ingest_story_defaults"] = "SELECT * FROM landed_items WHERE story_id <> 0 AND title <> ''"
    q["ingest_rejects"] = """SELECT story_id, title, CASE WHEN story_id IS NULL OR story_id = 0 THEN 'missing id'
        ELSE 'missing title' END AS reject_reason FROM landed_items
        WHERE story_id IS NULL OR story_id = 0 OR title IS NULL OR title = ''"""
    q["ranked_story_cap"] = "SELECT story_id, score FROM raw_stories ORDER BY score DESC NULLS LAST, story_id LIMIT 50"
    q["ingest_insert_if_absent"] = "SELECT * FROM stored_events"
    q["stream_events_first_wins"] = "SELECT * EXCLUDE (raw_payload) FROM stored_events"
    q["stream_events_within_watermark"] = "SELECT DISTINCT event_id, repo_name, event_type FROM stored_events"
    loads = f"""
        SELECT 1 AS load, count(*) AS received, count(DISTINCT event_id) AS inserted FROM first_events
        UNION ALL SELECT 2, count(*), count(DISTINCT event_id) FILTER (event_id NOT IN (SELECT event_id FROM first_events))
        FROM second_events
        UNION ALL SELECT 3, count(*), 0 FROM second_events"""
    q["ingest_load_stats"] = f"""SELECT load, received, inserted, received - inserted AS duplicates, CAST(0 AS BIGINT) AS errors,
        coalesce({percent('inserted', 'received', 1)}, 0.0) AS success_rate_pct FROM ({loads})"""
    def known(rows: str) -> str:
        return f"(SELECT repo_name, CASE WHEN {n} % 97 <> 0 THEN event_id END AS event_id FROM {rows})"

    per_repository = f"""
        SELECT 1 AS load, repo_name, count(*) AS received, count(DISTINCT event_id) AS inserted, count(*) - count(event_id) AS errors
        FROM {known('first_events')} GROUP BY repo_name
        UNION ALL SELECT 2, repo_name, count(*), count(DISTINCT event_id) FILTER (event_id NOT IN (SELECT event_id FROM first_events)),
        count(*) - count(event_id) FROM {known('second_events')} GROUP BY repo_name
        UNION ALL SELECT 3, repo_name, count(*), 0, count(*) - count(event_id) FROM {known('second_events')} GROUP BY repo_name"""
    q["ingest_load_stats_by_repository"] = f"""SELECT *, received - inserted - errors AS duplicates,
        coalesce({percent('inserted', 'received', 1)}, 0.0) AS success_rate_pct FROM ({per_repository})"""
    q["stream_load_stats"] = f"""SELECT repo_name, {big('count(*)')} AS received, count(DISTINCT event_id) AS inserted,
        count(*) - count(DISTINCT event_id) AS duplicates, CAST(0 AS BIGINT) AS errors
        FROM (SELECT * FROM first_events UNION ALL SELECT * FROM second_events) GROUP BY repo_name"""
    q["stream_late_rows"] = """SELECT CAST(fetched_at AS DATE) AS activity_date, late, count(*) AS event_count FROM (
        SELECT fetched_at, false AS late FROM first_events
        UNION ALL SELECT fetched_at, fetched_at < (SELECT max(fetched_at) FROM first_events) - INTERVAL 5 DAY FROM second_events)
        GROUP BY ALL"""
    arrived = " UNION ALL ".join(f"""SELECT CAST({k} AS BIGINT) AS load, count(*) AS received,
        count(*) FILTER (story_id % 29 <> 1 AND story_id <> 0 AND story_id % 31 <> 3 AND title <> '') AS stored,
        count(*) FILTER (story_id % 29 = 1 OR story_id = 0) AS missing_id,
        count(*) FILTER (story_id % 29 <> 1 AND story_id <> 0 AND NOT coalesce(story_id % 31 <> 3 AND title <> '', false)) AS missing_title
        FROM {poll}""" for k, poll in enumerate(("first_stories", "second_stories")))
    q["ingest_story_load_stats"] = arrived
    for name in ("ingest_upsert_stories", "ingest_upsert_compacted", "ingest_upsert_folded"):
        q[name] = f"SELECT {story} FROM stored_valid_stories"
    q["stream_stories_upsert"] = f"SELECT {story} FROM stored_valid_stories"
    q["ingest_upsert_stats"] = """SELECT 1 AS load, count(DISTINCT story_id) AS inserted, CAST(0 AS BIGINT) AS updated FROM first_stories
        UNION ALL SELECT 2, count(DISTINCT story_id) FILTER (story_id NOT IN (SELECT story_id FROM first_stories)),
        count(DISTINCT story_id) FILTER (story_id IN (SELECT story_id FROM first_stories)) FROM second_stories"""
    # a day is given out once the watermark, one day behind the newest event, has passed its end
    q["stream_daily_counts"] = """SELECT activity_date, repo_name, count(*) AS event_count
        FROM (SELECT CAST(fetched_at AS DATE) AS activity_date, repo_name, max(fetched_at) OVER () AS newest
              FROM stg_github_events)
        WHERE activity_date + INTERVAL 1 DAY <= newest - INTERVAL 1 DAY GROUP BY activity_date, repo_name"""
    q["namespace_tables"] = """SELECT 'full' AS namespace, repo_name, stars FROM dim_repository
        UNION ALL SELECT 'one', repo_name, CASE WHEN repo_name = 'facebook/react' THEN stars ELSE 0 END FROM dim_repository"""
    q["published_report"] = "SELECT repo_name, total_commits, total_pr_events FROM dim_repository"
    q["incremental_fact_refresh"] = "SELECT * FROM fct_github_daily_activity"
    snapshot = """SELECT repo_name, {r} AS total_pushes, {c} AS total_commits, {p} AS total_pr_events
        FROM fct_github_daily_activity WHERE activity_date < DATE '{d}' GROUP BY repo_name"""
    looks = {n: snapshot.format(r=big("sum(push_count)"), c=big("sum(commit_count)"), p=big("sum(pr_event_count)"), d=d)
             for n, d in (("a", "2024-01-16"), ("b", "2024-02-01"))}
    first, second = "TIMESTAMP '2024-01-16'", AS_OF
    changed = "(a.total_pushes, a.total_commits, a.total_pr_events) IS DISTINCT FROM (b.total_pushes, b.total_commits, b.total_pr_events)"
    q["repository_history"] = f"""SELECT v.*, d.language, d.stars FROM (
        SELECT a.*, {first} AS valid_from, CASE WHEN b.repo_name IS NOT NULL AND {changed} THEN {second} END AS valid_to,
               NOT (b.repo_name IS NOT NULL AND {changed}) AS is_current
        FROM ({looks['a']}) a LEFT JOIN ({looks['b']}) b ON a.repo_name = b.repo_name
        UNION ALL
        SELECT b.*, {second}, CAST(NULL AS TIMESTAMP), true
        FROM ({looks['b']}) b LEFT JOIN ({looks['a']}) a ON a.repo_name = b.repo_name
        WHERE a.repo_name IS NULL OR {changed}) v JOIN dim_repository d ON v.repo_name = d.repo_name"""
    q["repository_history_stored"] = q["repository_history"]
    q["packed_fact_days"] = "SELECT * FROM fct_contributor_daily_activity"
    q["incremental_contributor_refresh"] = "SELECT * FROM fct_contributor_daily_activity"
    q["incremental_dimension_refresh"] = "SELECT * FROM dim_contributor"
    q["csv_export"] = "SELECT * EXCLUDE (created_at) FROM dim_repository"
    q["sql_over_views"] = f"""SELECT f.repo_name, d.contrib_type, count(DISTINCT f.username) AS users,
        {big('sum(f.total_activity_count)')} AS activity FROM fct_contributor_daily_activity f
        JOIN dim_contributor d ON f.username = d.username WHERE f.{RANGE} GROUP BY ALL"""
    return q


def _quarantine() -> dict[str, str]:
    """Rows with defects: an unknown repository, no document, a day far ahead; stories without title or time."""
    active = "event_type IN ('PushEvent', 'PullRequestEvent')"
    request = "event_type = 'PullRequestEvent'"
    faults = {
        "github_events_raw.raw_payload: not_null": "n % 53 = 5",
        "int_pull_requests.pr_action: not_null": f"{request} AND (action IS NULL OR n % 53 = 5)",
        "int_pull_requests.pull_request_id: not_null": f"{request} AND n % 53 = 5",
        "repo_name: accepted_values": f"{active} AND n % 50 = 3",
        "fetched_at: no_future_timestamps": f"{active} AND n % 59 = 7",
    }
    missing = {
        "hn_stories_raw.title: not_null": "story_id % 40 = 2",
        "hn_stories_raw.time: not_null": "story_id % 41 = 3",
        "int_hn_stories.activity_date: not_null": "story_id % 41 = 3 AND type = 'story' AND story_id % 40 <> 2",
        "int_hn_stories.published_at: not_null": "story_id % 41 = 3 AND type = 'story' AND story_id % 40 <> 2",
    }

    def listed(rules: dict[str, str]) -> str:
        return "concat_ws('; ', " + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in rules.items()) + ")"

    return {
        "quarantined_events": with_datasets(f"SELECT * FROM (SELECT event_id, {listed(faults)} AS faults FROM typed_events) WHERE faults <> ''"),
        "quarantined_stories": with_datasets(f"SELECT * FROM (SELECT story_id, {listed(missing)} AS faults FROM raw_stories) WHERE faults <> ''"),
        "published_repository_facts": with_datasets(
            "SELECT * FROM fct_github_daily_activity", {"typed_events": f"SELECT * FROM {{}} WHERE {listed(faults)} = ''"}),
    }


def statements() -> dict[str, str]:
    from oracle import declared

    every = {**_reports(), **_checks(), **_ingestion()}
    return {name: with_datasets(sql) for name, sql in every.items()} | _quarantine() | declared.planted_statements()
