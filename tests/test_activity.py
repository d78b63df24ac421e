"""Counting rules on small literal frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from devsignals import params, schemas
from devsignals.operators import activity
from devsignals.plans.catalog import repository_metadata

AS_OF = params.AS_OF
DAY1, DAY2 = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 12)


def push(n, user="ann", commits=(), when=DAY1, repo="facebook/react"):
    body = {"push_id": n, "ref": "refs/heads/main"}
    if commits is not None:
        body["commits"] = commits
    return (str(n), repo, "PushEvent", when, json.dumps({"actor": {"login": user} if user else {}, "payload": body}))


def request(n, user="ann", action="opened", when=DAY1, repo="facebook/react"):
    body = {"action": action, "pull_request": {"id": n, "title": "t", "user": {"login": user} if user else {}}}
    return (str(n), repo, "PullRequestEvent", when, json.dumps({"payload": body}))


def events(spark, *rows):
    return activity.stg_events(spark.createDataFrame(list(rows), schemas.EVENTS_RAW))


def facts(spark, *rows):
    base = activity.activity_base(events(spark, *rows))
    return activity.repository_facts(base, AS_OF), activity.contributor_facts(base, AS_OF)


@pytest.mark.parametrize("commits", [{}, None, [], "text", 3])
def test_commit_list_that_is_none_counts_zero(spark, commits):
    row = activity.push_events(events(spark, push(1, commits=commits))).first()
    assert (row.commit_count, row.push_id, row.actor_username) == (0, "1", "ann")


def test_null_commits_and_long_numbers(spark):
    payload = '{"actor":{"login":"ann"},"payload":{"push_id":12345678901234567890123,"commits":null,"ref":null}}'
    raw = ("1", "facebook/react", "PushEvent", DAY1, payload)
    row = activity.push_events(events(spark, raw)).first()
    assert (row.push_id, row.commit_count, row.commit_ref) == ("12345678901234567890123", 0, None)


def test_broken_document_is_kept_with_empty_fields(spark):
    raw = ("1", "facebook/react", "PushEvent", DAY1, '{"actor": {"login": "a')
    row = activity.push_events(events(spark, raw)).first()
    assert (row.event_id, row.commit_count) == ("1", 0)


def test_first_date_is_that_of_pushes_when_there_are_any(spark):
    repo, _ = facts(spark, push(1, when=DAY2), request(2, when=DAY1))
    dim = activity.repository_dimension(repo, repository_metadata(spark, params.TRACKED_REPOSITORIES), AS_OF).first()
    assert dim.first_active_date == DAY2.date() == dim.last_active_date
    only_requests, _ = facts(spark, request(2, when=DAY1))
    dim = activity.repository_dimension(only_requests, repository_metadata(spark, params.TRACKED_REPOSITORIES), AS_OF)
    assert dim.first().first_active_date == DAY1.date()


@pytest.mark.parametrize("rows, kind", [
    ([push(1)], "unknown"),
    ([push(1), request(2)], "pr_only"),
    ([push(1, commits=[{}])], "push_only"),
    ([push(1, commits=[{}]), request(2)], "both"),
    ([request(2)], "pr_only"),
])
def test_contributor_type(spark, rows, kind):
    _, users = facts(spark, *rows)
    assert users.first().contribution_type == kind
    assert activity.contributor_dimension(users, AS_OF).first().contrib_type == kind


def test_unknown_action_is_an_event_in_no_group(spark):
    row = facts(spark, request(1, action=None), request(2, action="merged"), request(3, action="labeled"))[0].first()
    assert (row.pr_event_count, row.pr_opened, row.pr_closed, row.pr_merged, row.pr_other_events) == (3, 0, 1, 1, 1)


def test_days_with_one_kind_only(spark):
    repo, _ = facts(spark, push(1, commits=[{}], when=DAY1), request(2, when=DAY2))
    first, second = repo.orderBy("activity_date").collect()
    assert (first.push_avg_commits, first.pr_merged_pct) == (1.0, None)
    assert (second.push_avg_commits, second.pr_merged_pct) == (0.0, 0.0)


def test_merged_rate_is_rounded_half_up(spark):
    rows = [request(i, action="merged" if i == 0 else "opened") for i in range(800)]
    assert facts(spark, *rows)[0].first().pr_merged_pct == 0.13
    assert facts(spark, *rows[:8])[0].first().pr_merged_pct == 12.5


def test_unknown_users_count_for_repositories_only(spark):
    repo, users = facts(spark, push(1, user=None), request(2, user=None), push(3))
    assert repo.first().total_activity_count == 3
    assert [r.username for r in users.collect()] == ["ann"]


def test_user_facts_add_up_to_repository_facts(spark):
    rows = [push(i, user=f"u{i % 3}", commits=[{}] * (i % 4)) for i in range(20)]
    repo, users = facts(spark, *rows)
    assert users.agg(F.sum("commits_in_pushes")).first()[0] == repo.agg(F.sum("commit_count")).first()[0]


def test_silver_and_bronze_paths_agree(spark):
    stg = events(spark, push(1, commits=[{}]), push(2, user=None), request(3), request(4, action=None), request(5, user=None))
    keys = ("username", "repo_name", "activity_date")
    one = activity.activity_base(stg)
    two = activity.count_activity(
        activity.activity_rows_from_silver(activity.push_events(stg), activity.pull_requests(stg)), keys)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.select(one.columns).collect()))


def test_unlisted_repository_gets_defaults(spark):
    repo, _ = facts(spark, push(1, repo="someone/thing"))
    row = activity.repository_dimension(repo, repository_metadata(spark, params.TRACKED_REPOSITORIES), AS_OF).first()
    assert (row.owner, row.language, row.stars) == ("someone", "Unknown", 0)


def test_keys_are_stable(spark):
    import hashlib

    row = facts(spark, push(1))[1].first()
    assert row.contrib_id == hashlib.md5(b"ann|2026-07-13").hexdigest()
    assert row.repo_id == hashlib.md5(b"facebook/react|2026-07-13").hexdigest()


def test_key_lookup_keeps_facts_without_dimension_row(spark):
    repo, _ = facts(spark, push(1), push(2, repo="a/b"))
    dim = repo.select("repo_name", "repo_id").filter("repo_name = 'a/b'")
    found = {r.repo_name: r.repo_id for r in activity.look_up_key(repo, dim, "repo_name", "repo_id").collect()}
    assert found["facebook/react"] is None and found["a/b"]


# --- totals when days are replaced -------------------------------------------------

def day(n):
    return dt.date(2024, 1, n)


def fact_rows(spark, rows):
    """key, day, pushes, pull-request events"""
    return spark.createDataFrame([(k, day(d), p, p * 2, r) for k, d, p, r in rows],
                                 "username string, activity_date date, push_count long, commits_in_pushes long, pr_event_count long")


def refreshed(spark, before, after, days):
    """Stored facts, new rows of the days: totals carried over, and whether the other days were needed."""
    facts = fact_rows(spark, before)
    inside = F.col("activity_date").isin(days)
    keys, commits = ["username"], "commits_in_pushes"
    replaced = activity.replaced_days(activity.totals(facts, keys, commits), activity.totals(facts.filter(inside), keys, commits),
                                      activity.totals(fact_rows(spark, after), keys, commits), keys, days)
    unsure = {r.username for r in replaced.filter("unsure").collect()}
    got = activity.sure_dates(replaced, facts.filter(~inside), keys, commits)
    want = activity.totals(facts.filter(~inside).unionByName(fact_rows(spark, after)), keys, commits)
    as_rows = lambda df: sorted(map(tuple, df.select(want.columns).collect()))
    assert as_rows(got) == as_rows(want)
    return unsure


def test_replaced_days_carry_over(spark):
    before = [("a", 1, 1, 0), ("a", 5, 2, 1), ("b", 5, 1, 0), ("c", 2, 1, 1), ("d", 5, 0, 3)]
    days = [day(5), day(6)]
    # more of the same: nobody's dates are in doubt
    assert refreshed(spark, before, [("a", 5, 3, 1), ("b", 5, 1, 0), ("d", 5, 0, 3), ("e", 6, 1, 0), ("c", 6, 1, 0)], days) == set()
    # a has lost its last push and only request, d is gone altogether
    assert refreshed(spark, before, [("b", 5, 1, 0)], days) == {"a"}
    assert refreshed(spark, before, [], days) == {"a"}
    assert refreshed(spark, [], [("a", 5, 1, 1)], days) == set()


def test_replaced_days_at_random(spark):
    import random

    rng = random.Random(3)
    for _ in range(3):
        rows = lambda low, high: [(f"u{k}", d, rng.randrange(3), rng.randrange(2)) for k in range(12)
                                  for d in range(low, high) if rng.random() < 0.4]
        refreshed(spark, rows(1, 9), rows(4, 7), [day(4), day(5), day(6)])
