"""Reports on contributors: leaderboards, profiles, concentration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from devsignals import params
from devsignals.functions import numeric, text, times
from devsignals.operators import reshape, sketches
from devsignals.operators.leaderboards import ALL
from devsignals.operators.ranking import top_per_group
from devsignals.plans.repositories import in_range, total


def _restricted(df: DataFrame, column: str, value: str) -> DataFrame:
    """Filter unless the value is the word for no filter."""
    return df if value == ALL else df.filter(F.col(column) == value)


def _most_active(column: str = "total_activity") -> list[Column]:
    return [F.desc_nulls_first(column), F.asc_nulls_last("username")]


def contributor_leaderboard(ranks: DataFrame, repo: str = ALL, contrib_type: str = ALL) -> DataFrame:
    """All contributors, of a repository or of a type, with their rank as it was given when the tables were built: one
    folder is read, nothing is written."""
    rank = F.col("rank" if contrib_type == ALL else "rank_in_type").alias("rank")
    rows = _restricted(ranks.filter(F.col("scope") == repo), "contrib_type", contrib_type)
    return rows.select(rank, "username", "contrib_type", "total_activity", "total_push_events", "total_pr_events").orderBy("rank")


def unique_contributors(facts: DataFrame, sketched: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Distinct contributors per repository, counted and estimated, and whether the estimate is within its bound."""
    exact = facts.filter(in_range(start, end)).groupBy("repo_name").agg(F.countDistinct("username").alias("contributors"))
    estimated = sketches.distinct_in_range(sketched, ["repo_name"], start, end)
    gap = F.abs(F.col("estimate") - F.col("contributors"))
    return exact.join(estimated, "repo_name").withColumn(
        "within_bound", gap <= F.greatest(F.lit(1.0), F.col("contributors") * sketches.ERROR_BOUND))


def contrib_type_distribution(contributors: DataFrame) -> DataFrame:
    return (
        contributors.groupBy("contrib_type")
        .agg(F.count(F.lit(1)).alias("contributor_count"))
        .orderBy(F.desc("contributor_count"), "contrib_type")
    )


def contrib_type_labels(contributors: DataFrame) -> DataFrame:
    """The distribution under the names readers see."""
    labels = {"unknown": "Unclassified"}
    return contrib_type_distribution(contributors).withColumn("contrib_type", text.relabel(F.col("contrib_type"), labels))


def top_contributors(facts: DataFrame, repo: str = ALL, top_n: int = 10) -> DataFrame:
    return (
        _restricted(facts, "repo_name", repo)
        .groupBy("username")
        .agg(F.sum("total_activity_count").alias("total_activity_count"))
        .orderBy(*_most_active("total_activity_count"))
        .limit(top_n)
    )


def contributor_list(contributors: DataFrame) -> DataFrame:
    return contributors.select("username").orderBy(F.asc_nulls_last("username"))


def contributor_profile(contributors: DataFrame, username: str) -> DataFrame:
    return contributors.filter(F.col("username") == username).select(
        "username", "contrib_type", "total_push_events", "total_pr_events", "first_active_date", "last_active_date"
    )


def contributor_timeline(facts: DataFrame, username: str, start: dt.date, end: dt.date) -> DataFrame:
    return (
        facts.filter((F.col("username") == username) & in_range(start, end))
        .orderBy("activity_date", "repo_name")
        .select(
            F.date_format("activity_date", "yyyy-MM-dd").alias("activity_date"),
            "repo_name", "push_count", "pr_event_count", "pr_opened", "pr_merged", "pr_merged_pct",
            "contribution_type", "total_activity_count",
        )
    )


def contributor_repo_participation(facts: DataFrame, username: str) -> DataFrame:
    return (
        facts.filter(F.col("username") == username)
        .groupBy("repo_name")
        .agg(
            F.sum("push_count").alias("total_pushes"),
            F.sum("pr_event_count").alias("total_pr_events"),
            F.sum("pr_merged").alias("pr_merged"),
            numeric.mean_of_percents(F.col("pr_merged_pct")).alias("avg_merge_rate_pct"),
        )
        .orderBy((F.col("total_pushes") + F.col("total_pr_events")).desc_nulls_first(), "repo_name")
    )


def leaderboard_headline(ranks: DataFrame, repo: str = ALL, contrib_type: str = ALL) -> DataFrame:
    """Number of contributors, the most active one, mean activity."""
    rows = _restricted(ranks.filter(F.col("scope") == repo), "contrib_type", contrib_type)
    activity = F.col("total_activity")
    return rows.agg(
        F.count(F.lit(1)).alias("total_contributors"),
        F.coalesce(F.min_by("username", F.struct(-activity, "username")), F.lit("—")).alias("top_contributor"),
        F.coalesce(numeric.mean(activity, 1), F.lit(0.0)).alias("avg_activity"),
    )


def contributor_summary(facts: DataFrame, username: str, start: dt.date, end: dt.date) -> DataFrame:
    """Repositories and merged pull requests of all time, active days of the range."""
    return facts.filter(F.col("username") == username).agg(
        F.greatest(F.countDistinct("repo_name"), F.lit(1)).alias("repositories"),
        F.countDistinct(F.when(in_range(start, end), F.col("activity_date"))).alias("active_days"),
        total("pr_merged").alias("pr_merged"),
    )


def activity_matrix(facts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return reshape.activity_matrix(facts, start, end)


def top_by_commits(contributors: DataFrame, k: int = 20) -> DataFrame:
    return (
        contributors.select("username", "contrib_type", "total_push_events", "total_commits", "total_pr_events",
                            "first_active_date", "last_active_date")
        .orderBy(F.desc_nulls_first("total_commits"), "username")
        .limit(k)
    )


def contributor_detail(facts: DataFrame, username: str) -> DataFrame:
    return (
        facts.filter(F.col("username") == username)
        .groupBy("repo_name")
        .agg(
            F.count(F.lit(1)).alias("days_active"),
            F.sum("push_count").alias("total_pushes"),
            F.sum("commits_in_pushes").alias("total_commits"),
            F.sum("pr_event_count").alias("total_pr_events"),
            numeric.mean_of_percents(F.col("pr_merged_pct")).alias("avg_pr_merge_rate"),
        )
        .orderBy(F.desc_nulls_first("total_commits"), "repo_name")
    )


def contributor_heatmap(facts: DataFrame) -> DataFrame:
    """User by repository. The primary type is the most frequent daily type, ties by
    name; the types are a fixed short list, so they are counted in the one grouping."""
    types = sorted(params.CONTRIBUTION_TYPES)
    votes = [F.count_if(F.col("contribution_type") == t).alias(f"_{t}") for t in types]
    counted = facts.groupBy("username", "repo_name").agg(
        F.sum("push_count").alias("total_pushes"),
        F.sum("commits_in_pushes").alias("total_commits"),
        F.sum("pr_event_count").alias("total_pr_events"),
        F.sum("total_activity_count").alias("total_activity"),
        # the facts hold one row per user, repository and day
        F.count("activity_date").alias("days_active"),
        *votes,
    )
    ballot = F.array(*[F.struct((-F.col(f"_{t}")).alias("votes"), F.lit(t).alias("type")) for t in types])
    return (
        counted.withColumn("primary_contribution_type", F.array_min(ballot)["type"])
        .drop(*[f"_{t}" for t in types])
        .orderBy(F.desc_nulls_first("total_activity"), "username", "repo_name")
    )


def weekly_activity(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("username", "repo_name", times.week_start(F.col("activity_date")).alias("week_start"))
        .agg(F.sum("total_activity_count").alias("weekly_activity"))
        .orderBy(F.desc_nulls_first("week_start"), F.desc_nulls_first("weekly_activity"), "username", "repo_name")
    )


def _commits_per_user(facts: DataFrame) -> DataFrame:
    return facts.groupBy("repo_name", "username").agg(F.sum("commits_in_pushes").alias("commits"))



def _leading_users(per_user: DataFrame, k: int) -> DataFrame:
    return top_per_group(per_user, "repo_name", [F.desc_nulls_first("commits"), F.asc_nulls_last("username")], k)


def contribution_share(facts: DataFrame, k: int = 5) -> DataFrame:
    """Commits of the k leading users of each repository and of all others together.

    The others are the repository's total less its leaders, so no ranking over all
    users of a repository is needed: each leader counts once for itself and once,
    negatively, for the others.
    """
    per_user = _commits_per_user(facts)
    itself = F.struct(F.col("username").alias("contributor_group"), F.col("commits"), F.lit(1).alias("users"))
    not_other = F.struct(F.lit("Others").alias("contributor_group"), (-F.col("commits")).alias("commits"),
                         F.lit(-1).alias("users"))
    leaders = _leading_users(per_user, k).select("repo_name", F.inline(F.array(itself, not_other)))
    everyone = per_user.groupBy("repo_name").agg(F.sum("commits").alias("commits"), F.count(F.lit(1)).alias("users"))
    return (
        leaders.unionByName(everyone.withColumn("contributor_group", F.lit("Others")))
        .groupBy("repo_name", "contributor_group")
        .agg(F.sum("commits").alias("commits"), F.sum("users").alias("users"))
        .filter(F.col("users") > 0)
        .drop("users")
        .orderBy("repo_name", F.desc_nulls_first("commits"), "contributor_group")
    )


def contribution_concentration(facts: DataFrame, k: int = 5) -> DataFrame:
    """Share of the first and of the k first users in a repository's commits, and the risk."""
    per_user = _commits_per_user(facts)
    whole = per_user.groupBy("repo_name").agg(F.sum("commits").alias("all_commits"))
    shares = _leading_users(per_user, k).join(whole, "repo_name").withColumn(
        "pct_share", numeric.percent(F.col("commits"), F.col("all_commits"))
    )
    top = F.col("top_contributor_pct")
    return (
        shares.groupBy("repo_name")
        .agg(
            F.max("pct_share").alias("top_contributor_pct"),
            (F.sum(numeric.hundredths(F.col("pct_share"))) / F.lit(100.0)).alias("top_5_pct"),
        )
        .withColumn(
            "diversity_assessment",
            F.when(top > 50, params.HIGH_RISK).when(top > 30, params.MEDIUM_RISK).otherwise(params.HEALTHY_SPREAD),
        )
    )


def account_classes(contributors: DataFrame) -> DataFrame:
    return contributors.select("username", text.account_class(F.col("username")).alias("account_class"))
