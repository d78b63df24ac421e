"""Distributed numbering, leaders per group, shares, history, reshaping."""

import datetime as dt

from pyspark.sql import Window, functions as F

from devsignals.operators import history, leaderboards, reshape
from devsignals.operators.ranking import first_rows, global_row_number, top_per_group
from devsignals.plans import contributors
from devsignals.session import fresh_path


def test_global_row_number_equals_a_single_window(spark):
    # a third of all rows share one value
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.hash("id") % 50).alias("v"), F.col("id").cast("string").alias("name"))
    order = [F.desc_nulls_first("v"), F.asc_nulls_last("name")]
    got = {r.name: r["rank"] for r in global_row_number(df, order).collect()}
    want = {r.name: r["rank"] for r in df.withColumn("rank", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_global_row_number_uses_several_tasks(spark):
    df = spark.range(1000, numPartitions=4).withColumnRenamed("id", "n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = global_row_number(df, [F.desc("n")])
        assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 1001))
        assert len([f for f in ranked.inputFiles() if f.endswith(".parquet")]) > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_row_number_of_nothing(spark):
    assert global_row_number(spark.range(0), [F.asc("id")]).collect() == []


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = top_per_group(df, "g", [F.desc("id")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r.g, r.id) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_first_rows(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 4, "c"), (3, 1, "d"), (4, None, "e")], "k int, v int, wide string")
    order = [F.desc_nulls_first("v"), F.asc("k"), F.asc("wide")]
    for k in range(1, 7):
        want = [r.wide for r in df.orderBy(*order).limit(k).collect()]
        assert [r.wide for r in first_rows(df, "v", order, k).collect()] == want
    order = [F.asc_nulls_first("v"), F.asc("k"), F.asc("wide")]
    for k in range(1, 7):
        want = [r.wide for r in df.orderBy(*order).limit(k).collect()]
        assert [r.wide for r in first_rows(df, "v", order, k, descending=False).collect()] == want
    assert first_rows(df.limit(0), "v", order, 3).collect() == []
    nulls = spark.createDataFrame([(k, None) for k in range(5)], "k int, v int")
    assert [r.k for r in first_rows(nulls, "v", [F.desc_nulls_first("v"), F.asc("k")], 3).collect()] == [0, 1, 2]


def user_facts(spark, commits):
    rows = [("a/b", u, dt.date(2024, 1, 1), c) for u, c in commits.items()]
    return spark.createDataFrame(rows, "repo_name string, username string, activity_date date, commits_in_pushes bigint")


def test_shares_and_concentration(spark):
    commits = {"u1": 60, "u2": 10, "u3": 10, "u4": 10, "u5": 5, "u6": 3, "u7": 2}
    rows = [tuple(r) for r in contributors.contribution_share(user_facts(spark, commits)).collect()]
    assert rows == [("a/b", "u1", 60), ("a/b", "u2", 10), ("a/b", "u3", 10), ("a/b", "u4", 10), ("a/b", "Others", 5),
                    ("a/b", "u5", 5)]
    row = contributors.contribution_concentration(user_facts(spark, commits)).first()
    assert (row.top_contributor_pct, row.top_5_pct, row.diversity_assessment) == (60.0, 95.0, "High Risk - Bottleneck")
    row = contributors.contribution_concentration(user_facts(spark, {"u1": 40, "u2": 30, "u3": 30})).first()
    assert (row.top_5_pct, row.diversity_assessment) == (100.0, "Medium Risk")
    row = contributors.contribution_concentration(user_facts(spark, {"u1": 0})).first()
    assert (row.top_contributor_pct, row.diversity_assessment) == (None, "Healthy - Distributed")
    assert contributors.contribution_share(user_facts(spark, {"u1": 1, "u2": 1})).count() == 2


def test_history(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)

    def snapshot(*rows):
        return spark.createDataFrame(list(rows), "name string, stars int")

    one = history.start_history(snapshot(("a", 1), ("b", 2), ("c", None)), "name", ["stars"], t1)
    two = history.apply_snapshot(one, snapshot(("a", 5), ("b", 2), ("d", 9), ("c", None)), "name", ["stars"], t2)
    rows = sorted((r.name, r.valid_from, r.stars, r.valid_to, r.is_current) for r in two.collect())
    assert rows == [
        ("a", t1, 1, t2, False), ("a", t2, 5, None, True), ("b", t1, 2, None, True), ("c", t1, None, None, True),
        ("d", t2, 9, None, True),
    ]
    # the same look again changes nothing; a key that is gone stays
    three = history.apply_snapshot(two, snapshot(("a", 5)), "name", ["stars"], dt.datetime(2024, 3, 1))
    assert sorted(map(repr, three.collect())) == sorted(map(repr, two.select(three.columns).collect()))


def test_matrix_and_empty_measures(spark):
    df = spark.createDataFrame([("u", dt.date(2024, 1, 1), 3), ("u", dt.date(2024, 1, 1), 4), ("v", dt.date(2024, 1, 3), 1),
                                ("w", dt.date(2024, 2, 1), 1)], "username string, activity_date date, total_activity_count bigint")
    wide = reshape.activity_matrix(df, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert wide.columns == ["username", "2024-01-01", "2024-01-02", "2024-01-03"]
    assert sorted(map(tuple, wide.collect())) == [("u", 7, 0, 0), ("v", 0, 0, 1)]
    assert reshape.drop_empty_measures(wide, wide.columns[1:]).columns == ["username", "2024-01-01", "2024-01-03"]


def test_stored_history_grows_with_changes(spark):
    path = fresh_path(spark, "history")

    def snapshot(*rows):
        return spark.createDataFrame(list(rows), "name string, stars int, tag string")

    looks = [snapshot(("a", 1, "x"), ("b", 2, None), ("c", None, None)), snapshot(("a", 5, "x"), ("b", 2, None), ("d", 9, "y"), ("c", None, None)),
             snapshot(("a", 5, "x"), ("b", 2, None)), snapshot(("a", 1, "x"), ("b", 2, "z"))]
    times = [dt.datetime(2024, 1, n + 1) for n in range(4)]
    plain = history.start_history(looks[0], "name", ["stars", "tag"], times[0])
    schema = plain.schema
    for n, look in enumerate(looks):
        for _ in range(2):              # a repeated snapshot replaces itself
            history.store_snapshot(path, n, look, "name", ["stars", "tag"], times[n])
        if n:
            plain = history.apply_snapshot(plain, look, "name", ["stars", "tag"], times[n])
        got = history.read_history(spark, path, n, schema)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.select(got.columns).collect()))
    assert [spark.read.parquet(f"{path}/seq={n}").count() for n in range(4)] == [3, 2, 0, 2]
    # an earlier look is still there
    assert history.read_history(spark, path, 0, schema).filter("is_current").count() == 3


def test_ranks_per_scope_and_type(spark):
    people = spark.createDataFrame([(f"u{k}", "both" if k % 3 else "pr_only", k % 5, 1) for k in range(40)],
                                   "username string, contrib_type string, total_push_events long, total_pr_events long")
    inside = people.filter("total_push_events > 1").selectExpr("'a/b' as repo_name", "username", "total_push_events as pushes", "0L as pr_events")
    ranks = leaderboards.ranked_contributors(people, inside)
    order = [F.desc("total_activity"), F.asc("username")]
    want = ranks.drop("rank", "rank_in_type").withColumn("rank", F.row_number().over(Window.partitionBy("scope").orderBy(*order)).cast("long")).withColumn(
        "rank_in_type", F.row_number().over(Window.partitionBy("scope", "contrib_type").orderBy(*order)).cast("long"))
    columns = sorted(ranks.columns)
    assert sorted(map(tuple, ranks.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect())) and ranks.count() > 60
