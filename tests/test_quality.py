"""Checks on clean and on broken frames, and the publish gate."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from devsignals import params
from devsignals.operators import quality
from devsignals.operators.quality import Check
from devsignals.plans import checks, ingest_runs, publish
from devsignals.plans.catalog import GOLD, Catalog
from devsignals.session import fresh_path, shared_folder
from devsignals.sources import star_tables


def intermediate_folders(spark):
    return set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/devsignals/*/*"))


def outcome(df):
    return {(r.check_type, r.column_name): (r.failing_rows, r.passed) for r in df.collect()}


def test_declared_checks():
    declared = checks.declared()
    kinds = {k: len([c for c in declared if c.kind == k]) for k in ("not_null", "unique", "accepted_values", "relationships")}
    # 12 of the keys are single columns, four more have several
    assert kinds == {"not_null": 102, "unique": 16, "accepted_values": 10, "relationships": 3}


def test_checks_find_defects(spark):
    tables = {
        "child": spark.createDataFrame([("1", "x", "p"), ("1", "x", "q"), (None, "y", "q"), ("3", "zz", None)],
                                       "id string, kind string, parent string"),
        "parent": spark.createDataFrame([("p",)], "key string"),
    }
    report = quality.run(tables, [
        Check("child", "not_null", ("id",)), Check("child", "not_null", ("kind",), quality.WARN),
        Check("child", "unique", ("id",)), Check("child", "unique", ("id", "parent")),
        Check("child", "accepted_values", ("kind",), values=("x", "y")),
        Check("child", "relationships", ("parent",), values=("key",), parent="parent"),
    ])
    assert outcome(report) == {
        ("not_null", "id"): (1, False), ("not_null", "kind"): (0, True), ("unique", "id"): (1, False),
        ("unique", "id, parent"): (0, True), ("accepted_values", "kind"): (1, False), ("relationships", "parent"): (2, False),
    }
    with pytest.raises(quality.QualityError, match="child.id: not_null fails for 1"):
        quality.enforce(report)


def test_warnings_do_not_stop(spark):
    tables = {"t": spark.createDataFrame([(None,)], "a string")}
    quality.enforce(quality.run(tables, [Check("t", "not_null", ("a",), quality.WARN)]))


def test_business_rules(spark):
    day = dt.datetime(2024, 1, 2)
    pushes = spark.createDataFrame([("1", "a/b", day, -1), ("2", "a/b", dt.datetime(2024, 1, 1), 0)],
                                   "event_id string, repo_name string, fetched_at timestamp_ntz, commit_count int")
    future = quality.no_future_timestamps(pushes, pushes.limit(0), dt.datetime(2024, 1, 1, 12)).collect()
    assert [(r.model_name, r.event_id, r.time_difference_us) for r in future] == [("int_push_events", "1", 12 * 3600 * 10**6)]
    assert [r.event_id for r in quality.no_negative_commit_count(pushes).collect()] == ["1"]
    bronze = spark.createDataFrame([("1", "PullRequestEvent"), ("2", "PushEvent")], "event_id string, event_type string")
    assert [r.event_id for r in quality.push_model_integrity(pushes, bronze).collect()] == ["1"]


@pytest.mark.parametrize("hours, status", [(5, "pass"), (7, "warn"), (13, "error")])
def test_source_freshness(spark, hours, status):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "fetched_at timestamp_ntz")
    assert quality.source_freshness({"s": df}, now).first().status == status


def small_catalog(spark, data, **changes):
    return Catalog(spark, star_tables.raw_events(spark, data), star_tables.raw_stories(spark, data), **changes)


def test_publish_shows_a_version_only_after_its_checks(spark, data):
    root = fresh_path(spark, "published")
    first = publish.build_and_publish(small_catalog(spark, data), root, dt.datetime(2024, 2, 1), checks.gold_checks())
    assert publish.published_version(spark, root) == first
    before = publish.published_table(spark, root, "fct_github_daily_activity").count()

    events = star_tables.raw_events(spark, data)
    broken = small_catalog(spark, data)
    broken.raw_events = events.withColumn("repo_name", F.lit("not/listed"))
    with pytest.raises(quality.QualityError, match="repo_name: accepted_values"):
        publish.build_and_publish(broken, root, dt.datetime(2024, 2, 2), checks.gold_checks())
    assert publish.published_version(spark, root) == first
    assert publish.published_table(spark, root, "fct_github_daily_activity").count() == before

    later = small_catalog(spark, data, as_of=dt.datetime(2024, 2, 3))
    second = publish.build_and_publish(later, root, dt.datetime(2024, 2, 3), checks.gold_checks())
    assert publish.published_version(spark, root) == second
    stamp = publish.published_table(spark, root, "dim_repository").agg(F.max("created_at")).first()[0]
    assert stamp == dt.datetime(2024, 2, 3)
    assert all(publish.published_table(spark, root, name).columns for name in GOLD)


def test_other_parameters(spark, data):
    c = small_catalog(spark, data, patterns=(("x/y", "(?:react)", None),), repositories=(("facebook/react", "Lang", 1),))
    assert {r.mentioned_repo for r in c["int_hn_repo_mentions"].select("mentioned_repo").distinct().collect()} == {"x/y"}
    rows = {r.repo_name: (r.language, r.stars) for r in c["dim_repository"].collect()}
    assert rows["facebook/react"] == ("Lang", 1) and rows["vercel/next.js"] == (params.UNKNOWN_LANGUAGE, 0)


def test_full_gate_lets_clean_events_through(spark, data):
    root = fresh_path(spark, "full-gate")
    events = star_tables.raw_events(spark, data)
    action = F.get_json_object("raw_payload", "$.payload.action")
    clean = small_catalog(spark, data)
    clean.raw_events = events.filter((F.col("event_type") != params.PULL_REQUEST) | action.isNotNull())
    version = publish.build_and_publish(clean, root, dt.datetime(2024, 2, 1))
    with pytest.raises(quality.QualityError, match="pr_action"):
        publish.build_and_publish(small_catalog(spark, data), root, dt.datetime(2024, 2, 2))
    assert publish.published_version(spark, root) == version


def test_open_catalog_reads_and_outlives_a_rebuild(spark, data):
    root = fresh_path(spark, "opened")
    build = lambda: publish.build_and_publish(
        small_catalog(spark, data), root, dt.datetime(2024, 2, 1), checks.gold_checks())
    build()
    opened = [publish.open_published(spark, root, dt.datetime(2024, 2, 1)) for _ in range(2)]
    files = sorted(opened[0]["dim_hn_story"].inputFiles())
    assert files == sorted(opened[1]["dim_hn_story"].inputFiles())
    second = build()                  # at the same time: the later publication counts
    assert publish.published_version(spark, root) == second
    assert sorted(opened[0]["dim_hn_story"].inputFiles()) == files and opened[0]["dim_hn_story"].count() > 0
    with pytest.raises(ValueError):
        opened[0].build()


def test_quarantine_lets_the_full_gate_pass(spark, data):
    root = fresh_path(spark, "quarantine")
    catalog = small_catalog(spark, data)
    version = publish.build_and_publish(catalog, root, params.AS_OF, quarantine=True)
    assert publish.published_version(spark, root) == version
    bad = publish.published_table(spark, root, "quarantined_events")
    assert {tuple(r.faults) for r in bad.collect()} == {("int_pull_requests.pr_action: not_null",)}
    assert publish.published_table(spark, root, "quarantined_stories").count() == 0
    kept = publish.set_aside(catalog, f"{root}/again", params.AS_OF)
    assert kept.raw_events.count() + bad.count() == catalog.raw_events.count()
    assert kept.raw_events.columns == catalog["stg_github_events"].columns
    assert kept.raw_stories.columns == catalog.raw_stories.columns and kept.raw_stories.count() == catalog.raw_stories.count()


def test_quarantine_names_every_rule_a_row_breaks(spark, data):
    rows = [("1", "facebook/react", params.PULL_REQUEST, dt.datetime(2024, 1, 1), None),
            ("2", "x/y", params.PUSH, dt.datetime(2030, 1, 1), '{"payload":{}}'),
            (None, None, None, None, None), ("4", "x/y", "IssuesEvent", dt.datetime(2030, 1, 1), "{}"),
            ("5", "facebook/react", params.PUSH, dt.datetime(2024, 1, 1), '{"payload":{"commits":"no list"}}')]
    root = fresh_path(spark, "quarantine")
    catalog = small_catalog(spark, data)
    catalog.raw_events = spark.createDataFrame(rows, "event_id string, repo_name string, event_type string, fetched_at timestamp_ntz, raw_payload string")
    kept = publish.set_aside(catalog, root, params.AS_OF)
    assert sorted(r.event_id for r in kept.raw_events.collect()) == ["4", "5"]
    faults = {r.event_id: r.faults for r in spark.read.parquet(f"{root}/quarantined_events").collect()}
    assert faults == {
        "1": ["github_events_raw.raw_payload: not_null", "int_pull_requests.pr_action: not_null", "int_pull_requests.pull_request_id: not_null"],
        "2": ["repo_name: accepted_values", "fetched_at: no_future_timestamps"],
        None: [f"github_events_raw.{c}: not_null" for c in ("event_id", "repo_name", "event_type", "fetched_at", "raw_payload")]}


def test_good_rows_are_not_judged_at_each_read(spark, data):
    catalog = small_catalog(spark, data)
    kept = publish.set_aside(catalog, fresh_path(spark, "quarantine"), params.AS_OF)
    for df in (kept.raw_events, kept.raw_stories):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "_json(" not in plan and "Join" not in plan and "Filter" not in plan.replace("Filters:", "")


def test_rows_judged_for_a_publication_do_not_stay(spark, data):
    kept_before = intermediate_folders(spark)
    publish.build_and_publish(small_catalog(spark, data), fresh_path(spark, "quarantine"), params.AS_OF, quarantine=True)
    assert not {f for f in intermediate_folders(spark) - kept_before if "-kept-" in f}


def test_refused_data_are_reported_from_the_tables_the_gate_saw(spark, data):
    catalog = small_catalog(spark, data)
    found = ingest_runs.publish_refused(catalog).collect()
    assert found and all(r.version_unchanged and r.failing_rows > 0 for r in found)
    assert catalog.root is None            # no third build for the report


def test_both_lists_of_checks_agree():
    from oracle.declared import RULES

    ours = {(c.table, c.kind, c.columns, c.severity, set(c.values) == set() or c.kind == "relationships" or frozenset(c.values), c.parent)
            for c in checks.declared()}
    theirs = {(r.table, r.kind, r.columns, r.severity, set(r.values) == set() or frozenset(r.values), r.parent) for r in RULES}
    assert ours == theirs and len(RULES) == len(checks.declared())


@pytest.mark.parametrize("kind", ["unique", "accepted_values", "relationships"])
def test_planted_defects_are_found(spark, data, kind):
    import __spark_entry__ as entry

    found = entry.core_queries()[f"dq_{kind}_found"](spark, data).collect()
    assert len([r for r in found if not r.passed]) >= 3
