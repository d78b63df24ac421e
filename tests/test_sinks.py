"""Idempotent writers, landed files, compaction, statistics."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from devsignals import schemas
from devsignals.plans import ingest_runs
from devsignals.session import drop_folder, fresh_path, intermediates_dropped, shared_folder, written
from devsignals.sources import landing, sinks
from devsignals.sources.keyed import KeyedTable, read_loads, record_load

T0 = dt.datetime(2024, 1, 1)


def events(spark, *rows):
    return spark.createDataFrame([(k, "a/b", "PushEvent", T0 + dt.timedelta(hours=h), p) for k, h, p in rows],
                                 schemas.EVENTS_RAW)


def stories(spark, *rows):
    """story_id, title, score, descendants, hours"""
    return spark.createDataFrame(
        [(i, t, "ann", None, s, 0, d, "story", json.dumps({"score": s}), T0 + dt.timedelta(hours=h))
         for i, t, s, d, h in rows], schemas.STORIES_RAW)


def stored(spark, path):
    return sorted((r.event_id, r.raw_payload) for r in KeyedTable(spark, path).read().collect())


def test_first_event_wins_within_and_across_batches(spark):
    path = fresh_path(spark, "t")
    KeyedTable(spark, path).insert(events(spark, ("1", 5, "late"), ("1", 1, "early"), ("2", 0, "x"), (None, 0, "no key")))
    assert stored(spark, path) == [("1", "early"), ("2", "x")]
    again = events(spark, ("1", 0, "other"), ("3", 0, "y"))
    for _ in range(2):
        KeyedTable(spark, path).insert(again)
        assert stored(spark, path) == [("1", "early"), ("2", "x"), ("3", "y")]


def test_a_load_counts_what_it_does(spark):
    path = fresh_path(spark, "t")
    table = KeyedTable(spark, path)
    table.insert(events(spark, ("1", 0, "x")))
    batch = events(spark, ("1", 0, "x"), ("2", 0, "y"), ("2", 1, "y"), (None, 0, "z"))
    batch = batch.withColumn("repo_name", F.when(F.col("event_id") == "2", "c/d").otherwise(F.col("repo_name")))
    for load, expected in enumerate([[(None, 4, 1, 1), ("a/b", 2, 0, 1), ("c/d", 2, 1, 0), ("e/f", 0, 0, 0)],
                                     [(None, 4, 0, 1), ("a/b", 2, 0, 1), ("c/d", 2, 0, 0), ("e/f", 0, 0, 0)]]):
        counts = table.insert(batch, ("a/b", "c/d", "e/f"))
        assert counts == expected
        record_load(spark, path, load, counts)
    record_load(spark, path, 1, counts)             # the same load again replaces its record
    rows = read_loads(spark, path).orderBy("load", F.asc_nulls_first("repo_name")).collect()
    assert [(r.load, r.repo_name, r.duplicates, r.success_rate_pct) for r in rows if r.repo_name in (None, "c/d")] == [
        (0, None, 2, 25.0), (0, "c/d", 1, 50.0), (1, None, 3, 0.0), (1, "c/d", 2, 0.0)]


def test_loads_of_nothing(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"))
    empty = events(spark, ("1", 0, "x")).where("false")
    for _ in range(2):
        assert table.insert(empty, ("a/b",)) == [(None, 0, 0, 0), ("a/b", 0, 0, 0)]
    assert table.insert(events(spark, (None, 0, "x"))) == [(None, 1, 0, 1)]
    assert table.read().collect() == [] and table.read().columns == schemas.EVENTS_RAW.names


def test_settings_are_as_before_a_load(spark):
    rules = "spark.sql.adaptive.optimizer.excludedRules"
    before = spark.conf.get(rules, None)
    KeyedTable(spark, fresh_path(spark, "t")).insert(events(spark, ("1", 0, "x")))
    assert spark.conf.get(rules, None) == before


def test_merged_buckets_hold_the_same_rows(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), buckets=4)
    for k in range(3):
        table.insert(events(spark, *[(str(i), 0, f"p{i}") for i in range(20 * k, 20 * k + 30)]))
    before, files = sorted(map(tuple, table.read().collect())), len(table.read().inputFiles())
    assert table.merge_files(2) == [0, 1, 2, 3]
    assert sorted(map(tuple, table.read().collect())) == before and len(table.read().inputFiles()) < files
    assert table.merge_files(2) == []
    assert sorted(r.event_id for r in table.rows_of(["3", "41", "none"]).collect()) == ["3", "41"]


def test_only_the_buckets_of_a_batch_are_read(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), buckets=16)
    table.insert(events(spark, *[(f"{i:05}", 0, "p") for i in range(400)]))
    batch = events(spark, ("00007", 1, "q"), ("00009", 1, "q"))
    found = table.present(batch)
    assert sorted(r.event_id for r in found.collect()) == ["00007", "00009"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan and "GreaterThanOrEqual(event_id,00007), LessThanOrEqual(event_id,00009)" in plan
    assert "ReadSchema: struct<event_id:string>" in plan
    scan = plan[plan.index("PartitionFilters"):]
    wanted = {int(x) for x in re.findall(r"[0-9]+", scan[scan.index("[") : scan.index("]")].split("key_bucket", 1)[1].partition(" ")[2])}
    buckets = {r[0] for r in batch.select(table.bucket()).collect()}
    assert wanted == buckets and len(buckets) <= 2
    assert {int(f.split("key_bucket=")[1].split("/")[0]) for f in table.read().inputFiles()} > buckets


def test_upsert_keeps_identity_and_replaces_the_rest(spark):
    path = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, (1, "first", 10, 5, 0), (2, "only", 1, 1, 0)), path, 0)
    sinks.append_changes(stories(spark, (1, "second", 20, None, 1), (3, "new", 7, 7, 1)), path, 1)

    def state():
        log = sinks.read_changes(spark, path, schemas.STORIES_RAW)
        return sorted((r.story_id, r.title, r.score, r.descendants, json.loads(r.raw_json)["score"])
                      for r in sinks.current_state(log).collect())

    expected = [(1, "first", 20, None, 20), (2, "only", 1, 1, 1), (3, "new", 7, 7, 7)]
    assert state() == expected
    # the same batch once more, under its own number and under a new one
    for number in (1, 2):
        sinks.append_changes(stories(spark, (1, "second", 20, None, 1), (3, "new", 7, 7, 1)), path, number)
        assert state() == expected


def test_upsert_orders_rows_within_a_batch(spark):
    path = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, (1, "b", 2, 2, 2), (1, "a", 1, 1, 1), (1, "c", 3, None, 3)), path, 0)
    row = sinks.current_state(sinks.read_changes(spark, path, schemas.STORIES_RAW)).first()
    assert (row.title, row.score, row.descendants) == ("a", 3, None)


def test_compaction_does_not_change_the_state(spark):
    old, new = fresh_path(spark, "t"), fresh_path(spark, "t")
    sinks.append_changes(stories(spark, (1, "first", 10, 5, 0)), old, 0)
    sinks.append_changes(stories(spark, (1, "second", 20, 6, 1)), old, 1)
    sinks.compact(spark, old, new, schemas.STORIES_RAW)
    sinks.append_changes(stories(spark, (1, "third", 30, 7, 2)), new, 1)
    row = sinks.current_state(sinks.read_changes(spark, new, schemas.STORIES_RAW)).first()
    assert (row.title, row.score, row.descendants) == ("first", 30, 7)


def test_folding_does_not_change_the_state(spark):
    path = fresh_path(spark, "t")
    batches = [[(1, "first", 10, 5, 0), (2, "only", 1, 1, 0)], [(1, "second", 20, None, 1)], [(3, "new", 7, 7, 2), (1, "third", 30, 1, 2)]]

    def state():
        log = sinks.read_changes(spark, path, schemas.STORIES_RAW)
        return sorted((r.story_id, r.title, r.score, r.descendants) for r in sinks.current_state(log).collect())

    for seq, rows in enumerate(batches):
        sinks.append_changes(stories(spark, *rows), path, seq)
        before = state()
        for _ in range(2):
            sinks.fold(spark, path, schemas.STORIES_RAW)
            assert state() == before and sinks.folded_upto(spark, path) == seq
    # the last batch once more, as after a failure: it is in the base already
    sinks.append_changes(stories(spark, *batches[-1]), path, 2)
    assert state() == before == [(1, "first", 30, 1), (2, "only", 1, 1), (3, "new", 7, 7)]
    changes = sinks.read_changes(spark, path, schemas.STORIES_RAW)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert changes.count() == 3 and re.search(r"PartitionFilters: \[isnotnull\(seq#\d+L\), \(seq#\d+L > 2\)\]", plan)


def test_a_base_without_its_pointer_is_not_read(spark):
    path = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, (1, "a", 1, 1, 0)), path, 0)
    stories(spark, (1, "half", 9, 9, 9)).write.parquet(f"{path}-base/upto=0")
    assert [r.title for r in sinks.current_state(sinks.read_changes(spark, path, schemas.STORIES_RAW)).collect()] == ["a"]


def test_no_wide_row_is_sorted_for_the_state(spark):
    path = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, (1, "a", 1, 1, 0)), path, 0)
    plan = sinks.current_state(sinks.read_changes(spark, path, schemas.STORIES_RAW))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in text
    # only the narrow scan, the last one, stands below a sort
    first, last = text.index("Sort ["), text.rindex("FileScan")
    assert text.count("FileScan") == 3 and text[first:].count("FileScan") == 1
    assert "raw_json" not in text[last:].split("\n")[0] and "title" not in text[last:].split("\n")[0]


def test_a_report_of_the_state_moves_no_document(spark):
    path = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, (1, "a", 1, 1, 0), (1, "b", 2, 2, 1)), path, 0)
    report = ingest_runs._reported(sinks.read_changes(spark, path, schemas.STORIES_RAW))
    assert [(r.title, r.score, r.raw_score) for r in report.collect()] == [("a", 2, "2")]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.split("\n") if "Join" in line][-1]
    assert "get_json_object" not in plan[:plan.index(joined)]
    assert all(".zstd.parquet" in f for f in sinks.read_changes(spark, path, schemas.STORIES_RAW).inputFiles())


def test_a_fold_moves_only_keys_of_several_rows(spark):
    path = fresh_path(spark, "t")
    rows = [(i % 70_000, f"t{i}", i, i % 7, i % 50) for i in range(100_000)]
    for seq, part in enumerate((rows[:60_000], rows[50_000:], [(3, "edited", -1, None, 99), (3, "edited", -1, None, 99)])):
        sinks.append_changes(stories(spark, *part).repartition(3, "title"), path, seq)
    log = sinks.read_changes(spark, path, schemas.STORIES_RAW)
    folded, state = sinks.folded_state(log), sinks.current_state(log)
    assert folded.columns == state.columns and folded.count() == state.count() == 70_000
    assert folded.exceptAll(state).isEmpty() and state.exceptAll(folded).isEmpty()

    alone = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, *[(i, "a", i, 1, 0) for i in range(200)]), alone, 0)
    sinks.fold(spark, alone, schemas.STORIES_RAW)
    plan = sinks.folded_state(sinks.read_changes(spark, alone, schemas.STORIES_RAW))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


def test_equal_rows_of_a_batch_are_one(spark):
    path = fresh_path(spark, "t")
    sinks.append_changes(stories(spark, *[(1, "a", 1, 1, 0)] * 5), path, 0)
    assert sinks.current_state(sinks.read_changes(spark, path, schemas.STORIES_RAW)).count() == 1


def test_upsert_statistics(spark):
    row = sinks.upsert_statistics(stories(spark, (1, "a", 1, 1, 0), (1, "a", 1, 1, 1), (2, "b", 1, 1, 0)),
                                  stories(spark, (1, "a", 1, 1, 0))).first()
    assert (row.inserted, row.updated) == (1, 1)


def landed(spark, *items):
    path = fresh_path(spark, "items")
    spark.createDataFrame([(i if isinstance(i, str) else json.dumps(i),) for i in items], "value string").write.text(path)
    return landing.read_story_items(spark, path, T0)


def test_story_defaults_only_for_absent_keys(spark):
    absent = {"id": 1, "title": "t", "time": 3}
    null = {"id": 2, "title": "t", "score": None, "descendants": None, "type": None, "by": None}
    rows = {r.story_id: r for r in landed(spark, absent, null).collect()}
    assert (rows[1].score, rows[1].descendants, rows[1].type, rows[1].author) == (0, 0, "story", None)
    assert (rows[2].score, rows[2].descendants, rows[2].type, rows[2].author) == (None, None, None, None)
    assert json.loads(rows[1].raw_json) == absent


def test_rejected_stories(spark):
    rows = landed(spark, {"title": "t"}, {"id": 0, "title": "t"}, {"id": 1, "title": ""}, {"id": 2}, {"id": 3, "title": None},
                  "not json", {"id": 4, "title": "ok"})
    assert [r.story_id for r in landing.valid_stories(rows).collect()] == [4]
    reasons = [r.reject_reason for r in landing.rejected_stories(rows).collect()]
    assert sorted(reasons) == ["missing id"] * 3 + ["missing title"] * 3


def test_event_pages(spark):
    path = fresh_path(spark, "pages")
    page = {"repo_name": "a/b", "events": [{"id": "1", "type": "PushEvent", "payload": {"x": [1, 2]}}, {"id": "2", "type": "F"}]}
    spark.createDataFrame([(json.dumps(page),), ('{"repo_name":"a/b","events":[]}',)], "value string").write.text(path)
    rows = sorted(landing.read_event_pages(spark, path, T0).collect())
    assert [(r.event_id, r.repo_name, r.event_type) for r in rows] == [("1", "a/b", "PushEvent"), ("2", "a/b", "F")]
    assert json.loads(rows[0].raw_payload) == page["events"][0]


def test_only_named_days_are_replaced(spark):
    path = fresh_path(spark, "days")
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 3)], "activity_date date, v int")
    sinks.write_table(df, path, "activity_date")
    sinks.write_table(df.filter("v = 2").withColumn("v", F.lit(20)), path, "activity_date", dynamic=True)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3, 20]


def test_csv_export(spark):
    path = fresh_path(spark, "csv")
    sinks.export_csv(spark.createDataFrame([(1, "a,b"), (2, None)], "n int, t string"), path)
    back = spark.read.schema("n int, t string").option("header", True).csv(path)
    assert sorted(map(tuple, back.collect())) == [(1, "a,b"), (2, None)]


class NoFolder:
    """A session without the setting, on a cluster."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_cluster_needs_a_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(RuntimeError):
        shared_folder(NoFolder())


def test_random_batches_against_a_plain_loop(spark):
    """Both writers against the row-by-row meaning of insert-if-absent and upsert."""
    import random

    rng = random.Random(7)
    events_path, stories_path = fresh_path(spark, "t"), fresh_path(spark, "t")
    kept, state, clock = {}, {}, 0
    for number in range(4):
        batch, items = [], []
        for _ in range(60):
            clock += 1
            # one key takes a third of all rows
            key = 0 if rng.random() < 0.34 else rng.randrange(1, 40)
            batch.append((str(key), clock, f"p{clock}"))
            kept.setdefault(str(key), f"p{clock}")
            comments = rng.choice([None, 1, 2])
            items.append((key + 1, f"t{clock}", clock, comments, clock))
            title = state[key + 1][0] if key + 1 in state else f"t{clock}"
            state[key + 1] = (title, clock, comments)
        rng.shuffle(batch)
        rng.shuffle(items)
        KeyedTable(spark, events_path).insert(events(spark, *batch))
        sinks.append_changes(stories(spark, *items), stories_path, number)
    assert stored(spark, events_path) == sorted(kept.items())
    rows = sinks.current_state(sinks.read_changes(spark, stories_path, schemas.STORIES_RAW)).collect()
    assert {r.story_id: (r.title, r.score, r.descendants) for r in rows} == state


def test_intermediates_go_when_their_step_is_done(spark):
    kept = written(spark.range(3), "kept")
    with intermediates_dropped(spark):
        inner = written(spark.range(5), "inner")
        with intermediates_dropped(spark):
            innermost = written(spark.range(7), "innermost")
            result = fresh_path(spark, "result")
            innermost.write.parquet(result)
        assert inner.count() == 5
    assert spark.read.parquet(result).count() == 7 and kept.count() == 3
    root = f"{shared_folder(spark)}/devsignals/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert not any(name.startswith("inner") for name in os.listdir(root))
    with pytest.raises(ValueError):
        drop_folder(spark, "/tmp/elsewhere")
