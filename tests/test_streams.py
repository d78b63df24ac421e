"""Streams: bounded de-duplication, restarts, dead letters, event time."""

import datetime as dt

import pytest

from devsignals import schemas
from devsignals.session import fresh_path
from devsignals.sources import sinks
from devsignals.sources.keyed import read_loads
from devsignals.streaming import events as event_streams
from devsignals.streaming import stories as story_streams

T0 = dt.datetime(2024, 1, 1)


def land_events(spark, root, *rows):
    spark.createDataFrame([(k, "a/b", "PushEvent", T0 + dt.timedelta(hours=h), "{}") for k, h in rows],
                          schemas.EVENTS_RAW).coalesce(1).write.mode("append").parquet(f"{root}/landing")


def test_watermark_form_drops_repeats_within_the_delay(spark):
    root = fresh_path(spark, "s")
    for rows in ([("1", 0), ("2", 1), ("1", 2)], [("2", 3), ("3", 4)]):
        land_events(spark, root, *rows)
        stream = event_streams.first_within(event_streams.read_event_stream(spark, f"{root}/landing"), "6 hours")
        event_streams.append_to(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    ids = [r.event_id for r in spark.read.schema(stream.schema).parquet(f"{root}/out").collect()]
    assert sorted(ids) == ["1", "2", "3"]


def test_stream_resumes_where_it_stopped(spark):
    root = fresh_path(spark, "s")
    for rows in ([("1", 5), ("1", 1)], [("1", 0), ("2", 0)], []):
        if rows:
            land_events(spark, root, *rows)
        stream = event_streams.read_event_stream(spark, f"{root}/landing")
        event_streams.store_first(stream, f"{root}/table", f"{root}/cp").awaitTermination()
    rows = spark.read.schema(schemas.EVENTS_RAW).parquet(f"{root}/table").collect()
    assert sorted((r.event_id, r.fetched_at.hour) for r in rows) == [("1", 1), ("2", 0)]


def test_stream_at_an_interval(spark):
    root = fresh_path(spark, "s")
    land_events(spark, root, ("1", 0))
    query = event_streams.store_first(
        event_streams.read_event_stream(spark, f"{root}/landing"), f"{root}/table", f"{root}/cp", every="1 second")
    try:
        query.processAllAvailable()
        land_events(spark, root, ("1", 5), ("2", 5))
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema(schemas.EVENTS_RAW).parquet(f"{root}/table").collect()
    assert sorted((r.event_id, r.fetched_at.hour) for r in rows) == [("1", 0), ("2", 5)]


def test_lost_progress_is_repaired_by_repeating(spark):
    """A new checkpoint reads everything again; the table stays as it is."""
    root = fresh_path(spark, "s")
    land_events(spark, root, ("1", 0), ("2", 0))
    for number in range(2):
        stream = event_streams.read_event_stream(spark, f"{root}/landing")
        event_streams.store_first(stream, f"{root}/table", f"{root}/cp{number}").awaitTermination()
    assert spark.read.schema(schemas.EVENTS_RAW).parquet(f"{root}/table").count() == 2


def test_story_stream_keeps_rejects_apart(spark):
    root = fresh_path(spark, "s")
    rows = [(1, "t", "a", None, 1, 0, 0, "story", "{}", T0), (0, "t", "a", None, 1, 0, 0, "story", "{}", T0),
            (2, "", "a", None, 1, 0, 0, "story", "{}", T0)]
    spark.createDataFrame(rows, schemas.STORIES_RAW).write.parquet(f"{root}/landing")
    stream = story_streams.read_story_stream(spark, f"{root}/landing")
    story_streams.upsert(stream, f"{root}/log", f"{root}/cp").awaitTermination()
    state = sinks.current_state(sinks.read_changes(spark, f"{root}/log", schemas.STORIES_RAW))
    assert [r.story_id for r in state.collect()] == [1]
    rejected = spark.read.parquet(f"{root}/log-rejected").collect()
    assert sorted((r.story_id, r.reject_reason) for r in rejected) == [(0, "missing id"), (2, "missing title")]


def test_event_time_needs_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            event_streams.with_event_time(spark.createDataFrame([(T0,)], "fetched_at timestamp_ntz"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_late_rows_are_kept_apart(spark):
    root = fresh_path(spark, "s")
    for rows in ([("1", 0), ("2", 10)], [("3", 3), ("4", 7), ("5", 20)], [("6", 13)]):
        land_events(spark, root, *rows)
        stream = event_streams.read_event_stream(spark, f"{root}/landing")
        event_streams.split_late(stream, root, f"{root}/cp", dt.timedelta(hours=6)).awaitTermination()
    ids = lambda late: sorted(r.event_id for r in event_streams.read_split(spark, root, late).collect())
    assert ids(False) == ["1", "2", "4", "5"] and ids(True) == ["3", "6"]


def test_a_backlog_is_taken_in_steps(spark):
    root = fresh_path(spark, "s")
    for k in range(4):
        land_events(spark, root, (str(k), k), ("0", k))
    stream = event_streams.read_event_stream(spark, f"{root}/landing", max_files=1)
    query = event_streams.store_first(stream, f"{root}/table", f"{root}/cp")
    query.awaitTermination()
    loads = read_loads(spark, f"{root}/table").where("repo_name is null").orderBy("load").collect()
    assert [r.received for r in loads] == [2, 2, 2, 2] and sum(r.inserted for r in loads) == 4


def test_a_stream_folds_its_log(spark):
    root = fresh_path(spark, "s")
    for k in range(3):
        rows = [(1, f"t{k}", "a", None, k, 0, k, "story", "{}", T0 + dt.timedelta(hours=k))]
        spark.createDataFrame(rows, schemas.STORIES_RAW).write.mode("append").parquet(f"{root}/landing")
        stream = story_streams.read_story_stream(spark, f"{root}/landing")
        story_streams.upsert(stream, f"{root}/log", f"{root}/cp", fold_every=2).awaitTermination()
    assert sinks.folded_upto(spark, f"{root}/log") == 1
    (row,) = sinks.current_state(sinks.read_changes(spark, f"{root}/log", schemas.STORIES_RAW)).collect()
    assert (row.title, row.score) == ("t0", 2)
