"""Continuous ingestion of events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from devsignals import params, schemas
from devsignals.functions import times
from devsignals.sources import sinks
from devsignals.sources.keyed import KeyedTable, record_load
from devsignals.streaming import triggered


def with_event_time(stream: DataFrame) -> DataFrame:
    """Watermarks need a time with zone. Stored times mean UTC, so the session must be in UTC."""
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"streams by event time need spark.sql.session.timeZone=UTC, not {zone}")
    return stream.withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def read_event_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """`max_files` bounds what one micro-batch takes, so that a backlog is worked off in steps."""
    reader = spark.readStream.schema(schemas.EVENTS_RAW)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(landing)


def store_first(stream: DataFrame, target: str, checkpoint: str, every: str | None = None,
                groups: Sequence[str] = params.REPOSITORY_NAMES) -> StreamingQuery:
    """Keep the first event of each id, exactly: each micro-batch is an insert-if-absent, which looks into the buckets of
    its own ids only. What it did is in `read_loads(target)`, per micro-batch and repository.

    A micro-batch repeated after a failure finds its rows stored and adds nothing.
    """
    def store(batch: DataFrame, number: int) -> None:
        counts = KeyedTable(batch.sparkSession, target).insert(batch, groups)
        record_load(batch.sparkSession, target, number, counts)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


MARKS = "seq long, newest timestamp_ntz"


def split_late(stream: DataFrame, root: str, checkpoint: str, delay: dt.timedelta, every: str | None = None) -> StreamingQuery:
    """Rows in time, and rows behind the watermark that a stateful operator would drop, each for `read_split`; none is lost.

    The watermark is the newest event time of all micro-batches before, less `delay`, as Spark's own; it is stored per micro-batch,
    so that a repeated one is split as before and replaces itself. A row without a time is in time.
    """
    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        sinks.create_table(spark, f"{root}/marks", T.StructType.fromDDL(MARKS))
        marks = spark.read.schema(MARKS).parquet(f"{root}/marks")
        newest = marks.where(F.col("seq") < number).agg(F.max("newest")).first()[0]
        behind = F.lit(False) if newest is None else F.coalesce(F.col("fetched_at") < times.moment(newest - delay), F.lit(False))
        seen = Observation()
        with sinks.counts_kept(spark):
            marked = batch.observe(seen, F.max("fetched_at").alias("newest")).withColumn("late", behind)
            # one pass over the batch: both kinds side by side, in folders of their own
            marked.write.mode("overwrite").partitionBy("late").parquet(f"{root}/split/seq={number}")
        spark.createDataFrame([(number, seen.get["newest"])], MARKS).coalesce(1).write.mode("append").parquet(f"{root}/marks")

    writer = stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def read_split(spark: SparkSession, root: str, late: bool) -> DataFrame:
    schema = T.StructType(schemas.EVENTS_RAW.fields + [T.StructField("seq", T.LongType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(schema).parquet(f"{root}/split").where(F.col("late") == late).select(*schemas.EVENTS_RAW.names)


def first_within(stream: DataFrame, delay: str) -> DataFrame:
    """First event of each id with bounded state: repeats are caught for `delay` only."""
    return with_event_time(stream).withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["event_id"])


def daily_counts(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events per repository and day; a day is given out once the watermark has passed it."""
    return (
        with_event_time(stream).withWatermark("fetched_at", delay)
        .groupBy(F.window("fetched_at", "1 day"), "repo_name")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.to_date("window.start").alias("activity_date"), "repo_name", "event_count")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer.option("path", path), every).start()
