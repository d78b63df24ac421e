"""Continuous upsert of stories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from devsignals import schemas
from devsignals.sources import sinks
from devsignals.streaming import triggered


def read_story_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(schemas.STORIES_RAW).parquet(folder)


def upsert(stream: DataFrame, log: str, checkpoint: str, every: str | None = None, fold_every: int | None = 100) -> StreamingQuery:
    """Append each micro-batch to the change log under its own number, so that a
    repeated one replaces itself. Rows that cannot be stored go to `<log>-rejected`.
    The log is folded after every `fold_every` micro-batches."""
    def store(batch: DataFrame, number: int) -> None:
        sinks.store_stories(batch, log, number, fold_every)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()
