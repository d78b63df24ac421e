"""A table with one row per key, in folders by hash bucket of the key.

A load looks only into the buckets its keys fall into, and there only into row groups whose smallest and largest key
leave room for them; rows are sorted by key within a file, and each file has a bloom filter on the key. What a load did is
counted by the write itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from devsignals import schemas
from devsignals.functions.numeric import percent
from devsignals.session import written
from devsignals.sources import sinks

BUCKET = "key_bucket"
LOADS = "load long, repo_name string, received long, inserted long, errors long"


@dataclass(frozen=True)
class KeyedTable:
    """`buckets` is fixed when the table is made: about its final size over a gigabyte. Of rows with the same key in a load
    the first in `order` is stored; a stored row never changes."""

    spark: SparkSession
    path: str
    schema: T.StructType = schemas.EVENTS_RAW
    key: str = "event_id"
    order: tuple[str, ...] = ("fetched_at", "raw_payload")
    buckets: int = 32

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _files(self) -> DataFrame:
        schema = T.StructType(self.schema.fields + [T.StructField(BUCKET, T.IntegerType())])
        # a folder that no load has written yet is an empty table
        self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy(BUCKET).parquet(self.path)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._files().select(*self.schema.names)

    def rows_of(self, keys: Sequence[str]) -> DataFrame:
        """The rows of a few keys: their folders, and there the files whose bloom filters may hold them."""
        wanted = [r[0] for r in self.spark.createDataFrame([(k,) for k in keys], f"{self.key} string").select(self.bucket()).collect()]
        return self._files().where(F.col(BUCKET).isin(sorted(set(wanted))) & F.col(self.key).isin(list(keys))).select(*self.schema.names)

    def present(self, batch: DataFrame) -> DataFrame:
        """The keys of the batch that are stored. One row comes back first: the batch's buckets (at most `buckets`
        numbers) and its smallest and largest key. The batch is the side that may be broadcast; the table is not shuffled then."""
        keys = batch.where(F.col(self.key).isNotNull()).select(self.key)
        bounds = keys.agg(F.collect_set(self.bucket()).alias("touched"), F.min(self.key).alias("low"), F.max(self.key).alias("high")).first()
        near = F.col(BUCKET).isin(sorted(bounds.touched)) & F.col(self.key).between(F.lit(bounds.low), F.lit(bounds.high))
        return self._files().where(near).select(self.key).join(keys.distinct(), self.key, "left_semi")

    def insert(self, batch: DataFrame, groups: Sequence[str] = (), group_column: str = "repo_name") -> list[tuple]:
        """Append the rows with a new key. Repeating a batch adds nothing; rows without a key cannot be stored.

        Returns (group, received, inserted, errors) for all rows (group None) and each of `groups`, as the write
        has counted them. What is inserted is counted where it is written; should an executor be lost, tasks that read the batch
        again count again, so `received` may then be too high.
        """
        arriving, leaving = Observation(), Observation()
        parts = [F.lit(True), *[F.col(group_column) == g for g in groups]]
        missing = F.col(self.key).isNull()
        counted = batch.observe(arriving, *[F.count_if(p).alias(f"received_{k}") for k, p in enumerate(parts)],
                                *[F.count_if(p & missing).alias(f"errors_{k}") for k, p in enumerate(parts)])
        first = sinks.first_per_key(counted.where(~missing), self.key, list(self.order))
        fresh = first.join(self.present(batch), self.key, "left_anti").observe(
            leaving, *[F.count_if(p).alias(f"inserted_{k}") for k, p in enumerate(parts)])
        with sinks.counts_kept(batch.sparkSession):
            self._write(fresh.select(*self.schema.names, self.bucket().alias(BUCKET)), "append")
        seen, stored = arriving.get, leaving.get
        return [(g, seen[f"received_{k}"], stored[f"inserted_{k}"], seen[f"errors_{k}"])
                for k, g in enumerate([None, *groups])]

    def _write(self, rows: DataFrame, mode: str) -> None:
        (rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, self.key).write.mode(mode)
         .option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy(BUCKET).parquet(self.path))

    def merge_files(self, most: int = 16) -> list[int]:
        """Rewrite the buckets that have more than `most` files, each as few sorted ones; their numbers. Between loads only."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(self.path)
        number = F.regexp_extract("path", f"{BUCKET}=([0-9]+)", 1).cast("int")
        many = [r.bucket for r in files.groupBy(number.alias("bucket")).count().where(f"count > {int(most)}").collect()]
        if many:
            staged = written(self._files().where(F.col(BUCKET).isin(many)), "merged-buckets")
            self._write(staged, "overwrite")
        return sorted(many)


def record_load(spark: SparkSession, path: str, load: int, counts: list[tuple]) -> None:
    """Store the counts of a load beside the table; storing a load again replaces it."""
    rows = spark.createDataFrame([(load, *c) for c in counts], LOADS)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}-loads/load_number={load}")


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """Per load and repository (null: all): received, inserted, duplicates, errors, inserted percent."""
    rows = spark.read.schema(LOADS).parquet(f"{path}-loads").select("load", "repo_name", "received", "inserted", "errors")
    return rows.select(
        "load", "repo_name", "received", "inserted", (F.col("received") - F.col("inserted") - F.col("errors")).alias("duplicates"),
        "errors", F.coalesce(percent(F.col("inserted"), F.col("received"), 1), F.lit(0.0)).alias("success_rate_pct"))
