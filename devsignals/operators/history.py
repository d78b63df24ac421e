"""Type-2 history of dimension attributes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from devsignals.functions import times


def start_history(snapshot: DataFrame, key: str, attributes: Sequence[str], valid_from: dt.datetime) -> DataFrame:
    return snapshot.select(
        key,
        *attributes,
        times.moment(valid_from).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def read_history(spark: SparkSession, path: str, number: int, schema: T.StructType) -> DataFrame:
    """A stored history as of its snapshot `number`. A version ends where the next of its key begins."""
    key, *attributes = [f for f in schema.fields if f.name not in ("valid_from", "valid_to", "is_current")]
    versions = _versions(spark, path, [key, *attributes]).filter(F.col("seq") <= number)
    end = F.lead("valid_from").over(Window.partitionBy(key.name).orderBy("seq"))
    return versions.withColumn("valid_to", end).withColumn("is_current", F.col("valid_to").isNull()).select(*schema.names)


def _versions(spark: SparkSession, path: str, fields: Sequence[T.StructField]) -> DataFrame:
    added = [T.StructField("valid_from", T.TimestampNTZType()), T.StructField("seq", T.LongType())]
    return spark.read.schema(T.StructType([*fields, *added])).parquet(path)


def store_snapshot(path: str, number: int, snapshot: DataFrame, key: str, attributes: Sequence[str], seen_at: dt.datetime) -> None:
    """Append what snapshot `number` (0 is the first) has changed: keys that are new or whose attributes differ from their
    last version. What is stored stays as it is, and a snapshot without changes adds no row. Storing a number again
    replaces it by the same rows."""
    rows = snapshot.select(key, *attributes)
    if number:
        before = _versions(rows.sparkSession, path, rows.schema.fields).filter(F.col("seq") < number)
        last = before.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*attributes), "seq").alias("_last"))
        joined = rows.join(last, F.col(key).eqNullSafe(F.col("_key")), "left")
        rows = joined.filter(~F.struct(*attributes).eqNullSafe(F.col("_last"))).select(key, *attributes)
    rows.withColumn("valid_from", times.moment(seen_at)).write.mode("overwrite").parquet(f"{path}/seq={number}")


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, attributes: Sequence[str],
                   seen_at: dt.datetime) -> DataFrame:
    """Close current rows whose attributes changed and add the new state; keys that are
    missing from the snapshot stay as they are. One join on the key; a changed row
    becomes two by unrolling."""
    old, new, moment = F.col("old"), F.col("new"), times.moment(seen_at)
    current = history.filter("is_current").select(key, F.struct(*attributes, "valid_from").alias("old"))
    fresh = snapshot.select(key, F.struct(*attributes).alias("new"))
    joined = current.join(fresh, key, "full_outer")
    same = F.lit(True)
    for a in attributes:
        same = same & new[a].eqNullSafe(old[a])
    open_end = F.lit(None).cast("timestamp_ntz")

    def version(side, valid_from, valid_to, is_current):
        return F.struct(*[side[a].alias(a) for a in attributes], valid_from.alias("valid_from"),
                        valid_to.alias("valid_to"), F.lit(is_current).alias("is_current"))

    kept = version(old, old["valid_from"], open_end, True)
    closed = version(old, old["valid_from"], moment, False)
    added = version(new, moment, open_end, True)
    versions = (
        F.when(new.isNull() | (old.isNotNull() & same), F.array(kept))
        .when(old.isNull(), F.array(added))
        .otherwise(F.array(closed, added))
    )
    return history.filter(~F.col("is_current")).unionByName(joined.select(key, F.inline(versions)))
