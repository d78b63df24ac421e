"""Writers: full refresh, upsert as a change log, counts of a load, views, export."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from devsignals import schemas
from devsignals.sources import landing

STORY_IDENTITY = ("title", "author", "url", "time", "type")
STORY_MUTABLE = ("score", "descendants", "raw_json", "fetched_at")


# --- full refresh -----------------------------------------------------------

def write_table(df: DataFrame, path: str, partition_by: str | None = None, sort_by: Sequence[str] = (),
                dynamic: bool = False, cluster_by: Sequence[str] = ()) -> None:
    """Replace a table, or with `dynamic` only the partitions that `df` holds.

    Rows of one partition value are brought together so that a value becomes few
    files; adaptive execution cuts a large value into several tasks and packs small
    ones. Sorting inside a task makes the min/max statistics of row groups selective. With
    `cluster_by`, each file holds a range of these columns' values, so the number of files follows from the bytes.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    keys = ([partition_by] if partition_by else []) + [c for c in sort_by if c != partition_by]
    if keys:
        df = df.sortWithinPartitions(*keys)
    writer = (
        df.write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table, unless there is one."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


# --- counts of a load ---------------------------------------------------------

_RULES = "spark.sql.adaptive.optimizer.excludedRules"


@contextmanager
def counts_kept(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution cuts off what lies below a stage without rows, and with it what was counted there. Not so in here."""
    before = spark.conf.get(_RULES, None)
    rule = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    spark.conf.set(_RULES, f"{before},{rule}" if before else rule)
    try:
        yield
    finally:
        if before:
            spark.conf.set(_RULES, before)
        else:
            spark.conf.unset(_RULES)


# --- keys (insert-if-absent is in `keyed`) -----------------------------------

def first_per_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in `order`. The filter on the row number is applied
    before the shuffle as well, so copies of a hot key never meet in one task."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def present_keys(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Keys of the batch that the target holds.

    The batch is the side that may be broadcast, and Spark does so when its size
    allows; then the large target is only scanned for its key column, not shuffled.
    """
    return target.select(key).join(batch.select(key).distinct(), key, "left_semi")


# --- upsert -----------------------------------------------------------------

CHANGE = [T.StructField("row_no", T.LongType()), T.StructField("row_hash", T.LongType()), T.StructField("seq", T.LongType())]
POINTER = T.StructType([T.StructField("upto", T.LongType())])


def append_changes(batch: DataFrame, path: str, seq: int) -> None:
    """Add one batch to the change log. Writing the same batch number again replaces
    it, so a repeated micro-batch changes nothing, and the target is never rewritten."""
    marked = batch.withColumns({"row_no": F.monotonically_increasing_id(), "row_hash": F.xxhash64(*batch.columns)})
    marked.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/seq={seq}")


def store_stories(batch: DataFrame, log: str, seq: int, fold_every: int | None = None) -> dict[str, int]:
    """One batch of stories, of a poll or a stream: good rows to the change log, the others with their reason
    to `<log>-rejected`. Returns received and stored rows and the rejected ones by reason, as the write has counted them; they are
    kept for `read_story_loads` as well. After every `fold_every` batches the log is folded."""
    counts, reason = Observation(), landing.reject_reason()
    counted = batch.observe(
        counts, F.count(F.lit(1)).alias("received"), F.count_if(reason.isNull()).alias("stored"),
        *[F.count_if(F.coalesce(reason == r, F.lit(False))).alias(r) for r in landing.REASONS])
    with counts_kept(batch.sparkSession):
        append_changes(landing.valid_stories(counted), log, seq)
    append_changes(landing.rejected_stories(batch), f"{log}-rejected", seq)
    seen = counts.get
    row = batch.sparkSession.range(1).select(F.lit(seq).cast("long").alias("load"), *[
        F.lit(n).cast("long").alias(name.replace(" ", "_")) for name, n in seen.items()])
    row.write.mode("overwrite").parquet(f"{log}-loads/load_number={seq}")
    if fold_every and (seq + 1) % fold_every == 0:
        fold(batch.sparkSession, log, schemas.STORIES_RAW)
    return seen


def read_story_loads(spark: SparkSession, log: str) -> DataFrame:
    """Per load: rows received, stored, and rejected by reason."""
    names = ["load", "received", "stored", *[r.replace(" ", "_") for r in landing.REASONS]]
    return spark.read.schema(", ".join(f"{n} long" for n in names)).parquet(f"{log}-loads").select(*names)


def folded_upto(spark: SparkSession, path: str) -> int | None:
    """The last batch that the newest base holds."""
    create_table(spark, f"{path}-pointer", POINTER)
    return spark.read.schema(POINTER).parquet(f"{path}-pointer").agg(F.max("upto")).first()[0]


def read_changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The changes that make up the state: the newest base, and the batches after it."""
    log = spark.read.schema(T.StructType(schema.fields + CHANGE)).parquet(path)
    upto = folded_upto(spark, path)
    if upto is None:
        return log
    base = spark.read.schema(T.StructType(schema.fields + CHANGE[:2])).parquet(f"{path}-base/upto={upto}")
    return base.withColumn("seq", F.lit(upto).cast("long")).unionByName(log.where(F.col("seq") > upto))


def _ends(log: DataFrame, key: str) -> DataFrame:
    """Per key, where its first and its last row stand, from narrow columns."""
    order = F.struct("seq", "fetched_at", "row_hash", "row_no")
    return log.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))


def current_state(log: DataFrame, key: str = "story_id", identity: Sequence[str] = STORY_IDENTITY,
                  mutable: Sequence[str] = STORY_MUTABLE) -> DataFrame:
    """State after all upserts: identity columns as first seen, mutable ones as last seen, NULLs included.

    Per key, the first and the last row are found from narrow columns, combined before the shuffle, so hot keys are no load.
    Their wide columns are fetched afterwards by row: two hash joins, in which no wide row is sorted. Identity comes last, so
    it is moved once; of `mutable`, name what is needed: it is moved twice.
    """
    ends = _ends(log, key)

    def rows(side: str, columns: Sequence[str]) -> DataFrame:
        return log.select(F.col(key).alias(f"_{side}_key"), F.col("seq").alias(f"_{side}_seq"), F.col("row_no").alias(f"_{side}_no"), *columns)

    def of(side: str, end: str):
        return (F.col("_key").eqNullSafe(F.col(f"_{side}_key")) & (F.col(f"{end}.seq") == F.col(f"_{side}_seq"))
                & (F.col(f"{end}.row_no") == F.col(f"_{side}_no")))

    latest = rows("b", mutable).join(ends.hint("shuffle_hash"), of("b", "_last")).select("_key", "_first", *mutable)
    return rows("a", identity).join(latest.hint("shuffle_hash"), of("a", "_first")).select(F.col("_key").alias(key), *identity, *mutable)


def folded_state(log: DataFrame, key: str = "story_id", identity: Sequence[str] = STORY_IDENTITY,
                 mutable: Sequence[str] = STORY_MUTABLE) -> DataFrame:
    """The rows of `current_state`, for a log most of whose keys have one row, such as one that is folded.

    Two bits for each row, whether it is the first and the last of its key, are broadcast. A row that is both is the state as
    it stands and is not moved; of other keys, the first row's identity and the last row's mutable columns meet by key, and
    what lies between is not moved either.
    """
    ends = _ends(log, key)
    found = ends.select(F.inline(F.array(*[
        F.struct(F.col(f"{end}.seq").alias("_seq"), F.col(f"{end}.row_no").alias("_no"), F.lit(end).alias("_end"))
        for end in ("_first", "_last")])))
    bits = found.groupBy("_seq", F.bitmap_bucket_number("_no").alias("_bucket")).agg(*[
        F.bitmap_construct_agg(F.when(F.col("_end") == end, F.bitmap_bit_position("_no"))).alias(end) for end in ("_first", "_last")])

    def bit(end: str) -> Column:
        place = F.bitmap_bit_position("row_no")
        byte = F.conv(F.hex(F.substring(end, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("getbit", byte, (place % 8).cast("int")) == 1

    at = (F.col("seq") == F.col("_seq")) & (F.bitmap_bucket_number("row_no") == F.col("_bucket"))
    marked = log.join(F.broadcast(bits), at).select(*log.columns, bit("_first").alias("_is_first"), bit("_last").alias("_is_last"))
    first, last = F.col("_is_first"), F.col("_is_last")
    alone = marked.where(first & last).select(key, *identity, *mutable)
    named = marked.where(first & ~last).select(F.col(key).alias("_key"), *identity)
    latest = marked.where(last & ~first).select(key, *mutable)
    paired = latest.join(named.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("_key"))).select(key, *identity, *mutable)
    return alone.unionByName(paired)


def fold(spark: SparkSession, path: str, schema: T.StructType, key: str = "story_id", identity: Sequence[str] = STORY_IDENTITY,
         mutable: Sequence[str] = STORY_MUTABLE) -> None:
    """Write the state as a new base and then point to it. Until the pointer is there, readers use the base before; with it
    they read the new base and later batches only. The fold keeps the first identity and the last mutable
    values, and so does folding again."""
    last = spark.read.schema(T.StructType(schema.fields + CHANGE)).parquet(path).agg(F.max("seq")).first()[0]
    if last is None or last == folded_upto(spark, path):
        return
    state = folded_state(read_changes(spark, path, schema), key, identity, mutable).select(*schema.names)
    marked = state.withColumns({"row_no": F.monotonically_increasing_id(), "row_hash": F.lit(0).cast("long")})
    marked.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}-base/upto={last}")
    spark.createDataFrame([(last,)], POINTER).coalesce(1).write.mode("append").parquet(f"{path}-pointer")


def compact(spark: SparkSession, log_path: str, new_path: str, schema: T.StructType) -> None:
    """Fold a change log into one batch at a new place. Later batches go on top of it."""
    state = folded_state(read_changes(spark, log_path, schema)).select(*schema.names)
    append_changes(state, new_path, 0)


def upsert_statistics(batch: DataFrame, target: DataFrame, key: str = "story_id") -> DataFrame:
    """One row: keys inserted and keys updated."""
    keys = batch.select(key).distinct()
    known = present_keys(target, batch, key).distinct().withColumn("known", F.lit(True))
    return keys.join(known, key, "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"),
        F.count_if(F.col("known").isNotNull()).alias("updated"),
    )


# --- views and export -------------------------------------------------------

def register_views(frames: dict[str, DataFrame]) -> None:
    """Make datasets available to SQL; nothing is computed."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
