"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "devsignals", master: str | None = None, input_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the engine is tuned for; `conf` overrides them.

    `input_bytes`, the size of what a run reads, sets the number of shuffle partitions and the split size.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if input_bytes is not None:
        settings.update(settings_for(input_bytes))
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settings_for(input_bytes: int, shuffled_part: float = 0.1, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Sizes for a given amount of input: enough shuffle partitions that each fits into
    a task's memory (adaptive execution merges those that stay small), larger splits."""
    partitions = max(200, -(-int(input_bytes * shuffled_part) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="devsignals-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/devsignals/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


_scope: ContextVar[list[str] | None] = ContextVar("intermediates", default=None)


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-computation,
    and whatever was drawn while writing (partition numbers, ranges) is now data.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates_dropped(spark: SparkSession) -> Iterator[None]:
    """What is `written` in here, by this thread or in copies of its context, is deleted on leaving. For steps whose own result is stored elsewhere by then; frames
    that still read an intermediate must not be used afterwards."""
    scope: list[str] = []
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in scope:
            drop_folder(spark, path)


def _located(spark: SparkSession, path: str):
    """A path and the file system it is on, as Spark's writers see it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, system = _located(spark, path)
    return system.exists(where)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that `fresh_path` has named, or what lies in one, and nothing else."""
    if not path.startswith(f"{shared_folder(spark)}/devsignals/{spark.sparkContext.applicationId}/"):
        raise ValueError(f"not an intermediate of this application: {path}")
    where, system = _located(spark, path)
    system.delete(where, True)


def drop_partition(spark: SparkSession, table: str, partition: str) -> None:
    """Delete one folder `column=value` of a table."""
    if "/" in partition or "=" not in partition:
        raise ValueError(f"not a partition: {partition}")
    where, system = _located(spark, f"{table}/{partition}")
    system.delete(where, True)
