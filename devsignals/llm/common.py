"""Helpers shared by the operators: tables, folds, text slices in tasks, hashes of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % parts


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit hashes of a row's columns: `k1`, `k2`. Only equal rows share both."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in columns]
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(7), *reversed(cols)).alias("k2")]


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Row ranges of a batch with at most `limit` bytes of text each (one row at least), and their
    texts as bytes; null counts as empty. Bounds what a task holds whatever the batch size."""
    col = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = batch.slice(start, stop - start)
        raw = part.column(part.schema.get_field_index(column)).cast(pa.binary())
        yield part, [x or b"" for x in raw.to_pylist()]
        start = stop


def offsets_of(lengths) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(lengths, dtype=np.int64))])


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of `values` between consecutive `starts`; empty segments give 0."""
    out = np.zeros((starts.size - 1,) + values.shape[1:], dtype=np.float64)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if full.size:
        out[full] = np.add.reduceat(values, starts[:-1][full], axis=0, dtype=np.float64)
    return out


def extended(schema: T.StructType, **fields: str) -> T.StructType:
    """A copy of the schema with further fields."""
    added = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    return T.StructType(schema.fields + added.fields)
