"""Continuous ingestion."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval such as '1 minute', or take what has landed and stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
