"""Lines of documents by host: normalised form, hash, and the number of pages that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def normalised(line: Column) -> Column:
    """Trimmed, lower case, runs of white space as one space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x09-\x0D\x20]+", " "))


def line_hash(line: Column) -> Column:
    """64 bits of a normalised line; compared within one host only. Null for an empty line."""
    form = normalised(line)
    return F.when(form != "", F.xxhash64(form))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def host_of_url(url: Column) -> Column:
    """Lower-case host of a URL; null when there is none."""
    return F.lower(F.parse_url(url, F.lit("HOST")))


def pages_per_line(pages: DataFrame) -> DataFrame:
    """From rows (host, lines: distinct hashes of a page): host, line, n_pages.

    A page counts once for each line, so counting is a plain sum, combined before the shuffle: a
    host or a line that holds a third of all rows arrives as one row per task.
    """
    return (pages.select("host", F.explode("lines").alias("line"))
            .groupBy("host", "line").agg(F.count("*").alias("n_pages")))
