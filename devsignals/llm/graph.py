"""Connected components of a graph of numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from devsignals.session import written


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, component (smallest node reachable) for every node of the edges (columns a, b).

    Large-star and small-star steps in turn (Kiveris et al. 2014) until the edges are stars that do not
    change. Each step is a minimum per node, combined before its shuffle, and one join that adaptive
    execution can split; its result is written to the shared folder. The number of steps grows with the
    logarithm of the longest path.
    """
    current = written(_ordered(edges).distinct(), label)
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _ordered(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        current = written(_ordered(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))).distinct(), label)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    """Larger node first, no loops."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
