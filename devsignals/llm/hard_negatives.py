"""Hard negatives by BOND: a vertical scan that reads dimension after dimension and drops rows that no longer matter.

For an anchor, its positives are the `POSITIVES` rows of its label with the highest inner products. For each
positive, the hard negatives are the first `NEGATIVES` rows of other labels whose score lies in a window below the
positive's score (`WINDOW`, shares of it). Scores are exact integers: components are floor(256 x).

Rows are stored in blocks by column: one array per dimension, with its smallest and largest value. For an anchor, dimensions
are read in descending order of the anchor's magnitude, `STEP` at a time. After each step, a row's score lies between its
partial sum plus the least and the most that the remaining dimensions can add. The bitmap of candidates shrinks by
these bounds: for positives, rows whose most is below the k-th largest least; for negatives, rows outside every window, or
whose most is below what `NEGATIVES` rows of a window surely reach. The scan ends when all dimensions are read or
few candidates are left, which are then scored exactly; ties stay in, and go by vec_id.

Anchors are a fixed share of the rows, so they are not broadcast: rows and anchors are dealt to cells of a grid, each with
one block of rows and one chunk of anchors of bounded size, and meet there by a join on the cell. A cell gives at most k rows
an anchor and window; they are merged by one ranking per anchor. Positives are found first, windows follow from
them. Every anchor meets every row: the method searches exactly, and its work is rows times anchors.

Defined cases: rows with a null label, vector or vec_id, or with a null or non-finite component take no part.
Equal rows count once; rows that share a vec_id are never each other's positive or negative. A missing component
(vectors of other lengths) counts as 0. Components are held within +-2^27 after scaling, so sums of up to 256 dimensions cannot
overflow. A negative score has no window. No anchors, or no positives: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from devsignals.session import written

POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)          # per cent of the positive's score
ANCHOR_EVERY = 50
RELABEL_EVERY = 7
LABELS = 10
SCALE = 256
LIMIT = 1 << 27
BLOCK = 4096               # rows of a block
CHUNK = 4096               # anchors of a chunk
STEP = 8                   # dimensions read between two checks of the bitmap
FEW = 64                   # candidates that are scored at once


class Block:
    """Rows of a block by column, and what each dimension can add at least and at most."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        width = max((len(v) for v in vectors), default=0)
        rows = np.zeros((len(vectors), width), dtype=np.int64)
        for k, v in enumerate(vectors):
            rows[k, :len(v)] = v
        self.columns = np.ascontiguousarray(rows[order].T)
        self.low = self.columns.min(axis=1) if len(vectors) else np.zeros(width, np.int64)
        self.high = self.columns.max(axis=1) if len(vectors) else np.zeros(width, np.int64)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, shrink):
        """Rows and exact scores that `shrink(rows, least, most)` (a mask of rows to keep) lets through to the end."""
        width = min(len(anchor), len(self.columns))
        anchor = anchor[:width]
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[anchor[order] != 0]
        one, other = anchor * self.low[:width], anchor * self.high[:width]
        rest_low = np.concatenate([np.cumsum(np.minimum(one, other)[order][::-1])[::-1], [0]])
        rest_high = np.concatenate([np.cumsum(np.maximum(one, other)[order][::-1])[::-1], [0]])
        rows, partial = np.flatnonzero(alive), np.zeros(int(alive.sum()), dtype=np.int64)
        at = 0
        while at < order.size and rows.size:
            dims = order[at:] if rows.size <= FEW else order[at:at + STEP]
            if rows.size == self.ids.size:
                partial = partial + anchor[dims] @ self.columns[dims]
            else:
                partial = partial + anchor[dims] @ self.columns[dims][:, rows]
            at += dims.size
            keep = shrink(rows, partial + rest_low[at], partial + rest_high[at])
            if not keep.all():
                rows, partial = rows[keep], partial[keep]
        return rows, partial


def kth_largest(values: np.ndarray, k: int):
    return np.partition(values, values.size - k)[values.size - k] if values.size >= k else None


def positives_of(block: Block, anchor_id: int, label: int, vector: np.ndarray, k: int = POSITIVES):
    """The block's first k rows of the anchor's label: ids and scores."""
    def shrink(rows, least, most):
        floor = kth_largest(least, k)
        return np.ones(rows.size, bool) if floor is None else most >= floor

    rows, scores = block.scan(vector, (block.labels == label) & (block.ids != anchor_id), shrink)
    first = np.lexsort((block.ids[rows], -scores))[:k]
    return block.ids[rows[first]], scores[first]


def negatives_of(block: Block, anchor_id: int, label: int, vector: np.ndarray, scores: np.ndarray, k: int = NEGATIVES):
    """For each positive's score: the block's first k rows of other labels inside its window."""
    low, high = -(-WINDOW[0] * scores // 100), WINDOW[1] * scores // 100

    def shrink(rows, least, most):
        keep = np.zeros(rows.size, bool)
        for a, b in zip(low, high):
            inside = (most >= a) & (least <= b)
            floor = kth_largest(least[(least >= a) & (most <= b)], k)      # rows that are surely inside
            keep |= inside if floor is None else inside & (most >= floor)
        return keep

    rows, found = block.scan(vector, (block.labels != label) & (block.ids != anchor_id), shrink)
    order = np.lexsort((block.ids[rows], -found))
    rows, found = rows[order], found[order]
    for n, (a, b) in enumerate(zip(low, high)):
        at = np.flatnonzero((found >= a) & (found <= b))[:k]
        yield n, block.ids[rows[at]], found[at]


def prepared(embeddings: DataFrame) -> DataFrame:
    """id, label, vector (whole numbers) of the rows that take part; equal rows once."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), v)).cast("int"))
    infinite = float("inf")
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(infinite)))
    label = F.col("label").cast("long")
    rows = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & sound)
    return rows.select(
        F.col("vec_id").cast("long").alias("id"),
        F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        whole.alias("vector")).distinct()


def per_cell(rows: DataFrame, anchors: DataFrame, find, schema: str, block: int, chunk: int) -> DataFrame:
    """`find(Block, anchors)` for every block of rows and every chunk of anchors (anchor_id, anchor_label, ...). The grid's size follows from the
    numbers of rows and anchors, so that a cell has about `block` and `chunk` of them."""
    n_blocks = max(1, -(-rows.count() // block))
    n_chunks = max(1, -(-anchors.count() // chunk))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt_rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "label"), n_blocks).cast("int")).withColumn("chunk", every(n_chunks))
    dealt_anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor_id", "anchor_label"), n_chunks).cast("int")).withColumn("block", every(n_blocks))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own = Block(left["id"].to_numpy(), left["label"].to_numpy(), list(left["vector"]))
        return find(own, right)

    return (dealt_rows.groupBy("block", "chunk").cogroup(dealt_anchors.groupBy("block", "chunk"))
            .applyInPandas(cell, schema))


def positives(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, label, vector, and the arrays positive_ids and positive_scores, best first."""
    def find(own: Block, chunk_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, label, vector in zip(*[chunk_rows[c] for c in ("anchor_id", "anchor_label", "anchor")]):
            ids, scores = positives_of(own, a, label, np.asarray(vector, dtype=np.int64), k)
            out += [(a, label, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        return pd.DataFrame(out, columns=["anchor_id", "anchor_label", "positive_id", "positive_score"])

    found = per_cell(rows, anchors, find, "anchor_id long, anchor_label long, positive_id long, positive_score long", block, chunk)
    best = Window.partitionBy("anchor_id", "anchor_label").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def mine(embeddings: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = written(prepared(embeddings), "bond-rows")
    anchors = rows.where(F.col("id") % ANCHOR_EVERY == 0).select(
        F.col("id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("vector").alias("anchor"))
    pairs = written(positives(rows, anchors, POSITIVES, block, chunk), "bond-positives")
    wanted = pairs.groupBy("anchor_id", "anchor_label").agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("own"))
    asking = anchors.join(wanted, ["anchor_id", "anchor_label"]).select(
        "anchor_id", "anchor_label", "anchor", F.col("own.positive_id").alias("positive_ids"), F.col("own.positive_score").alias("scores"))

    def find(own: Block, chunk_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, label, vector, ids, scores in zip(*[chunk_rows[c] for c in ("anchor_id", "anchor_label", "anchor", "positive_ids", "scores")]):
            for n, found, values in negatives_of(own, a, label, np.asarray(vector, dtype=np.int64), np.asarray(scores, dtype=np.int64)):
                out += [(a, int(ids[n]), int(scores[n]), i, s) for i, s in zip(found.tolist(), values.tolist())]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    found = per_cell(rows, asking, find, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
                     block, chunk)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def query(embeddings: DataFrame) -> DataFrame:
    return mine(embeddings.select("vec_id", "embedding", "label"))


SQL = f"""
WITH r AS (
    SELECT vec_id AS id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.id AS anchor_id, a.label AS anchor_label, b.id, b.label,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
    FROM r a JOIN r b ON a.id <> b.id WHERE a.id % {ANCHOR_EVERY} = 0),
p AS (
    SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> p.anchor_label
    AND {WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW[1]} * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= {NEGATIVES}
"""
