"""Near-duplicates by SimHash: BK-trees of fingerprints over shards that every link falls into.

Fingerprints are 64 bits; two link at `RADIUS` or fewer differing bits. With the bits cut
into blocks, `BLOCKS` or more as the corpus grows, linked fingerprints agree in at least all but RADIUS blocks, so they meet in a
shard named by some choice of so many blocks and their values. Each shard holds a BK-tree: children
keyed by their integer Hamming distance to the parent; a search at distance d follows only the edges
from d - RADIUS to d + RADIUS. Shards of at least two fingerprints go to tasks, which build and search the trees of
all their shards in rounds over flat arrays and return, per shard, a star of links for each
group found, never all its pairs. Components over these links are then found by Spark.

A shard's trees go to the tasks by shuffle, not by broadcast: their size grows with the data.
Copies are one fingerprint before anything else. A shard above `SHARD_LIMIT` fingerprints is cut into
trees of about that size, and every tree meets the fingerprints of each tree before it in a group of their own, where those are
searched in it. So no link is lost, and no group holds more than the members of two trees.

Defined cases: null and empty texts have fingerprint 0 and link like any other. A null doc_id counts as
no document for naming a component: if a component has no other, its id is null. Repeated rows are
each returned. Extra columns are ignored by the query and kept by the stage.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import extended, offsets_of, text_slices
from devsignals.llm.graph import components
from devsignals.session import written

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS = 6                   # at least; more where shards would be larger than SHARD_SIZE
SHARD_SIZE = 512
SHARD_LIMIT = 4096
FRONTIER = 1 << 21


def fingerprints_of(texts: list[bytes], width: int = SHINGLE) -> np.ndarray:
    out = np.zeros(len(texts), dtype=np.uint64)
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for k, raw in enumerate(texts):
        words = raw.lower().split()
        if not words:
            continue
        if len(words) <= width:
            out[k] = digest(b" ".join(words), SEED)
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends[width - 1:].tolist())),
                             np.uint64, len(words) - width + 1)
        counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = powers[2 * counts > hashes.size].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Adds `fp` (the 64 bits as a signed number) in place of the text."""
    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                out = [part.column(i) for i, n in enumerate(part.schema.names) if n != "text"]
                names = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    out + [pa.array(fingerprints_of(texts, width).view(np.int64), pa.int64())], names=names + ["fp"])

    return docs.mapInArrow(run, extended(docs.drop("text").schema, fp="long"))


class Forest:
    """BK-trees over the fingerprints of several shards, as flat arrays; `tree` numbers are sorted."""

    def __init__(self, prints: np.ndarray, tree: np.ndarray):
        n = prints.size
        self.prints = prints
        self.root = np.searchsorted(tree, tree)                   # the first of each tree
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        at = np.flatnonzero(self.root != np.arange(n))
        node = self.root[at]
        while at.size:
            slot = node * 128 + np.bitwise_count(prints[at] ^ prints[node])
            taken, first = np.unique(slot, return_index=True)       # the first of a slot becomes the child
            child = at[first]
            parent[child], edge[child] = taken // 128, taken % 128
            left = np.ones(at.size, dtype=bool)
            left[first] = False
            node = child[np.searchsorted(taken, slot[left])]
            at = at[left]
        inner = np.flatnonzero(parent >= 0)
        key = parent[inner] * 128 + edge[inner]
        order = np.argsort(key, kind="stable")
        self.keys, self.children = key[order], inner[order]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int = RADIUS):
        """Yields pairs (query number, node) within the radius; a query starts at its root."""
        query, node = np.arange(queries.size), roots
        while query.size:
            distance = np.bitwise_count(queries[query] ^ self.prints[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.keys, node * 128 + np.maximum(distance - radius, 0), side="left")
            high = np.searchsorted(self.keys, node * 128 + distance + radius, side="right")
            n = high - low
            query = np.repeat(query, n)
            node = self.children[np.repeat(low - offsets_of(n)[:-1], n) + np.arange(n.sum())]


def union(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Joins the sets of linked items; every item's label is the smallest number of its set."""
    while left.size:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def links_of(shard: np.ndarray, prints: np.ndarray, is_member: np.ndarray, radius: int = RADIUS):
    """Star links of the groups in sorted shards: pairs of row numbers. Members stand in the shard's tree
    (first); the others are searched in it. Where there are others, the members themselves are not: another group does that."""
    order = np.lexsort((~is_member, shard))
    shard, prints, is_member = shard[order], prints[order], is_member[order]
    start = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    count = np.diff(np.concatenate([start, [shard.size]]))
    of = np.repeat(np.arange(start.size), count)
    members = np.flatnonzero(is_member)
    forest = Forest(prints[members], shard[members])
    first_member = np.searchsorted(members, start)
    there = first_member < np.concatenate([first_member[1:], [members.size]])
    labels = np.arange(shard.size)
    guests = np.bincount(of[~is_member], minlength=start.size) > 0
    queries = np.flatnonzero(there[of] & (~is_member | ~guests[of]))
    cost = np.cumsum(np.bincount(of[members], minlength=start.size)[of[queries]])
    while queries.size:
        stop = max(1, int(np.searchsorted(cost, FRONTIER)))
        now, queries = queries[:stop], queries[stop:]
        cost = cost[stop:] - cost[stop - 1]
        for query, node in forest.search(prints[now], first_member[of[now]], radius):
            union(labels, now[query], members[node])
    linked = np.flatnonzero(labels != np.arange(shard.size))
    return order[linked], order[labels[linked]]


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """Blocks such that a shard of n evenly spread fingerprints has about `SHARD_SIZE` of them, so that visits grow with n and
    not with its square. Any number of blocks finds every link."""
    blocks = BLOCKS
    while blocks < 16 and n / 2 ** (64 * (blocks - radius) / blocks) > SHARD_SIZE:
        blocks += 1
    return blocks


def shard_links(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None, limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (fp a, fp b) that connect exactly the distinct fingerprints (column fp) within the radius."""
    blocks = blocks or blocks_for(prints.count(), radius)
    bounds = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(bounds[:-1], bounds[1:])]
    chosen = [sum(c) for c in combinations(masks, blocks - radius)]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    names = F.array(*[F.struct(F.lit(k).alias("cut"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("value"))
                      for k, m in enumerate(chosen)])
    rows = prints.select("fp", F.inline(names))
    sizes = rows.groupBy("cut", "value").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, ["cut", "value"])
    # a large shard: a tree for each part; part x meets tree `own` as its guest, or has it as a guest
    trees = F.ceil(F.col("n") / limit).cast("int")
    spread = (rows.withColumn("own", F.pmod(F.xxhash64("fp"), trees).cast("int"))
              .withColumn("x", F.explode(F.sequence(F.lit(0), trees - 1)))
              .select("cut", "value", F.greatest("own", "x").alias("tree"), F.least("own", "x").alias("guest"), "fp",
                      (F.col("own") >= F.col("x")).alias("member")))
    keys = ["cut", "value", "tree", "guest"]
    parts = spread.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        def flush(table):
            key = np.column_stack([np.asarray(table.column(c)) for c in keys])
            change = np.concatenate([[False], (key[1:] != key[:-1]).any(axis=1)])
            fp = np.asarray(table.column("fp"))
            a, b = links_of(np.cumsum(change), fp.view(np.uint64),
                            table.column("member").to_numpy(zero_copy_only=False), radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

        held = None
        for batch in batches:
            whole = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            if not whole.num_rows:
                continue
            key = [whole.column(c).to_numpy() for c in keys]
            last = np.logical_and.reduce([k == k[-1] for k in key])
            cut = int(np.argmax(last))                     # the last shard may go on in the next batch
            if cut and cut >= 20_000 or (cut and whole.num_rows > 60_000):
                yield flush(whole.slice(0, cut).combine_chunks())
                whole = whole.slice(cut).combine_chunks()
            held = whole
        if held is not None:
            yield flush(held)

    return parts.select(*keys, "fp", "member").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, fp, component (its fingerprint with the smallest number) and component_id of every row, with the columns `carry`."""
    rows = written(fingerprints(docs.select(F.col(id_column).cast("long").alias("doc_id"), "text", *carry)), "simhash")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    found = components(shard_links(prints), "simhash-links")
    named = (found.join(prints, found.node == prints.fp).groupBy("component").agg(F.min("first_id").alias("component_id")))
    reached = found.join(named, "component").select(F.col("node").alias("fp"), "component", "component_id")
    ids = (prints.join(reached, "fp", "left")
           .select("fp", F.coalesce("component", "fp").alias("component"),
                   F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")))
    return rows.join(ids, "fp")


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Stage: of each component one row stays, that with the smallest doc_id (of repeated rows, any one)."""
    columns = docs.columns
    rows = written(docs.select(F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("row_id")), "simhash-docs")
    members = near_duplicates(rows.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "row_id"),
                              carry=("row_id",))
    stay = members.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("best")).select("best.row_id")
    return rows.join(stay, "row_id", "left_semi").select("row.*")
