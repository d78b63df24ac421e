"""Merkle manifest of a dataset with a witness for every row, built by appending.

Rows of a source are leaves in the order of their doc_id; every three consecutive nodes become their parent until
one is left, the source's subroot. Subroots, ordered by source, give the root in the same way.

A tree grows by appends. `Frontier` holds its open subtrees, at most two complete nodes a level; a leaf joins
with an empty witness, and whenever a third sibling completes a parent, the witnesses of all leaves below are extended by
their new siblings. Appends are cut into aligned blocks of 3^`HEIGHT` leaves, each streamed through a frontier of its own by some
task. A block's root is a complete subtree of that height, so the blocks of a source are appended to the next frontier just
as leaves are, in blocks again, until a source has one root; then the sources' roots are appended to one more
tree. What a block gains there extends the witnesses of all that lie below it, by one join a round on (source, block).

No task holds more than a block: a source with a third of all rows is cut like the others. Positions come from a
range partitioning of narrow rows and the counts per partition and source. The number of rounds is the logarithm
of the largest source to the base 3^`HEIGHT`.

Defined cases: a null source is a source of its own, before all others; a null doc_id stands before all others of its
source and is never tampered with. Rows of one doc_id are leaves each, ordered by their hash. Null fields differ from
empty ones. No rows give no result. Extra columns take no part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from devsignals.llm.common import extended
from devsignals.session import written

FAN = 3
HEIGHT = 6
TREE = ["known", "name"]


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Frontier:
    """Open subtrees of one tree and the witnesses of the leaves appended so far.

    A leaf's witness lists, level by level, the siblings left and right of the node above it.
    """

    def __init__(self, fan: int = FAN):
        self.fan = fan
        self.open: list[list[tuple[str, int]]] = [[]]     # per level: complete nodes and their first leaves
        self.left: list[list[str]] = []
        self.right: list[list[str]] = []

    def append(self, leaf: str) -> None:
        self.open[0].append((leaf, len(self.left)))
        self.left.append([])
        self.right.append([])
        level = 0
        while len(self.open[level]) == self.fan:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        run = self.open[level]
        bounds = [first for _, first in run] + [len(self.left)]
        hashes = [h for h, _ in run]
        for k in range(len(run)):
            before, after = "".join(hashes[:k]), "".join(hashes[k + 1:])
            for leaf in range(bounds[k], bounds[k + 1]):
                self.left[leaf].append(before)
                self.right[leaf].append(after)
        self.open[level] = []
        if len(self.open) == level + 1:
            self.open.append([])
        self.open[level + 1].append((digest(hashes), bounds[0]))

    def close(self, height: int | None = None) -> str:
        """Completes what is open up to `height`, or up to the one node that is left, and returns that node."""
        level = 0
        while level != height and (height is not None or len(self.open) > level + 1 or len(self.open[level]) > 1):
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def encoded(*columns: str) -> Column:
    """The columns as one text: `-` for null, else the number of bytes, a colon and the value."""
    text = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text])


def positions(rows: DataFrame, order: list[str], label: str = "manifest-order") -> DataFrame:
    """Adds `pos`, a row's place from 0 among those of its tree (columns known, name) in the given order, and `n`, their number.

    Equal rows are told apart by a number, so that any many of them can be cut between tasks.
    """
    numbered = rows.withColumn("row_id", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (*TREE, *order, "row_id")]
    ranged = written(
        numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), label)
    # one row for each tree in each partition
    runs = ranged.groupBy("part", *TREE).agg(F.count("*").alias("held"), F.min("at").alias("first_at"))
    tree = Window.partitionBy(*TREE)
    runs = runs.withColumn("n", F.sum("held").over(tree)).withColumn(
        "before", F.coalesce(F.sum("held").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (ranged.join(runs, ["part", *TREE]).withColumn("pos", F.col("before") + F.col("at") - F.col("first_at"))
            .select(*rows.columns, "pos", "n"))


def blocks(nodes: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """Streams every block of nodes (known, name, pos, n, hash and what they carry) through a frontier. Adds `block`, the
    witnesses `left` and `right`, and, in the first row of each block, `block_root`."""
    size = fan ** height

    def witness(table: pa.Table) -> pa.RecordBatch:
        hashes, n = table.column("hash").to_pylist(), table.column("n").to_pylist()
        keys = list(zip(*[table.column(c).to_pylist() for c in (*TREE, "block")]))
        left, right, roots, start = [], [], [None] * len(hashes), 0
        while start < len(hashes):
            frontier, stop = Frontier(fan), start
            while stop < len(hashes) and keys[stop] == keys[start]:
                frontier.append(hashes[stop])
                stop += 1
            roots[start] = frontier.close(None if n[start] <= size else height)
            left += frontier.left
            right += frontier.right
            start = stop
        added = [pa.array(left, pa.list_(pa.string())), pa.array(right, pa.list_(pa.string())), pa.array(roots, pa.string())]
        return pa.RecordBatch.from_arrays([table.column(c).combine_chunks() for c in table.schema.names] + added,
                                          names=table.schema.names + ["left", "right", "block_root"])

    def run(batches):
        held = None
        for batch in batches:
            whole = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            if not whole.num_rows:
                continue
            # rows are sorted; the last block may go on in the next batch
            keys = list(zip(*[whole.slice(max(0, whole.num_rows - size)).column(c).to_pylist() for c in (*TREE, "block")]))
            cut = whole.num_rows - sum(1 for k in keys if k == keys[-1])
            if cut:
                yield witness(whole.slice(0, cut).combine_chunks())
            held = whole.slice(cut)
        if held is not None and held.num_rows:
            yield witness(held.combine_chunks())

    cut = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long"))
    dealt = cut.repartition(*TREE, "block").sortWithinPartitions(*TREE, "pos")
    return dealt.mapInArrow(run, extended(dealt.schema, left="array<string>", right="array<string>", block_root="string"))


def grown(nodes: DataFrame, height: int = HEIGHT, label: str = "manifest") -> tuple[list[DataFrame], DataFrame]:
    """Appends the nodes of all trees, then their blocks' roots, and so on. The rounds, with the witness that
    each gave, and the trees' roots (known, name, hash)."""
    rounds, tops, current = [], [], nodes
    while True:
        rounds.append(written(blocks(current, FAN, height), f"{label}-witness"))
        roots = rounds[-1].where("block_root is not null").select(
            *TREE, F.col("block").alias("pos"), F.ceil(F.col("n") / FAN ** height).cast("long").alias("n"),
            F.col("block_root").alias("hash"))
        tops.append(roots.where("n = 1").select(*TREE, "hash"))
        current = roots.where("n > 1")
        if current.isEmpty():
            break
    found = tops[0]
    for more in tops[1:]:
        found = found.union(more)
    return rounds, found


def extended_down(rounds: list[DataFrame], gained: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The first round's rows with whole witnesses. `gained`: what each tree's root has gained (known, name, left, right, and
    columns to hand down). Each round extends the witnesses of what lies below its nodes."""
    handed = [c for c in gained.columns if c not in (*TREE, "left", "right")]
    above = None
    for rows in reversed(rounds):
        ends = rows.where((F.col("block_root").isNotNull()) & (F.col("n") <= FAN ** height)).select(*TREE)
        # the root of a tree that ends in this round went straight to the tree of all sources
        gain = gained.join(ends, TREE).select(*TREE, F.lit(0).cast("long").alias("block"), F.col("left").alias("up_left"),
                                              F.col("right").alias("up_right"), *handed)
        if above is not None:
            gain = gain.union(above.select(*TREE, F.col("pos").alias("block"), "left", "right", *handed))
        above = (rows.join(gain, [*TREE, "block"])
                 .withColumn("left", F.concat("left", "up_left")).withColumn("right", F.concat("right", "up_right"))
                 .drop("block", "block_root", "up_left", "up_right"))
    return above


def folded(leaf: Column) -> Column:
    """The root that a leaf gives with its witness (columns left, right)."""
    return F.aggregate(F.arrays_zip("left", "right"), leaf,
                       lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def witnessed(leaves: DataFrame, order: list[str], height: int = HEIGHT) -> DataFrame:
    """Rows (known, name, hash and what they carry) with subroot, root and the witness: `left` and `right`, the siblings
    at each level from the leaf to the root."""
    rounds, subroots = grown(positions(leaves, order), height)
    all_trees = subroots.select(*TREE, F.col("hash").alias("subroot"))
    top = positions(all_trees.select(F.lit(True).alias("known"), F.lit("").alias("name"), F.struct(*TREE).alias("tree"),
                                     "subroot", F.col("subroot").alias("hash")), ["tree"], "manifest-subroots")
    top_rounds, root = grown(top, height, "manifest-top")
    # one row: the root of all
    whole = root.select(*TREE, F.array().cast("array<string>").alias("left"), F.array().cast("array<string>").alias("right"),
                        F.col("hash").alias("root"))
    gained = written(extended_down(top_rounds, whole, height).select("tree.known", "tree.name", "left", "right", "subroot", "root"),
                     "manifest-top")
    return extended_down(rounds, gained, height)


def leaves_of(docs: DataFrame) -> DataFrame:
    """known, name (of the source), doc_id, hash (the leaf) and tampered (the leaf without the text's line ends, for half of the ids)."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    half = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    leaf, other = F.sha2(encoded(*fields, "text"), 256), F.sha2(encoded(*fields, "bare"), 256)
    rows = docs.select(*fields, "text", F.replace(F.col("text"), F.lit("\n"), F.lit("")).alias("bare"))
    return rows.select(F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("name"), "doc_id",
                       leaf.alias("hash"), F.when(half, other).otherwise(leaf).alias("tampered"))


def query(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    leaves = written(leaves_of(docs.select("doc_id", "source", "lang", "n_chars", "text")), "manifest-leaves")
    rows = witnessed(leaves, ["doc_id", "hash"], height)
    proof = F.array_join(F.zip_with("left", "right", lambda a, b: F.concat(a, b)), "")
    return rows.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                       folded(F.col("tampered")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 by its bitwise rule: eight steps a byte
SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, source,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
        || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
        || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
        || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS fields,
        text, replace(text, chr(10), '') AS bare,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))),
            4294967295::BIGINT) % 2 = 0 AS half
    FROM documents),
l AS (
    SELECT doc_id, source, sha256(fields || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
        sha256(fields || CASE WHEN text IS NULL THEN '-' WHEN half THEN strlen(bare) || ':' || bare ELSE strlen(text) || ':' || text END) AS tampered
    FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
up AS (
    SELECT source, 0 AS level, list(leaf ORDER BY pos) AS hs FROM p GROUP BY source
    UNION ALL
    SELECT source, level + 1, list_transform(range(0, (len(hs) + 2) // 3), lambda i: sha256(array_to_string(hs[3 * i + 1 : 3 * i + 3], '')))
    FROM up WHERE len(hs) > 1),
s AS (SELECT source, hs[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM up WHERE len(hs) = 1),
top AS (
    SELECT 1000 AS level, list(subroot ORDER BY place) AS hs FROM s
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(hs) + 2) // 3), lambda i: sha256(array_to_string(hs[3 * i + 1 : 3 * i + 3], '')))
    FROM top WHERE len(hs) > 1),
steps AS (
    SELECT p.source, pos, level, hs, pos // CAST(3 ** level AS BIGINT) AS k
    FROM p JOIN up ON p.source IS NOT DISTINCT FROM up.source WHERE len(hs) > 1
    UNION ALL
    SELECT p.source, pos, level, hs, place // CAST(3 ** (level - 1000) AS BIGINT)
    FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source, top WHERE len(hs) > 1),
w AS (
    SELECT source, pos, list({'a': array_to_string(hs[3 * (k // 3) + 1 : k], ''), 'h': '', 'b': array_to_string(hs[k + 2 : 3 * (k // 3) + 3], '')}
        ORDER BY level) AS path FROM steps GROUP BY source, pos)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x.a || x.b), '')) AS proof_sha256,
    list_reduce(list_prepend({'a': '', 'h': tampered, 'b': ''}, coalesce(path, [])),
        lambda x, y: {'a': '', 'h': sha256(y.a || x.h || y.b), 'b': ''}).h AS folded_root,
    folded_root = root AS verified
FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source
    LEFT JOIN w ON p.source IS NOT DISTINCT FROM w.source AND p.pos = w.pos
    CROSS JOIN (SELECT hs[1] AS root FROM top WHERE len(hs) = 1)
"""
