"""Merkle fixity audit of WARC replicas.

Records of an archive file are leaves: hashes of offset, length and payload. Nodes above them cover
ordered ranges of offsets: level 1 the ranges of `RANGE` bytes, each further level `FANOUT` ranges of the
level below. A node hashes the hashes of its children in order. Replicas of a file are equal
when their roots are. Where roots differ, only the children of differing nodes are compared, level by level,
down to the records that differ.

Every level is one grouping of the level below: level 1 has the records that start in its range,
further levels at most FANOUT children. Levels are written to the shared folder, so that
descending reads files. The number of levels follows the largest offset.

Defined cases: a null payload is a record of its own, other than an empty one. A record on one side only is
`missing` (not in the replica) or `extra`; one on both sides with other bytes is `changed`. A file that
one side lacks differs at its root. Repeated pages are one record with the number of its copies.
A null page_id is a page like any other. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from devsignals.session import written

RANGE = 1 << 16
FANOUT = 16
PAGES_PER_FILE = 2000


def wears_out():
    return F.coalesce(F.col("page_id"), F.lit(-1)) % 101 == 7


def warc_records(pages: DataFrame, pages_per_file: int = PAGES_PER_FILE) -> DataFrame:
    """Pages as response records of archive files: file, offset, length, page_id, payload digest, copies, and `worn`, the
    digest of the same record with one other byte.

    Pages are dealt to files by a hash of page_id and digest; a page that is repeated is one record, so
    none fills a file. An offset is the sum of the lengths before it in its file.
    """
    body = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("html").isNull(), "metadata").otherwise("response"),
        F.lit("\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    record = F.concat("head", body, F.lit("\r\n\r\n"))
    # the first byte of the page, or of the head where the page is empty
    bytes_, at = F.col("record").cast("binary"), F.when(F.octet_length(body) > 0, F.octet_length("head") + 1).otherwise(1)
    worn = F.overlay(bytes_, F.when(F.substring(bytes_, at, F.lit(1)) == F.lit(b"#"), F.lit(b"%")).otherwise(F.lit(b"#")), at)
    rows = (pages.withColumn("head", head).withColumn("record", record)
            .select("page_id", F.sha2("record", 256).alias("digest"), F.octet_length("record").cast("long").alias("length"),
                    F.when(wears_out(), F.sha2(worn, 256)).alias("worn"))
            .groupBy("page_id", "digest", "length", "worn").agg(F.count("*").alias("copies")))
    rows = written(rows, "warc-pages")
    n_files = max(1, -(-rows.count() // pages_per_file))
    name = F.md5(F.concat_ws("/", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest"))
    before = Window.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    return (rows.withColumn("file", F.conv(F.substring(name, 1, 8), 16, 10).cast("long") % n_files)
            .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))))


def leaves(records: DataFrame) -> DataFrame:
    """Records with `hash`, the leaf's hash, and `node`, the range they start in."""
    text = F.concat_ws("|", "offset", "length", "digest", "copies")
    return records.withColumn("hash", F.sha2(text, 256)).withColumn("node", F.floor(F.col("offset") / RANGE).cast("long"))


def parents(children: DataFrame, order: list[str]) -> DataFrame:
    """side, file, node, hash of the nodes over children (side, file, node, hash and `order`)."""
    members = F.array_sort(F.collect_list(F.struct(*order, "hash")))
    joined = F.array_join(F.transform(members, lambda x: x["hash"]), "")
    return children.groupBy("side", "file", "node").agg(F.sha2(joined, 256).alias("hash"))


def trees(records: DataFrame) -> list[DataFrame]:
    """Levels of the trees of all files (column file) and replicas (column side): the leaves first, the roots last."""
    levels = [written(leaves(records), "merkle-leaves")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    levels.append(written(parents(levels[0], ["offset"]), "merkle"))
    while top:
        top //= FANOUT
        below = levels[-1].withColumn("child", F.col("node")).withColumn("node", F.floor(F.col("node") / FANOUT).cast("long"))
        levels.append(written(parents(below, ["child"]), "merkle"))
    return levels


def differing(nodes: DataFrame) -> DataFrame:
    """file, node of the nodes that the two sides do not have alike."""
    return (nodes.groupBy("file", "node").agg(F.count("*").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
            .where("n <> 2 or low <> high").select("file", "node"))


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """The records in which a replica differs: file, offset, page_id, and kind of damage.

    Both sides have file, offset, length, page_id, digest, copies.
    """
    columns = ["file", "offset", "length", "page_id", "digest", "copies"]
    both = (original.select(F.lit("original").alias("side"), *columns)
            .union(replica.select(F.lit("replica").alias("side"), *columns)))
    levels = trees(both)
    bad = differing(levels[-1])
    for level in reversed(levels[1:-1]):
        # only children of differing nodes are compared
        inside = level.withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long")).join(
            bad.withColumnRenamed("node", "parent"), ["file", "parent"], "left_semi")
        bad = written(differing(inside), "merkle-bad")
    suspects = levels[0].join(bad, ["file", "node"], "left_semi")
    side = lambda name: F.max(F.when(F.col("side") == name, F.col("hash")))
    return (suspects.groupBy("file", "offset", "page_id").agg(side("original").alias("ours"), side("replica").alias("theirs"))
            .where("not (ours <=> theirs)")
            .select("file", "offset", "page_id", F.when(F.col("theirs").isNull(), "missing")
                    .when(F.col("ours").isNull(), "extra").otherwise("changed").alias("damage")))


def damaged(records: DataFrame) -> DataFrame:
    """A replica with known damage: of every 101 pages one has another byte, and was hashed so, of every 211 one is gone, and of
    every 307 one stands there again behind the last byte that the pages can have."""
    page = F.coalesce(F.col("page_id"), F.lit(-1))
    rows = (records.where(page % 211 != 5)
            .withColumn("digest", F.coalesce("worn", "digest")))
    again = records.where(page % 307 == 11).withColumn("offset", F.col("offset") + F.lit(1 << 36))
    return rows.union(again)


def query(pages: DataFrame) -> DataFrame:
    records = warc_records(pages.select("page_id", "url", "html"))
    return audit(records, damaged(records)).select("file", "offset", "page_id", "damage")


SQL = f"""
WITH r AS (
    SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: ' || CASE WHEN html IS NULL THEN 'metadata' ELSE 'response' END
        || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
        || 'Content-Length: ' || CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)
        || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM pages),
u AS (SELECT DISTINCT page_id, sha256(record) AS digest, octet_length(encode(record)) AS length FROM r),
f AS (SELECT *, CAST(('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '') || '/' || digest), 1, 8)) AS BIGINT)
        % greatest(1, CAST(ceil((SELECT count(*) FROM u) / {PAGES_PER_FILE}.0) AS BIGINT)) AS file FROM u),
o AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, digest
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM f)
SELECT file, "offset", page_id, CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS damage
FROM o WHERE page_id % 211 = 5 OR page_id % 101 = 7
UNION ALL
SELECT file, "offset" + {1 << 36}, page_id, 'extra' FROM o WHERE page_id % 307 = 11
"""
