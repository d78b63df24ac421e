"""Quality rules: cross-document line frequency.

Normalised lines are hashed, the distinct documents with each line counted per host, lines
above the limit removed, and documents rejected that have too little left. Before that, base rules
reject short texts and texts that repeat three-word sequences.

A task takes each document's measures and line hashes in one pass, written to the shared folder as
narrow rows. Counting is a sum of one per document and line, combined before its shuffle.

Copies: a host's documents whose lines are all the same are one document here ("distinct documents"
by content), so a text does not become boilerplate by being copied whole.

Defined cases: null text has no words and fails the base rules; so does an empty one. A null host is
a host of its own. Lines without a word have no hash and are never removed. Repeated rows are
judged alike. Extra columns are ignored by the query and kept by `strip_lines`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import extended, text_slices
from devsignals.session import written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCUMENTS = 20         # a line may stand in so many distinct documents of a host, whatever the host's size
MIN_LEFT = 0.3             # share of a document's characters that must be left
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
DIGITS = re.compile(rb"[0-9]+")


def line_key(line: bytes) -> int:
    """Hash of a line in lower case, spaces collapsed, numbers as one sign; as a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(DIGITS.sub(b"0", b" ".join(line.lower().split())))).astype(np.int64))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that stand in the text more than once."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = len(number)
    pairs = ids[:-1] * n + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    _, which, count = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    inside = np.zeros(len(words), dtype=bool)
    for k in range(3):
        inside[k:k + again.size] |= again
    return int(inside.sum())


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per document: base measures, and hash and length of each of its lines that has a word (as arrays)."""
    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                rows = []
                for raw in texts:
                    words, text = raw.split(), raw.decode("utf-8", "replace")
                    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
                    keys = [line_key(x) for x in lines]
                    rows.append((len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
                                 len(lines) - len(set(lines)), repeated_words(words), keys, list(map(len, lines)),
                                 xxhash.xxh64_intdigest(np.unique(np.array(keys, np.int64)).tobytes()) >> 1))
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "widths", "content"]
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()]
                out = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)] + out, names=["doc_id", "host"] + names)

    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), "text")
    return rows.mapInArrow(run, extended(
        rows.drop("text").schema, n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long",
        n_repeat_words="long", lines="array<bigint>", widths="array<int>", content="long"))


def frequent_lines(pages: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(host, line) of the lines in more distinct documents of the host than allowed. `pages`: host, content, lines."""
    firsts = pages.groupBy("host", "content").agg(F.first("lines").alias("lines"))
    return (firsts.select("host", F.explode(F.array_distinct("lines")).alias("line"))
            .groupBy("host", "line").agg(F.count("*").alias("n_documents"))
            .where(F.col("n_documents") > max_documents))


def judge(docs: DataFrame, host: str = "source", min_left: float = MIN_LEFT) -> DataFrame:
    """Per document its measures, `removed` (line hashes), `left_share`, `base_failed` and `kept`."""
    pages = written(measures(docs, host).withColumn("row_id", F.monotonically_increasing_id()), "line-rules")
    frequent = frequent_lines(pages)
    lines = pages.select("row_id", "host", F.explode(F.arrays_zip("lines", "widths")).alias("x"))
    removed = (lines.alias("l").join(frequent.alias("f"), (F.col("l.x.lines") == F.col("f.line"))
                                     & F.col("l.host").eqNullSafe(F.col("f.host")))
               .groupBy("l.row_id").agg(F.sum("l.x.widths").alias("removed_bytes"),
                                        F.collect_set("f.line").alias("removed")))
    whole = F.aggregate("widths", F.lit(0).cast("long"), lambda a, x: a + x)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (pages.join(removed, "row_id", "left")
            .withColumn("base_failed", failed)
            .withColumn("left_share", F.when(whole > 0, 1 - F.coalesce("removed_bytes", F.lit(0)) / whole).otherwise(1.0))
            .withColumn("kept", ~F.col("base_failed") & (F.col("left_share") >= min_left)))


def strip_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents with their texts less the lines above the limits."""
    columns = docs.columns
    frequent = frequent_lines(measures(docs, host))
    rows = docs.select(F.struct(*columns).alias("row"), F.col(host).cast("string").alias("host"), "text",
                       F.monotonically_increasing_id().alias("row_id"))

    def split(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                lines = [t.split(b"\n") for t in texts]
                pairs = [[line_key(x) if x and not x.isspace() else None for x in own] for own in lines]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns)] + [pa.array(pairs, pa.list_(pa.int64()))],
                    names=part.schema.names + ["keys"])

    keyed = rows.mapInArrow(split, extended(rows.schema, keys="array<bigint>"))
    keyed = written(keyed, "line-rules-texts")
    hits = (keyed.select("row_id", "host", F.explode(F.array_distinct("keys")).alias("line")).where("line is not null").alias("k")
            .join(frequent.alias("f"),
                  (F.col("k.line") == F.col("f.line")) & F.col("k.host").eqNullSafe(F.col("f.host")))
            .groupBy("k.row_id").agg(F.collect_set("k.line").alias("drop")))
    pairs = F.arrays_zip(F.split("text", "\n", -1).alias("line"), F.col("keys").alias("key"))
    left = F.transform(F.filter(pairs, lambda x: x["key"].isNull() | ~F.array_contains("drop", x["key"])), lambda x: x["line"])
    return keyed.join(hits, "row_id", "left").select(*[
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias(c) if c == "text"
        else F.col(f"row.{c}") for c in columns])


def query(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "source", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_share")
