"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names (capitalised words) and units turn into typed placeholders, the
rest into lower case without punctuation around it. Windows of five template tokens of benchmark
items are hash-joined with those of the documents. An item is found in a document when at least
`THRESHOLD` of its windows are there and the slots agree: each value in the item's placeholders
stands for one value in the document and the other way round. So a question with other numbers or
names is caught, and a text that only shares its form is not.

Every window is also compared by its bare words with case folded, because a passage in other case (all capitals, a
title) has other placeholders than its item; such a window gives its item's values as they are to the slot check.
A window with fewer than two words besides placeholders is compared in this way only, so
no window of bare placeholders meets all others. Tasks turn documents into windows and pass on
those whose hash is in a bit table of the benchmark's hashes (fixed size, `BITS`, broadcast);
the exact join, the alignment and the slot check are Spark's, the benchmark's table being
joined without a hint. Windows that many items share would pair every document that has one with all of these items. So documents
are joined with an item's rarest windows first: an item of n windows, `need` of which must be there, shows itself in one of
any n - need + 1. Only the pairs so found are joined with all windows of the item.

Defined cases: null and empty texts contain nothing. Items of fewer than `MIN_ITEM_WORDS` words prove nothing
and are skipped; items of fewer than five words are one window of their length. Equal items are each
reported. Repeated rows with the same id and text are one document in the report; the stage removes
them all. A null doc_id is reported as null. Extra columns are ignored by the report and
kept by the stage. Among several places of an item the one with most windows counts, then the first.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from devsignals.llm.common import extended, offsets_of, row_key, text_slices
from devsignals.session import written

WINDOW = 5
THRESHOLD = 0.8
MIN_ITEM_WORDS = 3
BITS = 1 << 24
SECOND = 16                  # where a hash's second place in the table begins
MAX_WORDS_KEPT = 1 << 18
# Units of measure.
UNITS = frozenset((
    "mm", "cm", "km", "kg", "mg", "lb", "lbs", "oz", "ft", "yd", "mi", "mph", "kmh", "hz", "khz", "mhz", "ghz", "kb", "mb",
    "gb", "tb", "ml", "litre", "litres", "liter", "liters", "metre", "metres", "meter", "meters", "kilometre", "kilometres",
    "kilometer", "kilometers", "mile", "miles", "inch", "inches", "foot", "feet", "yard", "yards", "gram", "grams",
    "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces", "second", "seconds", "minute", "minutes", "hour",
    "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "degree", "degrees", "dollar",
    "dollars", "euro", "euros", "cent", "cents", "watt", "watts", "volt", "volts", "joule", "joules", "newton", "newtons"))
NUMBER = re.compile(r"[+\-]?[$€£]?\d[\d.,:/]*%?")
GLUED = re.compile(r"[+\-]?\d[\d.,]*([a-zµ°]+)")
EDGE = re.compile(r"^[^\w+\-$€£]+|[^\w%]+$")


def token_of(word: str) -> tuple[str, str]:
    """Template token and bare form of a word."""
    bare = EDGE.sub("", word)
    low = bare.lower()
    if NUMBER.fullmatch(bare):
        return "<number>", low
    if GLUED.fullmatch(low):
        return "<number><unit>", low
    if low in UNITS:
        return "<unit>", low
    if bare[:1].isupper():
        return "<name>", low
    return low, low


class Tokens:
    """Numbers of words, with the hashes of their template token and bare form."""

    def __init__(self):
        self.forget()

    def forget(self):
        self.number: dict[bytes, int] = {}
        self.hashes = np.zeros((0, 2), dtype=np.uint64)
        self.slot = np.zeros(0, dtype=bool)
        self.bare: list[str] = []

    def of(self, words: list[bytes]) -> np.ndarray:
        new = list(set(words).difference(self.number))
        if new:
            found = [token_of(w.decode("utf-8", "replace")) for w in new]
            self.number.update(zip(new, range(len(self.bare), len(self.bare) + len(new))))
            digest = xxhash.xxh64_intdigest
            self.hashes = np.concatenate([self.hashes, np.array(
                [(digest(t, 1), digest(b.casefold(), 2)) for t, b in found], dtype=np.uint64).reshape(-1, 2)])
            self.slot = np.concatenate([self.slot, np.array([t[:1] == "<" and t != b for t, b in found])])
            self.bare += [b for _, b in found]
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def windows_of(tokens: Tokens, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template and bare hashes of all windows of `width` words, and which have words enough for the template."""
    m = ids.size - width + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    out = []
    for form in range(2):
        codes, h = tokens.hashes[:, form][ids], np.full(m, 7 + width, dtype=np.uint64)
        for k in range(width):
            h = (h ^ codes[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append(h)
    literal = offsets_of(~tokens.slot[ids])
    return out[0], out[1] ^ np.uint64(0x5851F42D4C957F2D), literal[width:] - literal[:m] >= 2


SLOTS = "array<struct<slot:int,value:string>>"
SLOT_TYPE = pa.list_(pa.struct([("slot", pa.int32()), ("value", pa.string())]))


def slots_in(tokens: Tokens, ids: np.ndarray, at: int, width: int) -> list[dict]:
    return [{"slot": k, "value": tokens.bare[ids[at + k]]} for k in range(width) if tokens.slot[ids[at + k]]]


def item_windows(items: DataFrame) -> DataFrame:
    """item (a number for the row's id and text), item_id, width, n_windows, i_pos, hash, i_slots of every item's windows; one
    row or two (template and bare) each."""
    def run(batches):
        tokens = Tokens()
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                rows = []
                for item, raw in zip(part.column(0).to_pylist(), texts):
                    ids = tokens.of(raw.split())
                    width = min(WINDOW, ids.size)
                    if ids.size >= MIN_ITEM_WORDS:
                        template, bare, enough = windows_of(tokens, ids, width)
                        every = [(p, bare) for p in range(bare.size)] + [(p, template) for p in np.flatnonzero(enough).tolist()]
                        number = xxhash.xxh64_intdigest(raw, xxhash.xxh32_intdigest(repr(item))) - (1 << 63)
                        rows += [(number, item, width, bare.size, p, int(h[p].view(np.int64)), slots_in(tokens, ids, p, width))
                                 for p, h in every]
                kinds = [pa.int64(), part.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), SLOT_TYPE]
                columns = list(zip(*rows)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                                 names=["item", "item_id", "width", "n_windows", "i_pos", "hash", "i_slots"])

    rows = items.select("item_id", "text")
    schema = T.StructType([T.StructField("item", T.LongType()), *rows.drop("text").schema.fields])
    return rows.mapInArrow(run, extended(schema, width="integer", n_windows="integer", i_pos="integer",
                                         hash="long", i_slots=SLOTS))


def candidate_windows(docs: DataFrame, bits: np.ndarray, widths: list[int]) -> DataFrame:
    """k1, k2, doc_id, width, d_pos, hash, d_slots (null: bare words) of the windows that may be in the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        tokens, table = Tokens(), shared.value
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                if len(tokens.bare) > MAX_WORDS_KEPT:
                    tokens.forget()
                words = [t.split() for t in texts]
                starts = offsets_of([len(w) for w in words])
                ids = tokens.of([w for own in words for w in own])
                found = []
                for width in widths:
                    template, bare, enough = windows_of(tokens, ids, width)
                    for h, is_template in ((template, True), (bare, False)):
                        bit = (h >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
                        at = np.flatnonzero(table[bit >> 3] & (np.uint8(1) << (bit & 7).astype(np.uint8)))
                        bit = (h[at] >> np.uint64(SECOND) & np.uint64(BITS - 1)).astype(np.int64)
                        at = at[(table[bit >> 3] & (np.uint8(1) << (bit & 7).astype(np.uint8))) > 0]
                        at = at[enough[at]] if is_template else at
                        row = np.searchsorted(starts, at, side="right") - 1
                        at, row = at[at + width <= starts[row + 1]], row[at + width <= starts[row + 1]]
                        found += [(r, width, p - starts[r], x, slots_in(tokens, ids, p, width) if is_template else None)
                                  for r, p, x in zip(row, at, h[at].view(np.int64).tolist())]
                row = pa.array([f[0] for f in found], pa.int64())
                kinds = [pa.int32(), pa.int32(), pa.int64(), SLOT_TYPE]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).take(row) for i in range(3)] +
                    [pa.array([f[k + 1] for f in found], kind) for k, kind in enumerate(kinds)],
                    names=["k1", "k2", "doc_id", "width", "d_pos", "hash", "d_slots"])

    rows = docs.select("k1", "k2", "doc_id", "text")
    return rows.mapInArrow(run, extended(rows.drop("text").schema, width="integer", d_pos="integer", hash="long", d_slots=SLOTS))


def bit_table(windows: DataFrame) -> np.ndarray:
    """Two bits per hash; what the driver reads is bounded by the size of the table."""
    both = F.array(F.shiftrightunsigned("hash", 64 - BITS.bit_length() + 1), F.shiftrightunsigned("hash", SECOND).bitwiseAND(BITS - 1))
    places = (windows.select(F.explode(both).alias("bit")).select(F.col("bit").cast("int"))
              .distinct().toArrow().column("bit").to_numpy())
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    np.bitwise_or.at(bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    return bits


def agreeing(pairs):
    """Each item value stands for one document value and the other way round."""
    own = F.array_distinct(F.transform(pairs, lambda p: p["i"]))
    other = F.array_distinct(F.transform(pairs, lambda p: p["d"]))
    return (F.size(own) == F.size(pairs)) & (F.size(other) == F.size(pairs))


def likely_pairs(candidates: DataFrame, windows: DataFrame, threshold: float) -> DataFrame:
    """k1, k2, item: documents with one of the item's rarest windows. How rare a window is says the documents' windows."""
    held = candidates.groupBy("hash", "width").agg(F.count("*").alias("held"))
    places = (windows.join(held, ["hash", "width"], "left").groupBy("item", "n_windows", "i_pos")
              .agg(F.sum(F.coalesce("held", F.lit(0))).alias("held")))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("held", "i_pos"))
    need = F.ceil(F.col("n_windows") * threshold - 1e-9)
    rarest = places.withColumn("rank", rank).where(F.col("rank") <= F.col("n_windows") - need + 1).select("item", "i_pos")
    short = windows.join(rarest, ["item", "i_pos"]).select("item", "hash", "width").distinct()
    return candidates.select("k1", "k2", "hash", "width").join(short, ["hash", "width"]).select("k1", "k2", "item").distinct()


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """k1, k2, doc_id, item_id, first_word, similarity, reparameterised of every item found in a document."""
    windows = written(item_windows(items), "benchmark-windows")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())      # 3 to 5
    keyed = docs.select("doc_id", "text", *row_key("doc_id", "text"))
    candidates = written(candidate_windows(keyed, bit_table(windows), widths), "benchmark-candidates")
    pairs = likely_pairs(candidates, windows, threshold)
    values = F.when(F.col("d_slots").isNull(), F.transform("i_slots", lambda i: F.struct(i["value"].alias("i"), i["value"].alias("d")))) \
        .otherwise(F.zip_with("i_slots", "d_slots", lambda i, d: F.struct(i["value"].alias("i"), d["value"].alias("d"))))
    aligned = (candidates.join(pairs, ["k1", "k2"]).join(windows, ["item", "hash", "width"])
               .where(F.col("d_slots").isNull() |
                      (F.transform("i_slots", lambda x: x["slot"]) == F.transform("d_slots", lambda x: x["slot"])))
               .groupBy("k1", "k2", "doc_id", "item", "item_id", "n_windows", (F.col("d_pos") - F.col("i_pos")).alias("shift"))
               .agg(F.collect_set("i_pos").alias("found"), F.array_distinct(F.flatten(F.collect_set(values))).alias("pairs"),
                    F.min("d_pos").alias("first_word")))
    places = aligned.groupBy("k1", "k2", "doc_id", "item", "item_id", "n_windows").agg(
        F.max(F.when(agreeing(F.col("pairs")), F.struct(
            F.size("found").alias("n"), (-F.col("first_word")).alias("place"),
            F.exists("pairs", lambda p: p["i"] != p["d"]).alias("other")))).alias("best"),
        # the whole document, for passages with words put in or left out
        F.size(F.array_distinct(F.flatten(F.collect_set("found")))).alias("n_all"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"), F.min("first_word").alias("first"))
    straight = F.coalesce(F.col("best.n"), F.lit(0))
    whole = F.when(agreeing(F.col("pairs")), F.col("n_all")).otherwise(0)
    return (places.withColumn("similarity", F.greatest(straight, whole) / F.col("n_windows"))
            .where(F.col("similarity") >= threshold)
            .select("k1", "k2", "doc_id", "item_id", "similarity",
                    F.when(straight >= whole, -F.col("best.place")).otherwise(F.col("first")).cast("long").alias("first_word"),
                    F.when(straight >= whole, F.col("best.other"))
                    .otherwise(F.exists("pairs", lambda p: p["i"] != p["d"])).alias("reparameterised")))


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(docs.select("doc_id", "text"), items).select(
        "doc_id", "item_id", "similarity", "first_word", "reparameterised")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Stage: the documents in which no item is found."""
    columns = docs.columns
    found = leaks(docs, items).select("k1", "k2").distinct()
    rows = docs.select(F.struct(*columns).alias("row"), *row_key("doc_id", "text"))
    return rows.join(found, ["k1", "k2"], "left_anti").select("row.*")
