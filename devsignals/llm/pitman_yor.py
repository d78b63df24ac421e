"""Language-model scoring by a hierarchical Pitman-Yor model.

Chinese restaurants over words: every training word, as the word before, has a restaurant whose customers are the training
tokens that follow it; all of them share one parent, whose customers are their tables. A word that training has not seen is one symbol,
a new table in the parent; so known words and this symbol add up to one in every context, as they do in the base score.

Gibbs sampling: a sweep seats every dish's customers anew in all restaurants, given the tables of the
last sweep; the parent's customers follow. After the burn-in, each sweep gives one predictive
probability per word and context; their mean is the model's probability of a token.

Documents are cut into chunks, stored in buckets by chunk so that later joins move the small side only. Words and pairs of
neighbouring words meet in hash buckets: a chunk sends each bucket one packed row of its words' hashes and counts and gets
their totals back in the same order. Of the chunks that hold a pair one owns it. A sweep is done chunk by chunk: a chunk seats the
pairs it holds, alike wherever they are held, and sends the tables of those it owns, added up per word and per context; the totals
come back the same way. So no task holds more than a chunk or a bucket, and the driver sees a few totals a sweep.

Words are told apart by 64 bits of a hash, pairs by so many bits that one in a million is mistaken for another.

Defined cases: null counts as the empty text, which is its end token alone; the end token also stands
before the first word. Without training documents every word is the unknown symbol, of probability
one, as in the base score. Repeated rows are scored (and learned from) as often as they
occur. A null doc_id belongs to the fold of the empty text. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import fold, offsets_of, segment_sums, text_slices
from devsignals.session import fresh_path, written

CHUNK_TOKENS = 1 << 20
END = b"\n"                  # the end token; no word holds it
SWEEPS, BURN_IN = 3, 1
STRENGTH = 1.0
ONE_BY_ONE = 64              # so many customers are seated singly,
BLOCK = 0.02                 # later ones in blocks of this share of those seated
U = np.uint64


# --- numbers ----------------------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on as compressed planes of bytes."""
    v = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if v.size else 1
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return v.size.to_bytes(8, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if v.size else b"")


def unpacked(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        raw = pa.decompress(blob[9:], decompressed_size=n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def rising(values: np.ndarray) -> bytes:
    """Rising numbers, packed by their steps."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    return packed(np.diff(v, prepend=U(0)))


def risen(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def normal(uniform: np.ndarray) -> np.ndarray:
    """Standard normal values, by the logistic approximation of the normal curve."""
    u = np.clip(uniform, 1e-12, 1 - 1e-12)
    return np.log(u / (1 - u)) / 1.702


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, random: np.ndarray) -> np.ndarray:
    """Tables of each dish after its customers came in one by one.

    A customer opens a table with probability weight / (seated - discount * tables + weight), where weight is
    the restaurant's mass for new tables times the dish's probability in the parent. `random`: a seed per
    dish, so that a dish is seated alike wherever it is computed.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    order = np.argsort(-customers, kind="stable")
    n, w, state, t = customers[order], weight[order], random[order].astype(np.uint64), tables[order]
    fewer = -n
    seated, left = 1, int(np.searchsorted(fewer, -1, side="left"))         # dishes with more customers come first
    while left:
        step = 1 if seated < ONE_BY_ONE else max(1, int(seated * BLOCK))
        state[:left] = mixed(state[:left])
        draw = (state[:left] >> U(11)).astype(np.float64) / float(1 << 53)
        if step == 1:
            t[:left] += draw * (seated - discount * t[:left] + w[:left]) < w[:left]
        else:                # the binomial draw of a block, by the normal curve rounded
            now = np.minimum(step, n[:left] - seated)
            chance = w[:left] / (seated + (now - 1) / 2 - discount * t[:left] + w[:left])
            mean = now * chance
            t[:left] += np.clip(np.rint(mean + normal(draw) * np.sqrt(mean * (1 - chance))), 0, now)
        seated += step
        left = int(np.searchsorted(fewer[:left], -seated, side="left"))
    tables[order] = t
    return tables


def discount_of(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones else 0.5


# --- chunks -----------------------------------------------------------------------

def numbering() -> defaultdict[bytes, int]:
    """Numbers words as they are asked for."""
    return defaultdict(count().__next__)


def make_chunks(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per chunk: doc_id, held (in the held-out fold) and counts (tokens) of its documents; the hashes of its words,
    rising, and its tokens as places among them."""
    def run(batches):
        made = 0
        ids, held, counts, tokens, number = [], [], [], [], numbering()

        def row():
            nonlocal made
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
            keys, place = np.unique(hashes, return_inverse=True)
            chunk = TaskContext.get().partitionId() * (1 << 24) + made
            made += 1
            columns = [[chunk], [ids], [held], [counts], [rising(keys)], [packed(place[np.concatenate(tokens)])]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["chunk", "ids", "held", "counts", "keys", "tokens"])

        size = 0
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                for doc, out, raw in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts):
                    own = raw.lower().split()
                    own.append(END)
                    tokens.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
                    ids.append(doc)
                    held.append(out)
                    counts.append(len(own))
                    size += len(own)
                    if size >= chunk_tokens:
                        yield row()
                        ids, held, counts, tokens, number, size = [], [], [], [], numbering(), 0
        if ids:
            yield row()

    return docs.select("doc_id", "text", "held_out").mapInArrow(
        run, "chunk long, ids array<bigint>, held array<boolean>, counts array<int>, keys binary, tokens binary")


def by_chunk(df: DataFrame, label: str, names: list[str]) -> DataFrame:
    """The rows stored in buckets by chunk: what is joined with them later by chunk is moved to them. The table's name
    is added to `names`."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").option("path", path).saveAsTable(name)
    names.append(name)
    return spark.table(name)


class Chunk:
    """A chunk's documents and tokens."""

    def __init__(self, table: pa.Table):
        row = {name: table.column(name)[0] for name in table.schema.names}
        self.number = row["chunk"].as_py()
        self.ids, self.held = row["ids"].values, row["held"].values
        self.starts = offsets_of(np.asarray(row["counts"].values))
        self.keys = risen(row["keys"].as_py())
        self.tokens = unpacked(row["tokens"].as_py()).astype(np.int32)

    def training(self) -> np.ndarray:
        """Per token, whether it stands in a training document."""
        return np.repeat(~np.asarray(self.held.to_numpy(zero_copy_only=False), dtype=bool), np.diff(self.starts))

    def pairs(self) -> np.ndarray:
        """Per token, the word before and the word as one number."""
        pair = np.empty(self.tokens.size, np.int64)
        pair[1:] = self.tokens[:-1]
        pair[self.starts[:-1]] = np.searchsorted(self.keys, U(xxhash.xxh64_intdigest(END)))
        pair *= self.keys.size
        pair += self.tokens
        return pair


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, rising, and which of them each value is: one sort, as there are as many values as tokens."""
    order = np.argsort(values)
    found = values[order]
    new = np.concatenate([[True], found[1:] != found[:-1]]) if found.size else np.zeros(0, bool)
    rank = np.empty(values.size, np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - 1
    return found[new], rank


def bucketed(keys: np.ndarray, bits: int, buckets: int):
    """Bucket, first and last place of each run of rising keys of so many bits."""
    of = (((keys << U(64 - bits)) >> U(32)) * U(buckets)) >> U(32)
    there, first = np.unique(of, return_index=True)
    return zip(there.tolist(), first.tolist(), [*first[1:].tolist(), keys.size])


def rows_of(table: pa.Table, *names: str):
    return zip(*[table.column(n).to_pylist() for n in names])


def put_together(table: pa.Table, *names: str) -> list[np.ndarray]:
    """The columns' numbers in the order of the buckets."""
    table = table.sort_by("bucket")
    return [np.concatenate([unpacked(x) for x in table.column(n).to_pylist()]) for n in names]


# --- words: totals over all training documents --------------------------------------

def word_rows(chunks: DataFrame, buckets: int) -> DataFrame:
    """bucket, chunk, keys, n (tokens in training documents) of every chunk's words."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                own = Chunk(pa.Table.from_batches([batch.slice(k, 1)]))
                n = np.bincount(own.tokens[own.training()], minlength=own.keys.size)
                rows = [(b, own.number, rising(own.keys[i:j]), packed(n[i:j])) for b, i, j in bucketed(own.keys, 64, buckets)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "keys", "n"])

    return chunks.select("chunk", "ids", "held", "counts", "keys", "tokens").mapInArrow(
        run, "bucket long, chunk long, keys binary, n binary")


def word_totals(rows: DataFrame) -> DataFrame:
    """chunk, bucket, slots (the words' numbers in the bucket, rising), c (their tokens in all training documents); in one row of
    a bucket, known (its training words) and tokens (of theirs)."""
    def total(table: pa.Table) -> pa.Table:
        found = list(rows_of(table, "bucket", "chunk", "keys", "n"))
        lists = [risen(keys) for _, _, keys, _ in found]
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        c = np.bincount(place, weights=np.concatenate([unpacked(n) for *_, n in found])).astype(np.int64)
        ends, first = offsets_of([x.size for x in lists]), [1] + [0] * (len(found) - 1)
        slots = [place[i:j] for i, j in zip(ends[:-1], ends[1:])]
        return pa.table({
            "chunk": [x[1] for x in found], "bucket": [x[0] for x in found],
            "slots": pa.array([rising(s) for s in slots], pa.binary()), "c": pa.array([packed(c[s]) for s in slots], pa.binary()),
            "known": [int((c > 0).sum()) * f for f in first], "tokens": [int(c.sum()) * f for f in first]})

    return rows.groupBy("bucket").applyInArrow(total, "chunk long, bucket long, slots binary, c binary, known long, tokens long")


# --- pairs ------------------------------------------------------------------------

def held_pairs(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """chunk, its words' global numbers (bucket and slot) and c, its distinct pairs, rising, and n, how often each stands in its
    training documents."""
    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        own = Chunk(left)
        right = right.sort_by("bucket")
        words_ = np.concatenate([(U(b) << U(32)) | risen(s) for b, s in rows_of(right, "bucket", "slots")])
        c = np.concatenate([unpacked(x) for x in right.column("c").to_pylist()])
        codes, which = ranked(own.pairs())
        n = np.bincount(which[own.training()], minlength=codes.size)
        return pa.table({"chunk": [own.number], "words": pa.array([rising(words_)], pa.binary()), "c": pa.array([packed(c)], pa.binary()),
                         "codes": pa.array([rising(codes)], pa.binary()), "n_here": pa.array([packed(n)], pa.binary())})

    return chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(
        join, "chunk long, words binary, c binary, codes binary, n_here binary")


def pair_keys(words: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64 bits for each pair, alike in all chunks."""
    size = U(words.size)
    return mixed(mixed(words[codes // size]) ^ words[codes % size])


def pair_order(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys' first bits, rising, and where each stands among the pairs."""
    order = np.argsort(keys)
    return keys[order] >> U(64 - bits), order


def pair_rows(held: DataFrame, bits: int, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, words, codes, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                keys, order = pair_order(pair_keys(risen(words), risen(codes)), bits)
                n = unpacked(n)[order]
                rows = [(b, chunk, rising(keys[i:j]), packed(n[i:j])) for b, i, j in bucketed(keys, bits, buckets)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "keys", "n"])

    return held.select("chunk", "words", "codes", "n_here").mapInArrow(run, "bucket long, chunk long, keys binary, n binary")


def pair_totals(rows: DataFrame) -> DataFrame:
    """chunk, bucket, n (of each pair in all training documents), own (whether this chunk owns it)."""
    def total(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        found = list(rows_of(table, "bucket", "chunk", "keys", "n"))
        lists = [risen(keys) for _, _, keys, _ in found]
        here = np.concatenate([unpacked(n) for *_, n in found]).astype(np.int64)
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        n = np.bincount(place, weights=here).astype(np.int64)
        own, there = np.zeros(place.size, np.int64), np.flatnonzero(here)[::-1]
        first = np.full(n.size, -1)
        first[place[there]] = there                   # the first chunk that has it in a training document writes last
        own[first[first >= 0]] = 1
        ends = offsets_of([x.size for x in lists])
        parts = list(zip(ends[:-1], ends[1:]))
        return pa.table({"chunk": [x[1] for x in found], "bucket": [x[0] for x in found],
                         "n": pa.array([packed(n[place[i:j]]) for i, j in parts], pa.binary()),
                         "own": pa.array([packed(own[i:j]) for i, j in parts], pa.binary())})

    return rows.groupBy("bucket").applyInArrow(total, "chunk long, bucket long, n binary, own binary")


def counted_pairs(held: DataFrame, totals: DataFrame, bits: int) -> DataFrame:
    """chunk, n, own of its pairs, and ones, twos, the pairs it owns that stand once or twice in training documents."""
    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        (chunk, words, codes), = rows_of(left, "chunk", "words", "codes")
        _, order = pair_order(pair_keys(risen(words), risen(codes)), bits)
        n, own = np.empty(order.size, np.uint64), np.empty(order.size, np.uint64)
        n[order], own[order] = put_together(right, "n", "own")
        return pa.table({"chunk": [chunk], "n": pa.array([packed(n)], pa.binary()), "own": pa.array([packed(own)], pa.binary()),
                         "ones": [int(((n == 1) & (own > 0)).sum())], "twos": [int(((n == 2) & (own > 0)).sum())]})

    return (held.select("chunk", "words", "codes").groupBy("chunk").cogroup(totals.groupBy("chunk"))
            .applyInArrow(join, "chunk long, n binary, own binary, ones long, twos long"))


# --- sweeps -----------------------------------------------------------------------

class Pairs:
    """A chunk's pairs, with totals over all training documents."""

    def __init__(self, table: pa.Table):
        (self.chunk, words, c, codes, n, own), = rows_of(table, "chunk", "words", "c", "codes", "n", "own")
        self.words, self.c, self.codes = risen(words), unpacked(c).astype(np.int64), risen(codes)
        size = U(self.words.size)
        self.before, self.word = (self.codes // size).astype(np.int32), (self.codes % size).astype(np.int32)
        self.n, self.own = unpacked(n).astype(np.int64), unpacked(own) > 0

    def seated(self, of_context: np.ndarray, of_word: np.ndarray, scale: tuple, sweep: int) -> np.ndarray:
        """Tables of each pair, given the totals after the sweep before: by context, by word, and `scale`."""
        discount, parent_discount, every, _ = scale
        tables = np.minimum(self.n, 1).astype(np.float64)
        more = np.flatnonzero(self.n > 1)
        parent = (of_word[self.word[more]] - parent_discount) / (STRENGTH + every)
        weight = (STRENGTH + discount * of_context[self.before[more]]) * parent
        seeds = pair_keys(self.words, self.codes[more]) + U(sweep << 32)
        tables[more] = seat(self.n[more], weight, discount, seeds)
        return tables


def swept(pairs: DataFrame, state: DataFrame | None, scale: tuple, sweep: int, buckets: int) -> DataFrame:
    """bucket, chunk, slots and the tables of owned pairs by context and by word, for each bucket of each chunk's words; and in a row
    of bucket -1, all tables of the chunk's pairs that have several customers."""
    def rows(own: Pairs, tables: np.ndarray) -> pa.Table:
        size, mine = own.words.size, own.own
        by_context = np.bincount(own.before[mine], tables[mine], size)
        by_word = np.bincount(own.word[mine], tables[mine], size)
        bucket = (own.words >> U(32)).astype(np.int64)
        there, first = np.unique(bucket, return_index=True)
        out = [(b, own.chunk, rising(own.words[i:j] & U(0xFFFFFFFF)), packed(by_context[i:j]), packed(by_word[i:j]))
               for b, i, j in zip(there.tolist(), first.tolist(), [*first[1:].tolist(), size])]
        out.append((-1, own.chunk, None, packed(tables[own.n > 1]), None))
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (
            pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "slots", "contexts", "by_word"])

    schema = "bucket long, chunk long, slots binary, contexts binary, by_word binary"
    if state is None:
        def first(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    own = Pairs(pa.Table.from_batches([batch.slice(k, 1)]))
                    yield from rows(own, np.minimum(own.n, 1).astype(np.float64)).to_batches()

        return pairs.mapInArrow(first, schema)

    def again(left: pa.Table, right: pa.Table) -> pa.Table:
        own = Pairs(left)
        contexts, by_word = put_together(right, "contexts", "by_word")
        return rows(own, own.seated(contexts.astype(np.float64), by_word.astype(np.float64), scale, sweep))

    return pairs.groupBy("chunk").cogroup(state.select("chunk", "bucket", "contexts", "by_word").groupBy("chunk")).applyInArrow(again, schema)


def table_totals(rows: DataFrame) -> DataFrame:
    """chunk, bucket and the tables of each of its words as a context and as a dish, over all chunks; in one row of a bucket, all tables
    of its words, and how many words have one and two."""
    def total(table: pa.Table) -> pa.Table:
        found = list(rows_of(table, "bucket", "chunk", "slots", "contexts", "by_word"))
        lists = [risen(s).astype(np.int64) for _, _, s, _, _ in found]
        place = np.concatenate(lists)
        contexts = np.bincount(place, np.concatenate([unpacked(x[3]) for x in found])).astype(np.int64)
        by_word = np.bincount(place, np.concatenate([unpacked(x[4]) for x in found])).astype(np.int64)
        first = [1] + [0] * (len(found) - 1)
        return pa.table({
            "chunk": [x[1] for x in found], "bucket": [x[0] for x in found],
            "contexts": pa.array([packed(contexts[s]) for s in lists], pa.binary()),
            "by_word": pa.array([packed(by_word[s]) for s in lists], pa.binary()),
            "every": [int(by_word.sum()) * f for f in first], "ones": [int((by_word == 1).sum()) * f for f in first],
            "twos": [int((by_word == 2).sum()) * f for f in first]})

    return rows.where("bucket >= 0").groupBy("bucket").applyInArrow(
        total, "chunk long, bucket long, contexts binary, by_word binary, every long, ones long, twos long")


def totals_of(df: DataFrame, *names: str) -> list[int]:
    return [x or 0 for x in df.agg(*[F.sum(n) for n in names]).first()]


def learned(docs: DataFrame, sweeps: int = SWEEPS, chunk_tokens: int = CHUNK_TOKENS) -> dict:
    """The stored tables: chunks, pairs by chunk, passes and states by sweep, their scales, and the totals of tokens and words."""
    names: list[str] = []
    chunks = by_chunk(make_chunks(docs, chunk_tokens), "lm-chunks", names)
    buckets = max(16, chunks.count())
    words = written(word_totals(word_rows(chunks, buckets)), "lm-words")
    n_tokens, n_words = totals_of(words, "tokens", "known")
    bits = min(64, -(-(20 + int(n_tokens).bit_length()) // 8) * 8)
    held = by_chunk(held_pairs(chunks, words), "lm-pairs", names)
    counted = by_chunk(counted_pairs(held, pair_totals(pair_rows(held, bits, buckets)), bits), "lm-counts", names)
    discount = discount_of(*totals_of(counted, "ones", "twos"))
    pairs = held.drop("n_here").join(counted.select("chunk", "n", "own"), "chunk")
    passes, states, scales = [], [], []
    for k in range(sweeps + 1):
        passes.append(written(swept(pairs, states[-1] if k else None, scales[-1] if k else (), k, buckets), "lm-sweep"))
        states.append(written(table_totals(passes[-1]), "lm-state"))
        every, ones, twos = totals_of(states[-1], "every", "ones", "twos")
        scales.append((discount, discount_of(ones, twos), every, n_words))
    return {"chunks": chunks, "pairs": pairs, "passes": passes, "states": states, "scales": scales, "tokens": n_tokens, "words": n_words,
            "names": names}


def score(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Per document of (doc_id, text, held_out): tokens, known tokens, base score and the model's score."""
    model = learned(docs, SWEEPS, chunk_tokens)
    scales, n_tokens, n_words = model["scales"], model["tokens"], model["words"]
    kept = range(BURN_IN + 1, len(scales))
    none = F.lit(None).cast("binary")
    given = None
    for k in kept:
        state = model["states"][k].select("chunk", F.lit(k).alias("sweep"), "bucket", "contexts", "by_word")
        tables = model["passes"][k].where("bucket < 0").select("chunk", F.lit(k).alias("sweep"), "bucket", "contexts", none.alias("by_word"))
        given = state.union(tables) if given is None else given.union(state).union(tables)

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, pairs = Chunk(left), Pairs(left)
        known = pairs.c > 0
        customers = pairs.c[pairs.before]
        p = np.zeros(pairs.codes.size)
        for k in kept:
            mine = right.filter(pc.equal(right.column("sweep"), k))
            inside = pc.greater_equal(mine.column("bucket"), 0)
            contexts, by_word = put_together(mine.filter(inside), "contexts", "by_word")
            several = unpacked(mine.filter(pc.invert(inside)).column("contexts")[0].as_py())
            discount, parent_discount, every, words = scales[k]
            tables = np.minimum(pairs.n, 1).astype(np.float64)
            tables[pairs.n > 1] = several
            parent = np.where(known, by_word.astype(np.float64) - parent_discount, STRENGTH + parent_discount * words) / (STRENGTH + every)
            mass = STRENGTH + discount * contexts.astype(np.float64)[pairs.before]
            p += (pairs.n - discount * tables + mass * parent[pairs.word]) / (STRENGTH + customers)
        logp = np.log10(p / len(kept))
        base = np.log10((pairs.c + 1) / (n_tokens + n_words + 1))
        _, which = ranked(chunk.pairs())
        starts = chunk.starts
        return pa.table({
            "doc_id": chunk.ids, "held_out": chunk.held, "n_tokens": pa.array(np.diff(starts), pa.int64()),
            "n_known": pa.array(segment_sums(known[chunk.tokens], starts).astype(np.int64)),
            "train_tokens": pa.array(np.full(starts.size - 1, n_tokens, np.int64)),
            "base_score": pa.array(segment_sums(base[chunk.tokens], starts)), "score": pa.array(segment_sums(logp[which], starts))})

    rows = model["chunks"].join(model["pairs"], "chunk").groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(
        add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    result = written(rows, "lm-scores")
    for name in model["names"]:                   # the catalog's entries; the files go with the shared folder
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return result


def query(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held_out")))
