"""SentencePiece encoding and decoding (BPE with byte fallback) by vectorised merge rounds.

A text is cut into words before each space mark that follows another character; no piece of the
vocabulary reaches over such a place (checked when the model is read), so words merge independently.
Each distinct word is encoded once per task. All new words lie in one flat array of symbols. A
round looks up the rank of every neighbouring pair, takes the minimum per word (a segmented
reduction), merges in all words at once every occurrence of that piece from the left, and
compacts the arrays. Words without a pair leave; rounds end when none is left. Where a merge brings
up a pair of better rank beside it, only the word's leftmost merge is done in that round, so
the order is always that of one merge at a time.

The model file is read from a path (a parameter) with the sentencepiece library, for its
vocabulary only; the file's ids and scores travel to tasks as a broadcast of fixed size.

Defined cases: null counts as empty; an empty text has no ids and decodes to the empty text.
Characters outside the vocabulary become their UTF-8 bytes. Decoding joins bytes that follow each
other and puts U+FFFD for those that are not UTF-8. Repeated rows are encoded alike. Extra columns
stay; `ids`, `n_tokens` and `decoded` replace input columns of these names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, fields
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import extended, offsets_of, text_slices

MARK = "▁"
NEW_WORD = re.compile(MARK + "+[^" + MARK + "]*|[^" + MARK + "]+")
NONE = np.iinfo(np.int64).max
MAX_CACHED_WORDS = 1 << 18
DECODED_IDS = 1 << 19        # ids decoded at a time (one row at least)


@dataclass
class Vocabulary:
    pieces: list[str]              # by id
    ranks: dict[str, int]          # of pieces that text can become: 0 is merged first
    ids: dict[str, int]
    byte_ids: np.ndarray           # ids of the 256 byte pieces
    kinds: np.ndarray              # by id: 0 text, 1 byte, 2 control, 3 unknown
    pair_keys: np.ndarray          # open-addressing table of left * size + right, for the pairs that merge
    pair_rank: np.ndarray
    pair_symbol: np.ndarray
    probes: int                    # longest way to a key
    unknown: str                   # what an unknown id decodes to


def plain(v: Vocabulary) -> tuple:
    """The vocabulary's parts, to be broadcast: tasks make it again and need no package on their path."""
    return tuple(getattr(v, f.name) for f in fields(v))


def read_vocabulary(path: str) -> Vocabulary:
    """Symbols are piece ids; a character outside the vocabulary gets a number beyond them."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    kinds = np.array([1 if model.is_byte(i) else 2 if model.is_control(i) else 3 if model.is_unknown(i) else 0
                      for i in range(size)], dtype=np.int8)
    ids = {pieces[i]: i for i in range(size) if kinds[i] == 0}
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in ids):
        raise ValueError("a piece reaches over a word's begin; this vocabulary needs another cut")
    order = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in ids.values()}, reverse=True))}
    ranks = {p: order[model.get_score(i)] for p, i in ids.items()}
    merges = sorted((ids[p[:k]] * size + ids[p[k:]], ranks[p], i)
                    for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
    keys, rank, symbol = (np.array(x, dtype=np.int64) for x in zip(*merges))
    keys, rank, symbol, probes = hashed(keys, rank, symbol)
    byte_ids = np.zeros(256, dtype=np.int64)
    for i in np.flatnonzero(kinds == 1):
        byte_ids[int(pieces[i][3:5], 16)] = i
    return Vocabulary(pieces, ranks, ids, byte_ids, kinds, keys, rank, symbol, probes, model.decode([model.unk_id()]))


TABLE_BITS = 18


def slot_of(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def hashed(keys, rank, symbol):
    """The pairs in a table where a key stands in its slot or in one of the next `probes` slots."""
    size = 1 << TABLE_BITS
    if keys.size > size // 2:
        raise ValueError("the vocabulary has more merges than the table holds")
    table, ranks, symbols = np.full(size, -1, np.int64), np.full(size, NONE, np.int64), np.zeros(size, np.int64)
    probes = 0
    for key, slot, r, s in zip(keys.tolist(), slot_of(keys).tolist(), rank.tolist(), symbol.tolist()):
        steps = 0
        while table[(slot + steps) % size] != -1:
            steps += 1
        at = (slot + steps) % size
        table[at], ranks[at], symbols[at] = key, r, s
        probes = max(probes, steps)
    return table, ranks, symbols, probes


class Merger:
    """Encodes words; keeps what it has encoded, up to a fixed number of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.size = len(vocabulary.pieces)
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + self.size      # by code point
        for piece, i in vocabulary.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self.forget()

    def forget(self):
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def pair_at(self, left: np.ndarray, right: np.ndarray):
        """Rank and merged symbol of pairs; `NONE` where they do not merge."""
        v = self.v
        key = np.where((left < self.size) & (right < self.size), left * self.size + right, -2)
        at = slot_of(key)
        there = v.pair_keys[at]
        open_ = np.flatnonzero((there != key) & (there != -1))
        for _ in range(v.probes):       # slots taken by another key: look further
            if not open_.size:
                break
            at[open_] = (at[open_] + 1) & ((1 << TABLE_BITS) - 1)
            there = v.pair_keys[at[open_]]
            open_ = open_[(there != key[open_]) & (there != -1)]
        known = v.pair_keys[at] == key
        return np.where(known, v.pair_rank[at], NONE), v.pair_symbol[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of the words."""
        size = self.size
        symbols = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype=np.uint32)]
        word = np.repeat(np.arange(len(words), dtype=np.int64), [len(w) for w in words])
        done_symbols, done_words = [], []
        rank, merged = self._pairs(symbols, word)
        while symbols.size:
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.concatenate([heads, [symbols.size]]))
            best = np.minimum.reduceat(rank, heads)
            open_ = best != NONE
            if not open_.all():
                closed = np.repeat(~open_, lengths)
                done_symbols.append(symbols[closed])
                done_words.append(word[closed])
                keep = ~closed
                symbols, word, rank, merged = symbols[keep], word[keep], rank[keep], merged[keep]
                lengths, best = lengths[open_], best[open_]
                if not symbols.size:
                    break
                heads = offsets_of(lengths)[:-1]
            least = np.repeat(best, lengths)
            hit = rank == least
            take = self._leftmost(hit)
            at = np.flatnonzero(take)
            # what stands left of a merge once the merges before it are done, and right of it before those after it
            left = np.where((at >= 2) & take[np.maximum(at - 2, 0)], merged[np.maximum(at - 2, 0)], symbols[np.maximum(at - 1, 0)])
            same_left = (at >= 1) & (word[np.maximum(at - 1, 0)] == word[at])
            far = np.minimum(at + 2, symbols.size - 1)
            same_right = (at + 2 < symbols.size) & (word[far] == word[at])
            rank_left = np.where(same_left, self.pair_at(left, merged[at])[0], NONE)
            rank_right = np.where(same_right, self.pair_at(merged[at], symbols[far])[0], NONE)
            better = np.minimum(rank_left, rank_right) <= least[at]
            if better.any():        # there only the leftmost merge of the word
                single = np.isin(word[at], word[at[better]])
                first = np.concatenate([[True], word[at][1:] != word[at][:-1]])
                take[at[single & ~first]] = False
                at = np.flatnonzero(take)
            symbols[at] = merged[at]
            keep = np.ones(symbols.size, dtype=bool)
            keep[at + 1] = False
            changed = np.zeros(symbols.size, dtype=bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            before = np.maximum(at - 2, 0)
            changed[before[~keep[np.maximum(at - 1, 0)]]] = True
            symbols, word, rank, merged, changed = symbols[keep], word[keep], rank[keep], merged[keep], changed[keep]
            at = np.flatnonzero(changed)
            rank[at], merged[at] = self._pairs_at(symbols, word, at)
        if done_symbols:
            symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
            order = np.argsort(word, kind="stable")
            symbols, word = symbols[order], word[order]
        counts = np.bincount(word, minlength=len(words))
        outside = np.flatnonzero(symbols >= size)
        if outside.size:            # characters without a piece: their bytes
            spelled = [self.v.byte_ids[list(chr(s - size).encode("utf-8", "replace"))] for s in symbols[outside]]
            n_bytes = np.ones(symbols.size, dtype=np.int64)
            n_bytes[outside] = [len(x) for x in spelled]
            counts = np.bincount(word, weights=n_bytes, minlength=len(words)).astype(np.int64)
            at = offsets_of(n_bytes)
            symbols = np.repeat(symbols, n_bytes)
            for k, x in zip(outside, spelled):
                symbols[at[k]:at[k] + len(x)] = x
        return symbols.astype(np.int32), offsets_of(counts)

    def _pairs_at(self, symbols, word, at):
        nxt = np.minimum(at + 1, symbols.size - 1)
        rank, merged = self.pair_at(symbols[at], symbols[nxt])
        return np.where((nxt > at) & (word[nxt] == word[at]), rank, NONE), merged

    def _pairs(self, symbols, word):
        return self._pairs_at(symbols, word, np.arange(symbols.size))

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of runs of neighbouring hits, which overlap, every other one from the left."""
        at = np.flatnonzero(hit)
        run = np.cumsum(np.concatenate([[True], at[1:] != at[:-1] + 1])) - 1
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        out = np.zeros_like(hit)
        out[at[(np.arange(at.size) - first[run]) % 2 == 0]] = True
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of the texts."""
        if len(self.places) > MAX_CACHED_WORDS:
            self.forget()
        split = [NEW_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        places = self.places
        new = list(set(chain.from_iterable(split)).difference(places))
        if new:
            flat, starts = self.merge(new)
            places.update(zip(new, range(len(places), len(places) + len(new))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
            self.flat = np.concatenate([self.flat, flat])
        counts = np.fromiter(map(len, split), np.int64, len(split))
        which = np.fromiter(map(places.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        begin, length = self.starts[which], np.diff(self.starts)[which]
        ends = offsets_of(length)
        ids = self.flat[np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])]
        return ids, ends[offsets_of(counts)]


def encode(docs: DataFrame, model_path: str, text: str = "text", and_decode: bool = False) -> DataFrame:
    """Adds `ids` (array of int) to the rows; with `and_decode` also `decoded`, the text of the ids, in the same pass."""
    shared = docs.sparkSession.sparkContext.broadcast(plain(read_vocabulary(model_path)))
    added = {"ids": "array<int>"} | ({"decoded": "string"} if and_decode else {})

    def run(batches):
        vocabulary = Vocabulary(*shared.value)
        merger, pieces = Merger(vocabulary), piece_table(vocabulary)
        for batch in batches:
            for part, raw in text_slices(batch, text):
                ids, starts = merger.encode([x.decode("utf-8", "replace") for x in raw])
                out = [part.column(i) for i in range(part.num_columns)]
                out.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())))
                if and_decode:
                    out.append(pa.array(decode_flat(vocabulary, ids, starts, pieces), pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=part.schema.names + list(added))

    rows = docs.drop(*added)
    return rows.mapInArrow(run, extended(rows.schema, **added))


def decode_flat(v: Vocabulary, ids: np.ndarray, starts: np.ndarray, table: list[bytes]) -> list[str]:
    """Texts of id sequences. `table`: by id, the bytes of a piece with spaces for marks."""
    width = np.fromiter(map(len, table), np.int64, len(table))
    letters, begin = np.frombuffer(b"".join(table), dtype=np.uint8), offsets_of(width)
    ids = ids.astype(np.int64)
    length = width[ids]
    ends = offsets_of(length)
    raw = letters[np.repeat(begin[ids] - ends[:-1], length) + np.arange(ends[-1])].tobytes()
    speaks = v.kinds[ids] != 2
    first = np.concatenate([np.flatnonzero(speaks), [ids.size]])[offsets_of(speaks)[starts[:-1]]]
    stripped = (first < starts[1:]) & (v.kinds[ids[np.minimum(first, ids.size - 1)]] == 0) if ids.size else starts[1:] < 0
    bounds, places, out = ends[starts].tolist(), starts.tolist(), []
    for k, strip in enumerate(stripped.tolist()):
        own = raw[bounds[k]:bounds[k + 1]]
        try:
            text = own.decode()
        except UnicodeDecodeError:
            text = with_broken_bytes(v, ids[places[k]:places[k + 1]].tolist(), table)
        out.append(text[1:] if strip and text[:1] == " " else text)
    return out


def with_broken_bytes(v: Vocabulary, ids: list[int], table: list[bytes]) -> str:
    """Byte pieces are UTF-8 among themselves only, not together with the pieces beside them."""
    runs = [(is_byte, b"".join(table[i] for i in run)) for is_byte, run in groupby(ids, lambda i: v.kinds[i] == 1)]
    return "".join(replaced(raw) if is_byte else raw.decode() for is_byte, raw in runs)


def replaced(raw: bytes) -> str:
    """UTF-8 with U+FFFD for every byte that is not part of a character."""
    out = []
    while raw:
        try:
            return "".join(out) + raw.decode()
        except UnicodeDecodeError as e:
            out.append(raw[:e.start].decode() + "�")
            raw = raw[e.start + 1:]
    return "".join(out)


def piece_table(v: Vocabulary) -> list[bytes]:
    inverse = {int(i): bytes([b]) for b, i in enumerate(v.byte_ids)}
    spelled = {0: lambda i: v.pieces[i].replace(MARK, " ").encode(), 1: inverse.get, 2: lambda i: b"",
               3: lambda i: v.unknown.encode()}
    return [spelled[int(kind)](i) for i, kind in enumerate(v.kinds)]


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """Adds `decoded`, the text of the column `ids`; null ids decode to the empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(plain(read_vocabulary(model_path)))

    def run(batches):
        v = Vocabulary(*shared.value)
        pieces = piece_table(v)
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(batch.schema.get_field_index("ids"))), 0)
            ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                most = (ends[start - 1] if start else 0) + DECODED_IDS
                stop = max(start + 1, int(np.searchsorted(ends, most, side="right")))
                part = batch.slice(start, stop - start)
                ids = part.column(part.schema.get_field_index("ids")).flatten().to_numpy(zero_copy_only=False)
                texts = decode_flat(v, ids, offsets_of(np.diff(ends[start:stop], prepend=ends[start - 1] if start else 0)), pieces)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns)] + [pa.array(texts, pa.string())],
                    names=part.schema.names + ["decoded"])
                start = stop

    rows = rows.drop("decoded")
    return rows.mapInArrow(run, extended(rows.schema, decoded="string"))


def query(docs: DataFrame, model_path: str) -> DataFrame:
    coded = encode(docs.select("doc_id", "text"), model_path, and_decode=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """The rows with their ids, the number of them, and the text that decoding gives back."""
    coded = encode(docs.drop("n_tokens"), model_path, and_decode=True)
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))
