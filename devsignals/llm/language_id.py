"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled training text: tasks add up one
vector of `buckets` counts per language, Spark sums the vectors, and the driver gets at
most languages x buckets numbers, a size that does not depend on the documents. The matrix
of log probabilities is broadcast (same bound); a batch is scored as a sparse
matrix: the bucket numbers of all its n-grams with row offsets, summed per row.

Defined cases: a text that is null, empty or without a letter is `und` with score 0. A
null `lang` teaches nothing. Equal scores go to the first language by name. Without any
training text everything is `und`. Repeated rows count as often as they occur. A
text's case, digits and punctuation do not matter. Extra columns stay as they are;
the operator's own columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from devsignals.llm.common import extended, fold, offsets_of, segment_sums, text_slices

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def ngram_buckets(texts: list[bytes], letters: np.ndarray, orders=ORDERS, buckets=BUCKETS):
    """Bucket numbers of all n-grams of the texts, per order, with row offsets; and which texts have a letter.
    `buckets` is a power of two; the number `buckets` itself stands for "not an n-gram of one text".

    A text is lower-cased, runs of other characters than letters become one space, and
    one space stands before and after it.
    """
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    codes = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    row_starts = offsets_of([len(t) + 2 for t in lowered])
    is_letter = letters[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[row_starts[:-1]] = True
    starts = np.concatenate([[0], np.cumsum(keep)])[row_starts]
    is_letter = is_letter[keep]
    codes = codes[keep]
    codes[~is_letter] = 32
    has_letter = segment_sums(is_letter, starts) > 0
    found, shift = [], np.uint32(32 - buckets.bit_length() + 1)
    h = np.zeros(codes.size + 1, dtype=np.uint32)
    for n in range(1, max(orders) + 1):
        m = codes.size - n + 1
        if m <= 0:
            break
        h = (h[:m] + codes[n - 1:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n not in orders:
            continue
        at = ((h * np.uint32(0x85EBCA6B)) >> shift).astype(np.intp)
        if n == 1:
            at[~is_letter] = buckets
        for k in range(1, n):           # those that would run over the end of a text
            last = starts[1:] - k
            at[last[(last >= 0) & (last < m)]] = buckets
        found.append((at, np.minimum(starts, m)))
    return found, has_letter


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray      # languages
    log_prob: np.ndarray       # languages x buckets


def train(docs: DataFrame, is_training: Column, text: str = "text", lang: str = "lang",
          orders=ORDERS, buckets: int = BUCKETS) -> Model:
    def count(batches):
        letters, sums = letter_table(), {}
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                found, _ = ngram_buckets(texts, letters, orders, buckets)
                langs = np.array(part.column(1).to_pylist(), dtype=object)
                for one in sorted(set(langs)):
                    mine = langs == one
                    total = sums.setdefault(one, np.zeros(buckets + 1, dtype=np.int64))
                    total[buckets] += int(mine.sum())
                    for h, starts in found:
                        own = h[:starts[-1]] if mine.all() else h[:starts[-1]][np.repeat(mine, np.diff(starts))]
                        total[:buckets] += np.bincount(own, minlength=buckets + 1)[:buckets]
        for one, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([one] * at.size, pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"])

    rows = docs.where(is_training & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    sums = (rows.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names = np.array(sums.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names))
    counts = np.zeros((len(languages), buckets + 1))
    place = {name: i for i, name in enumerate(languages)}
    counts[np.array([place[x] for x in names], dtype=np.int64), sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    grams, n_docs = counts[:, :buckets] + SMOOTHING, counts[:, buckets]
    return Model(languages, np.log(n_docs / n_docs.sum()) if languages else n_docs,
                 np.log(grams / grams.sum(axis=1, keepdims=True)) if languages else grams)


def predict(docs: DataFrame, model: Model, text: str = "text", orders=ORDERS, buckets: int = BUCKETS,
            names=("lang_pred", "score")) -> DataFrame:
    """Adds the language and its probability to the rows, as columns of these names."""
    padded = np.pad(model.log_prob, ((0, 0), (0, 1)))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, padded))

    def score(batches):
        languages, log_prior, log_prob = shared.value
        letters, choices = letter_table(), np.array(languages + [UNDETERMINED], dtype=object)
        for batch in batches:
            for part, texts in text_slices(batch, text):
                found, known = ngram_buckets(texts, letters, orders, buckets)
                total = np.repeat(log_prior[None, :], len(texts), axis=0)
                for h, starts in found:
                    for k in range(len(languages)):
                        total[:, k] += segment_sums(log_prob[k].take(h[:starts[-1]]), starts)
                if languages:
                    best = total.argmax(axis=1)
                    share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                else:
                    best, share, known = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), bool)
                out = [part.column(i) for i in range(part.num_columns)]
                out += [pa.array(choices[np.where(known, best, len(languages))], pa.string()),
                        pa.array(np.where(known, share, 0.0), pa.float64())]
                yield pa.RecordBatch.from_arrays(out, names=part.schema.names + list(names))

    rows = docs.drop(*names)
    return rows.mapInArrow(score, extended(rows.schema, **dict(zip(names, ("string", "double")))))


def identify(docs: DataFrame, id_column: str = "doc_id", held_out_parts: int = 5) -> DataFrame:
    """Learns from rows outside the held-out fold and predicts every row; adds `held_out`, `lang_pred`, `score`."""
    held_out = fold(id_column, held_out_parts) == 0
    model = train(docs, ~held_out)
    return predict(docs.withColumn("held_out", held_out), model)


def query(docs: DataFrame) -> DataFrame:
    return identify(docs.select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Documents whose language is known with at least `min_score`; the columns stay as they were."""
    model = train(docs, fold("doc_id", 5) != 0)
    known = (F.col("__language") != UNDETERMINED) & (F.col("__score") >= min_score)
    return predict(docs, model, names=("__language", "__score")).where(known).select(docs.columns)
