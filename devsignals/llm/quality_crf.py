"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line's features are measures of its characters and words, its neighbours' the same
measures again. Forward-backward gives each line's probability of being good; the
document's score is their mean weighted by the lines' lengths.

Training: every line of a labelled document carries the document's label. The fit takes
the `max_train_docs` labelled training documents with the smallest hash of their id, one text each, of
up to `max_train_bytes` and `max_train_lines` (documented bounds of the sample; what reaches the driver is their
line features). Scoring covers all texts, whole.

Defined cases: a null or empty text has one empty line and gets that line's probability.
Without training rows every score is 0.5. Labels other than 0 and 1 teach nothing; of
several labels of one id the largest holds. Repeated rows are scored alike; one row of an id is fitted on. Extra columns stay;
`held_out`, `score` and `predicted` replace input columns of these names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import extended, fold, offsets_of, text_slices

MAX_TRAIN_DOCS = 6000
MAX_TRAIN_BYTES = 1 << 20
MAX_TRAIN_LINES = 500
ROUNDS = 250
L2 = 1e-4
# groups of bytes whose shares of a line are features
GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".,;:'\"()?-", b" \t", b"=_/\\@^~`{}[]+")
N_LINE = len(GROUPS) + 7
N_FEATURES = 3 * N_LINE + 3


def group_table() -> np.ndarray:
    out = np.full(256, len(GROUPS), dtype=np.uint8)
    out[128:] = len(GROUPS) + 1
    for k, members in enumerate(GROUPS):
        out[list(members)] = k
    return out


def line_features(texts: list[bytes], groups: np.ndarray):
    """Features of all lines of the texts, the lines' lengths, and the offsets of the texts' first lines."""
    lines, counts = [], []
    for t in texts:
        own = t.split(b"\n")
        lines += own
        counts.append(len(own))
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    kinds = groups[np.frombuffer(b"".join(lines), dtype=np.uint8)]
    which = np.repeat(np.arange(len(lines), dtype=np.int64), length)
    tally = np.bincount(which * (len(GROUPS) + 2) + kinds, minlength=len(lines) * (len(GROUPS) + 2))
    tally = tally.reshape(len(lines), len(GROUPS) + 2).astype(np.float64)
    words = [x.split() for x in lines]
    n_words = np.fromiter(map(len, words), np.float64, len(lines))
    distinct = np.fromiter((len(set(w)) for w in words), np.float64, len(lines))
    per, per_word = np.maximum(length, 1), np.maximum(n_words, 1)
    ends = np.fromiter((x[-1:] in (b".", b"!", b"?") for x in lines), np.float64, len(lines))
    own = np.column_stack([
        tally[:, :len(GROUPS)] / per[:, None], tally[:, len(GROUPS) + 1] / per,
        np.log1p(length) / 8, np.log1p(n_words) / 6, length / per_word / 20, distinct / per_word, ends, n_words == 0])
    starts = offsets_of(counts)
    first, last = np.zeros(len(lines)), np.zeros(len(lines))
    first[starts[:-1]], last[starts[1:] - 1] = 1, 1
    before, after = np.roll(own, 1, axis=0) * (1 - first)[:, None], np.roll(own, -1, axis=0) * (1 - last)[:, None]
    return np.column_stack([own, before, after, first, last, np.ones(len(lines))]), np.maximum(length, 1), starts


def forward_backward(emission: np.ndarray, transition: np.ndarray, starts: np.ndarray):
    """Marginals of both labels per line, and the expected transitions, of many chains at once.

    `emission` are log scores (lines x 2); all chains step through their lines together.
    """
    counts = np.diff(starts)
    order = np.argsort(-counts, kind="stable")
    begin, counts = starts[:-1][order], counts[order]
    weight = np.exp(emission - emission.max(axis=1, keepdims=True))
    move = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(weight), np.ones_like(weight)
    steps = int(counts[0]) if counts.size else 0
    alive = np.searchsorted(-counts, -np.arange(1, steps + 1), side="right")    # chains with more than t lines
    for t in range(steps):
        at = begin[:alive[t]] + t
        a = weight[at] if t == 0 else (alpha[at - 1] @ move) * weight[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        at = begin[:alive[t + 1]] + t
        b = (weight[at + 1] * beta[at + 1]) @ move.T
        beta[at] = b / b.sum(axis=1, keepdims=True)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=1, keepdims=True)
    inner = np.ones(len(weight), dtype=bool)
    inner[starts[1:] - 1] = False
    at = np.flatnonzero(inner)
    pair = alpha[at][:, :, None] * move[None] * (weight[at + 1] * beta[at + 1])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return marginal, pair.sum(axis=0), at


def fit(features: np.ndarray, starts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS):
    """Weights of the label `good` per feature and the 2 x 2 transition scores, by Adam on the log-likelihood."""
    weights, transition = np.zeros(features.shape[1]), np.zeros((2, 2))
    line_label = np.repeat(labels, np.diff(starts)).astype(float)
    params = np.zeros(weights.size + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    n = max(1, len(features))
    for step in range(1, rounds + 1):
        weights, transition = params[:-4], params[-4:].reshape(2, 2)
        emission = np.column_stack([np.zeros(len(features)), features @ weights])
        marginal, pairs, at = forward_backward(emission, transition, starts)
        seen = np.zeros((2, 2))
        np.add.at(seen, (line_label[at].astype(int), line_label[at + 1].astype(int)), 1)
        gradient = np.concatenate([features.T @ (line_label - marginal[:, 1]), (seen - pairs).ravel()]) / n - L2 * params
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        params = params + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return params[:-4], params[-4:].reshape(2, 2)


def train(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1,
          max_train_docs: int = MAX_TRAIN_DOCS, max_train_bytes: int = MAX_TRAIN_BYTES,
          max_train_lines: int = MAX_TRAIN_LINES):
    sample = (labels.where(F.col("quality").isin(0, 1) & (fold("doc_id", parts) != held_out))
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs))

    def measure(batches):
        groups = group_table()
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                x, _, starts = line_features(texts, groups)
                x = x.astype(np.float32)
                blobs = [x[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(blobs, pa.binary())],
                                                 names=["doc_id", "quality", "x"])

    # at most max_train_docs pairs of numbers are broadcast; of repeated rows of an id one is fitted on
    short = (F.octet_length("text") <= max_train_bytes) & (F.size(F.split("text", "\n")) <= max_train_lines)
    rows = (docs.join(F.broadcast(sample), "doc_id").where(short).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
            .mapInArrow(measure, "doc_id long, quality int, x binary")
            .toArrow().sort_by([("doc_id", "ascending"), ("quality", "ascending"), ("x", "ascending")]))
    if not rows.num_rows:
        return np.zeros(N_FEATURES), np.zeros((2, 2))
    blocks = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows.column("x").to_pylist()]
    return fit(np.concatenate(blocks).astype(np.float64), offsets_of([len(b) for b in blocks]),
               rows.column("quality").to_numpy())


def score(docs: DataFrame, model) -> DataFrame:
    """Adds `score` and `predicted` to the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches):
        groups, (weights, transition) = group_table(), shared.value
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                x, length, starts = line_features(texts, groups)
                marginal, _, _ = forward_backward(np.column_stack([np.zeros(len(x)), x @ weights]), transition, starts)
                good = np.add.reduceat(marginal[:, 1] * length, starts[:-1]) / np.add.reduceat(length, starts[:-1])
                good = np.clip(good, 0.0, 1.0)
                out = [part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    out + [pa.array(good, pa.float64()), pa.array((good >= 0.5).astype(np.int32), pa.int32())],
                    names=part.schema.names + ["score", "predicted"])

    rows = docs.drop("score", "predicted")
    return rows.mapInArrow(label, extended(rows.schema, score="double", predicted="integer"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    marked = docs.withColumn("held_out", fold("doc_id", 3) == 1)
    return score(marked, train(docs, labels)).select("doc_id", "held_out", "score", "predicted")
