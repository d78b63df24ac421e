"""Toxicity through a noisy channel: obfuscated spellings are restored by Viterbi decoding, then restored text is scored.

Channel. Written text is taken for clean letters that were replaced by lookalikes (`1d10t`), spread out (`i d i o t`, `i.d.i.o.t`) or
repeated (`idiooot`). Backwards, a token is a lattice: a letter stays, or drops out if it repeats the one before; a lookalike is
one of its letters, or a gap between words; another symbol is a gap or drops out. Three or more single characters
in a row, each a token, are one lattice with the white space between them. Every way has a cost (`COSTS`).
Language model. Trigrams of characters with gaps, counted over all training texts; 64 classes of characters, so the table has
a fixed size whatever the corpus.
Decoding. The cheapest path under both, found for many tokens at once. The state is the last two
characters; up to `STATES` states a position are kept, which is all of them but in tokens made of many ambiguous symbols.
Tokens without a letter are gaps; those with a single path are not decoded, others once per task as long as they are in its table.

Score. Logistic regression with a ridge on the presence of restored words, fitted on the `max_train_docs`
labelled training documents with the smallest hash of their id and up to `max_train_bytes` of text (documented bounds
of the sample; what reaches the driver are hashes of their words). Near-copies within the sample count once. All texts
are scored, whole.

Defined cases: a null or empty text has no words and gets the score of none, as do texts without letters. A run of more than three equal
characters enters the lattice as three; a token above `PIECE` characters is decoded in pieces of that length. Without training rows of both
labels every score is 0. Labels other than 0 and 1 teach nothing; of several labels of one id the largest holds. Repeated
rows are scored alike; one row of an id is fitted on. Extra columns stay; `score`, `predicted` replace columns of these names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import extended, fold, offsets_of, text_slices

PARTS, HELD_OUT = 5, 0
MAX_TRAIN_DOCS = 8000
MAX_TRAIN_BYTES = 1 << 20
CLASSES = 64
STATES = 16
PIECE = 64
HELD_TOKENS = 300_000
MAX_WORDS = 4096
MIN_DOCS = 6
PENALTY = 0.05
ROUNDS = 40
SEED = 42

# fixed values: letters that a symbol stands for
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "li", "+": "t", "€": "e", "¡": "i", "£": "l", "¢": "c"}
# natural logarithms: of a lookalike; of a digit, another symbol (before, behind, between words or within one), a lookalike that letters
# follow, or a space as a gap; of a symbol, a lookalike or a space that drops out; of a repeated letter that drops out where two or three stand
COSTS = {"lookalike": 1.0, "digit gap": 8.0, "gap before": 0.5, "gap behind": 0.3, "gap between": 0.5, "gap within": 4.0, "lookalike gap": 6.0, "space gap": 5.0,
         "symbol out": 2.5, "lookalike out": 7.0, "space out": 0.3, "second out": 5.0, "third out": 0.5}
SPACED = re.compile(r"(?<!\S)\S(?:[^\S\n]\S){2,}(?!\S)")
RUNS = re.compile(r"(.)\1{3,}", re.DOTALL)
LETTER = re.compile(r"[^\W\d_]")
PAIR = re.compile(r"(.)\1", re.DOTALL)


def tables() -> dict[str, np.ndarray]:
    """Per code point: class of a letter, two letters it may stand for with their costs, and its kind (1 symbol, 2 digit, 3 letter)."""
    n = 1 << 16
    letter = np.array([chr(c).isalpha() and not 0xD800 <= c < 0xE000 for c in range(n)])
    code = np.arange(n)
    of = np.where(letter, 27 + code % (CLASSES - 27), 0)
    of[ord("a"):ord("z") + 1] = np.arange(1, 27)
    first, second = np.where(letter, code, 0), np.zeros(n, np.int64)
    first_cost, second_cost = np.where(letter, 0.0, np.inf), np.full(n, np.inf)
    digits = np.array([chr(c).isdigit() for c in range(n)])
    kind = np.where(letter, 3, np.where(digits, 2, 1))
    kind[0] = 0
    for symbol, letters in LOOKALIKES.items():
        at = ord(symbol)
        first[at], first_cost[at] = ord(letters[0]), COSTS["lookalike"]
        if len(letters) > 1:
            second[at], second_cost[at] = ord(letters[1]), COSTS["lookalike"]
    return {"class": of, "first": first, "second": second, "first_cost": first_cost, "second_cost": second_cost, "kind": kind}


def gaps_of(code: np.ndarray, kind: np.ndarray, alike: np.ndarray):
    """Per position the cost as a gap and of dropping out; infinite for letters, and for digits that would drop out."""
    kinds = kind[code]
    solid = kinds >= 2
    beside = np.pad(solid, ((0, 0), (2, 2)))
    begun, ends = np.cumsum(solid, axis=1) > 0, np.cumsum(solid[:, ::-1], axis=1)[:, ::-1] > 0
    words = beside[:, :-4] & beside[:, 1:-3] & beside[:, 3:-1] & beside[:, 4:]     # two letters on either side
    gap = np.where(~ends, COSTS["gap behind"], np.where(~begun, COSTS["gap before"],
                   np.where(words, COSTS["gap between"], COSTS["gap within"])))
    space = code == ord(" ")
    likely = (kinds == 1) & alike[code]
    gap = np.where(likely & ends, COSTS["lookalike gap"], gap)
    gap = np.where(space, COSTS["space gap"], np.where(kinds == 2, COSTS["digit gap"], np.where(kinds == 3, np.inf, gap)))
    return gap, np.where(solid, np.inf, np.where(space, COSTS["space out"],
                                                np.where(likely, COSTS["lookalike out"], COSTS["symbol out"])))


def codes_of(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), (1 << 16) - 1).astype(np.int64)


def trigram_counts(texts: list[bytes], of: np.ndarray) -> np.ndarray:
    """Counts of (before, last, next) over words and one gap after each; a word starts after two gaps."""
    x = of[codes_of("\n".join(t.decode("utf-8", "replace") for t in texts).lower() + "\n")]
    x = x[(x > 0) | np.concatenate([[False], x[:-1] > 0])]
    last = np.concatenate([[0], x[:-1]])
    before = np.where(last > 0, np.concatenate([[0, 0], x[:-2]])[:x.size], 0)
    return np.bincount((before * CLASSES + last) * CLASSES + x, minlength=CLASSES ** 3)


def language_model(docs: DataFrame) -> np.ndarray:
    """Costs of a class after two others, from the trigrams of all texts."""
    def count(batches):
        of, total = tables()["class"], np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                total += trigram_counts(texts, of)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["trigram", "n"])

    # at most CLASSES^3 sums come back
    found = (docs.select("text").mapInArrow(count, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(CLASSES ** 3)
    counts[found.column("trigram").to_numpy()] = found.column("n").to_numpy()
    return smoothed(counts.reshape(CLASSES, CLASSES, CLASSES))


def smoothed(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Negative logarithms of trigram shares, each drawn to the share of the shorter context."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = counts.sum(axis=0)
    two = (two + weight * one) / (two.sum(axis=1, keepdims=True) + weight)
    three = (counts + weight * two[None]) / (counts.sum(axis=2, keepdims=True) + weight)
    cost = -np.log(three)
    cost[0, 0, 0] = 0.0                       # a gap after a gap is the same gap
    return cost.astype(np.float32)


def decoded(units: list[str], cost: np.ndarray, t: dict[str, np.ndarray], states: int = STATES) -> list[str]:
    """The cheapest restoration of each unit (lower case, not empty); words are parted by spaces."""
    order = sorted(range(len(units)), key=lambda k: -len(units[k]))
    out = [""] * len(units)
    for start in range(0, len(order), 2048):
        part = order[start:start + 2048]
        for k, text in zip(part, _decoded([units[k] for k in part], cost, t, states)):
            out[k] = text
    return out


def _decoded(units: list[str], cost: np.ndarray, t: dict[str, np.ndarray], states: int) -> list[str]:
    sizes = np.fromiter(map(len, units), np.int64, len(units))         # descending
    n, width = len(units), int(sizes[0])
    code = np.zeros((n, width), np.int64)
    code[np.arange(width) < sizes[:, None]] = codes_of("".join(units))
    same = np.zeros((n, width + 1), bool)
    same[:, 1:-1] = (code[:, 1:] == code[:, :-1]) & (code[:, 1:] > 0)
    three = same[:, :-1] & same[:, 1:]
    three[:, 1:] |= same[:, 1:-1] & same[:, :-2]
    repeat = np.where(same[:, :-1], np.where(three, COSTS["third out"], COSTS["second out"]), np.inf)
    gap, out = gaps_of(code, t["kind"], (t["kind"] < 3) & np.isfinite(t["first_cost"]))
    ways = np.stack([t["first_cost"][code], t["second_cost"][code], gap, np.minimum(out, repeat)], axis=2)
    letters = [t["first"][code], t["second"][code]]
    classes = [t["class"][x] for x in letters]
    a, b = np.zeros((n, 1), np.int64), np.zeros((n, 1), np.int64)
    total = np.zeros((n, 1))
    back = np.zeros((width, n, states), np.int16)
    active = np.searchsorted(-sizes, -np.arange(width), side="left")   # units longer than a position
    for at in range(width):
        m = int(active[at])
        x, y, own = a[:m], b[:m], total[:m]
        c1, c2, w = classes[0][:m, at, None], classes[1][:m, at, None], ways[:m, at]
        cand = np.concatenate([own + w[:, 0:1] + cost[x, y, c1], own + w[:, 1:2] + cost[x, y, c2],
                               own + w[:, 2:3] + cost[x, y, 0], own + w[:, 3:4]], axis=1)
        keys = np.concatenate([y * CLASSES + c1, y * CLASSES + c2, np.zeros_like(x), x * CLASSES + y], axis=1)
        rows, k, held = np.arange(m), 0, own.shape[1]
        new_total, new_key = np.full((m, states), np.inf), np.zeros((m, states), np.int64)
        while k < states:
            best = np.argmin(cand, axis=1)
            value = cand[rows, best]
            if not np.isfinite(value).any():
                break
            key = keys[rows, best]
            new_total[:, k], new_key[:, k] = value, key
            back[at, :m, k] = (best % held) * 4 + best // held
            cand[keys == key[:, None]] = np.inf
            k += 1
        k = max(k, 1)
        if k > total.shape[1]:
            grow = k - total.shape[1]
            total = np.pad(total, ((0, 0), (0, grow)), constant_values=np.inf)
            a, b = np.pad(a, ((0, 0), (0, grow))), np.pad(b, ((0, 0), (0, grow)))
        total[:m], a[:m], b[:m] = np.inf, 0, 0
        total[:m, :k], a[:m, :k], b[:m, :k] = new_total[:, :k], new_key[:, :k] // CLASSES, new_key[:, :k] % CLASSES
    slot = np.argmin(total + cost[a, b, 0], axis=1)
    result = np.zeros((n, width), np.uint32)
    for at in range(width - 1, -1, -1):
        m = int(active[at])
        step = back[at, np.arange(m), slot[:m]]
        way, slot[:m] = step % 4, step // 4
        result[:m, at] = np.choose(way, [letters[0][:m, at], letters[1][:m, at], 32, 0])
    text = result[result > 0].tobytes().decode("utf-32-le", "replace")
    ends = np.cumsum((result > 0).sum(axis=1))
    return [text[p:q] for p, q in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Restorer:
    """Restores tokens, and holds what it has restored as long as that is not too much."""

    def __init__(self, cost: np.ndarray, value=lambda words: words):
        self.cost, self.value, self.tables, self.held = cost, value, tables(), {}

    def units_of(self, text: str) -> set[str]:
        """The distinct tokens of a text; characters that stand spaced out are one."""
        spaced = SPACED.findall(text)
        if spaced:
            text = SPACED.sub(" ", text)
        return set(text.split()).union(" ".join(s.split()) for s in spaced)

    def prepare(self, units: set[str]) -> None:
        """Decodes those of the units that have several paths."""
        if len(self.held) > HELD_TOKENS:
            self.held.clear()
        new = [u for u in units if u not in self.held]
        pieces, owner = [], []
        for u in new:
            if u.isalpha() and not PAIR.search(u):
                self.held[u] = self.value([u])
                continue
            if not LETTER.search(u):
                self.held[u] = self.value([])
                continue
            short = RUNS.sub(r"\1\1\1", u)
            for at in range(0, len(short), PIECE):
                pieces.append(short[at:at + PIECE])
                owner.append(u)
        words: dict[str, list[str]] = {}
        for u, text in zip(owner, decoded(pieces, self.cost, self.tables)):
            words.setdefault(u, []).extend(text.split())
        for u, own in words.items():
            self.held[u] = self.value(own)

    def values(self, texts: list[bytes]) -> list[list]:
        """Per text the values of its distinct units."""
        own = [self.units_of(t.decode("utf-8", "replace").lower()) for t in texts]
        self.prepare(set().union(*own))
        held = self.held
        return [[held[u] for u in units] for units in own]


def word_hashes(words: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(w, SEED) for w in words]


def restore(docs: DataFrame, cost: np.ndarray) -> DataFrame:
    """Adds `restored`: the text in lower case with every token in its decoded spelling, spaced-out characters joined."""
    shared = docs.sparkSession.sparkContext.broadcast(cost)

    def run(batches):
        restorer = Restorer(shared.value, " ".join)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                out = []
                for t in texts:
                    text = t.decode("utf-8", "replace").lower()
                    restorer.prepare(restorer.units_of(text))
                    text = SPACED.sub(lambda m: restorer.held[" ".join(m.group().split())], text)
                    restorer.prepare(set(text.split()))
                    out.append("".join(restorer.held[x] if x and not x.isspace() else x for x in re.split(r"(\s+)", text)))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(part.num_columns)] + [pa.array(out, pa.string())],
                                                 names=part.schema.names + ["restored"])

    rows = docs.drop("restored")
    return rows.mapInArrow(run, extended(rows.schema, restored="string"))


def fit(words: list[np.ndarray], labels: np.ndarray, max_words: int = MAX_WORDS, penalty: float = PENALTY, rounds: int = ROUNDS):
    """Word hashes (sorted), their weights, and the constant, by Newton steps."""
    seen, own = set(), []
    for k, w in enumerate(words):                 # copies share their smallest hashes
        mark = (labels[k], np.sort(w)[:4].tobytes())
        if w.size and mark in seen:
            continue
        seen.add(mark)
        own.append(k)
    words, y = [words[k] for k in own], labels[own].astype(float)
    empty = np.zeros(0, np.uint64), np.zeros(0), -np.inf
    if not y.size or y.min() == y.max():
        return empty
    flat, starts = np.concatenate(words), offsets_of([w.size for w in words])
    names, at = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(y.size), np.diff(starts))
    bad, n = np.bincount(at, weights=y[row], minlength=names.size), np.bincount(at, minlength=names.size)
    share = y.mean()
    excess = (bad - n * share) / np.sqrt(np.maximum(n, 1) * share * (1 - share))
    chosen = np.flatnonzero((bad >= MIN_DOCS) & (excess > 3))
    chosen = np.sort(chosen[np.argsort(-excess[chosen], kind="stable")[:max_words]])
    place = np.full(names.size, -1)
    place[chosen] = np.arange(chosen.size)
    use = place[at] >= 0
    row, col = row[use], place[at[use]]
    # the last weight is the constant, which has no penalty
    x = np.zeros(chosen.size + 1)
    x[-1] = np.log(share / (1 - share))
    ridge = np.append(np.full(chosen.size, penalty), 1e-6)
    times = lambda v: v[-1] + np.bincount(row, weights=v[col], minlength=y.size)
    back = lambda v: np.append(np.bincount(col, weights=v[row], minlength=chosen.size), v.sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(x), -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6)
        gradient = back(p - y) + ridge * x
        step, left = np.zeros_like(x), -gradient
        way, size = left.copy(), left @ left
        for _ in range(100):                       # conjugate gradients
            if size < 1e-10:
                break
            bent = back(curve * times(way)) + ridge * way
            far = size / (way @ bent)
            step, left = step + far * way, left - far * bent
            size, before = left @ left, size
            way = left + size / before * way
        x = x + step * min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return names[chosen], x[:-1], float(x[-1])


def train(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS, max_train_bytes: int = MAX_TRAIN_BYTES):
    """The language model's costs and the fitted weights."""
    training = docs.where(fold("doc_id", PARTS) != HELD_OUT)
    cost = language_model(training)
    sample = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", PARTS) != HELD_OUT))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs))
    shared = docs.sparkSession.sparkContext.broadcast(cost)

    def measure(batches):
        restorer = Restorer(shared.value, word_hashes)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                own = [np.unique(np.array(sum(v, []), dtype=np.uint64)).tobytes() for v in restorer.values(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.binary())],
                                                 names=["doc_id", "toxic", "words"])

    # at most max_train_docs pairs of numbers are broadcast; one text of each id is measured
    rows = (training.where(F.octet_length("text") <= max_train_bytes).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "toxic", "text")
            .mapInArrow(measure, "doc_id long, toxic int, words binary").toArrow().sort_by("doc_id"))
    words = [np.frombuffer(w, np.uint64) for w in rows.column("words").to_pylist()]
    return cost, fit(words, rows.column("toxic").to_numpy())


def score(docs: DataFrame, model) -> DataFrame:
    """Adds `score` and `predicted` to the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        cost, (names, weights, constant) = shared.value
        weight_of = dict(zip(names.tolist(), range(names.size)))
        restorer = Restorer(cost, lambda words: [k for h in word_hashes(words) if (k := weight_of.get(h)) is not None])
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                z = np.array([constant + sum(weights[k] for k in {k for v in own if v for k in v}) for own in restorer.values(texts)])
                p = np.where(z > -700, 1 / (1 + np.exp(-np.clip(z, -700, 700))), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns)] +
                    [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                    names=part.schema.names + ["score", "predicted"])

    rows = docs.drop("score", "predicted")
    return rows.mapInArrow(run, extended(rows.schema, score="double", predicted="integer"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    marked = docs.withColumn("held_out", fold("doc_id", PARTS) == HELD_OUT)
    return score(marked, train(docs, labels)).select("doc_id", "held_out", "score", "predicted")
