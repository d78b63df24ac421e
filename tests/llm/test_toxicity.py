"""Decoding of obfuscated spellings, and scores of toxicity."""

import itertools
import random
import zlib

import numpy as np
import pytest

from devsignals.llm import queries, toxicity
from devsignals.llm.common import table

FOLDER = "/root/testdata/sf0.1"
INSULTS = "trash pathetic idiot disgusting worthless stupid clown loser scum moron".split()


@pytest.fixture(scope="module")
def trained(spark):
    return toxicity.train(table(spark, FOLDER, "documents").select("doc_id", "text"), table(spark, FOLDER, "labels"))


def plain_decoded(unit, cost, t):
    """The cheapest of all paths, one by one."""
    code = toxicity.codes_of(unit)[None, :]
    gap, out = toxicity.gaps_of(code, t["kind"], (t["kind"] < 3) & np.isfinite(t["first_cost"]))
    ways = []
    for k, c in enumerate(code[0]):
        own = [(chr(t["first"][c]), t["first_cost"][c]), (chr(t["second"][c]), t["second_cost"][c]), (" ", gap[0, k])]
        dropped = out[0, k]
        if k and unit[k] == unit[k - 1]:
            run = len(unit) > k + 1 and unit[k + 1] == unit[k] or k > 1 and unit[k - 2] == unit[k]
            dropped = min(dropped, toxicity.COSTS["third out" if run else "second out"])
        ways.append([w for w in own + [("", dropped)] if np.isfinite(w[1])])
    best = (np.inf, "")
    for path in itertools.product(*ways):
        a = b = 0
        total = 0.0
        for letter, own in path:
            total += own
            if letter:
                c = 0 if letter == " " else int(t["class"][ord(letter)])
                total += cost[a, b, c]
                a, b = (0, 0) if c == 0 else (b, c)
        total += cost[a, b, 0]
        best = min(best, (total, "".join(x for x, _ in path)))
    return best[1]


def test_viterbi_finds_the_cheapest_path(trained):
    cost, t = trained[0], toxicity.tables()
    rng = random.Random(5)
    units = ["".join(rng.choices("abeoit01!3$|.-", k=rng.randint(1, 7))) for _ in range(60)] + ["1d10t", "l00ser", "a b c d"]
    assert toxicity.decoded(units, cost, t) == [plain_decoded(u, cost, t) for u in units]


def test_trigrams_of_a_plain_count():
    of = toxicity.tables()["class"]
    got = toxicity.trigram_counts([b"Ab, ab\nc", "é".encode()], of)
    e = 27 + ord("é") % 37
    want = {(0, 0, 1): 2, (0, 1, 2): 2, (1, 2, 0): 2, (0, 0, 3): 1, (0, 3, 0): 1, (0, 0, e): 1, (0, e, 0): 1}
    assert {(k // 4096, k // 64 % 64, k % 64): int(got[k]) for k in np.flatnonzero(got)} == want


def test_known_spellings(trained):
    restorer = toxicity.Restorer(trained[0])
    texts = ["you 1d10t!!", "such a m o r o n here", "IDIOOOOT", "i.d.i.o.t", "call 555-8590 now", "the idiot, the clown", "stup1d l0ser"]
    words = [{w for own in values for w in own} for values in restorer.values([x.encode() for x in texts])]
    for own, word in zip(words, ["idiot", "moron", "idiot", "idiot", "now", "clown", "stupid"]):
        assert word in own, (own, word)
    assert "loser" in words[-1] and words[4] == {"call", "now"}


def obfuscated(word, kind, rng):
    if kind == "spaced":
        return " ".join(word)
    if kind == "repeated":
        k = rng.randrange(len(word))
        return word[:k] + word[k] * 4 + word[k + 1:]
    swap = {"o": "0", "i": "1", "e": "3", "a": "4", "s": "5", "t": "7"}
    at = [k for k, c in enumerate(word) if c in swap]
    for k in rng.sample(at, min(2, len(at))):
        word = word[:k] + swap[word[k]] + word[k + 1:]
    return word


def test_held_out_documents_as_written_and_obfuscated(spark, trained):
    rng = random.Random(8)
    truth = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    held = [r for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()
            if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and truth.get(r.doc_id) is not None]
    rows = []
    for r in held:
        rows.append((r.doc_id, "as written", r.text))
        for kind in ("spaced", "repeated", "lookalike"):
            rows.append((r.doc_id, kind, " ".join(
                obfuscated(w, kind, rng) if w.strip(".,!?").lower() in INSULTS and w.isalpha() else w for w in (r.text or "").split(" "))))
    docs = spark.createDataFrame(rows, "doc_id long, kind string, text string").repartition(8)
    found = toxicity.score(docs, trained).collect()
    insulting = {r.doc_id for r in held if any(w in (r.text or "").lower().split() for w in INSULTS)}
    for kind in ("as written", "spaced", "repeated", "lookalike"):
        own = {r.doc_id: r.predicted for r in found if r.kind == kind}
        clean = [d for d in own if truth[d] == 0]
        assert sum(own[d] for d in clean) / len(clean) < 0.01
        caught = sum(own[d] for d in insulting) / len(insulting)
        assert caught > (0.9 if kind in ("as written", "repeated") else 0.8), (kind, caught)


def test_contract(spark, data):
    found = queries.queries()["op11_toxicity"](spark, data)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == table(spark, data, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_teach_nothing(spark, data):
    docs, labels = table(spark, data, "documents").select("doc_id", "text"), table(spark, data, "labels")
    other = labels.withColumn("toxic", toxicity.F.when(toxicity.fold("doc_id", 5) == 0, 1 - toxicity.F.col("toxic"))
                              .otherwise(toxicity.F.col("toxic")))
    one, two = toxicity.train(docs, labels), toxicity.train(docs, other)
    assert (one[0] == two[0]).all() and (one[1][0] == two[1][0]).all() and (one[1][1] == two[1][1]).all()


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(12)] + [(3, 0, None), (None, 0, 1), (4, 0, 0), (4, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    found = toxicity.query(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    none = {r.score for r in found if r.doc_id in (0, 1, 2, 3)}
    assert len(none) == 1
    assert {r.score for r in toxicity.query(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.query(odd.limit(0), labels).collect() == []
    cost = toxicity.smoothed(np.zeros((64, 64, 64)))
    kept = toxicity.restore(odd, cost)
    assert kept.columns == odd.columns + ["restored"] and kept.count() == odd.count()


def test_near_copies_in_the_sample_count_once():
    rng = np.random.default_rng(0)
    words = [rng.integers(1, 1 << 60, 30).astype(np.uint64) for _ in range(200)]
    rare = np.array([7, 8, 9], np.uint64)
    words += [np.concatenate([rare, words[0][:20]])] * 40
    labels = np.array([0] * 200 + [1] * 40)
    names, _, _ = toxicity.fit(words, labels)
    assert not names.size                      # one text, copied forty times, is one text
