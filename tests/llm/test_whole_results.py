"""Whole results of operators without SQL against plain loops."""

import collections
import math
import random

import numpy as np
import pytest
import xxhash

from devsignals.llm import decontamination, pitman_yor, quality_crf


# quality: features, marginals and weighting, from a model that the operator has fitted

def plain_features(line):
    groups, rest, high = [0] * len(quality_crf.GROUPS), 0, 0
    for byte in line:
        kind = next((k for k, members in enumerate(quality_crf.GROUPS) if byte in members), None)
        if kind is not None:
            groups[kind] += 1
        elif byte >= 128:
            high += 1
        else:
            rest += 1
    words, n = line.split(), len(line)
    return ([g / max(n, 1) for g in groups] + [high / max(n, 1), math.log1p(n) / 8, math.log1p(len(words)) / 6,
            n / max(len(words), 1) / 20, len(set(words)) / max(len(words), 1), float(line[-1:] in (b".", b"!", b"?")), float(not words)])


def plain_quality(text, weights, transition):
    lines = (text or "").encode().split(b"\n")
    own = [plain_features(x) for x in lines]
    none = [0.0] * quality_crf.N_LINE
    emission = []
    for t in range(len(lines)):
        x = own[t] + (own[t - 1] if t else none) + (own[t + 1] if t + 1 < len(lines) else none)
        x += [float(t == 0), float(t == len(lines) - 1), 1.0]
        emission.append((0.0, sum(a * b for a, b in zip(x, weights))))
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    alpha, beta = [emission[0]], [(0.0, 0.0)]
    for e in emission[1:]:
        alpha.append(tuple(add(alpha[-1][0] + transition[0][y], alpha[-1][1] + transition[1][y]) + e[y] for y in (0, 1)))
    for e in reversed(emission[1:]):
        beta.append(tuple(add(transition[y][0] + e[0] + beta[-1][0], transition[y][1] + e[1] + beta[-1][1]) for y in (0, 1)))
    beta.reverse()
    good = [1 / (1 + math.exp((a[0] + b[0]) - (a[1] + b[1]))) for a, b in zip(alpha, beta)]
    length = [max(len(x), 1) for x in lines]
    return sum(g * n for g, n in zip(good, length)) / sum(length)


def test_quality_against_plain_loops(spark, documents, texts, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    weights, transition = quality_crf.train(documents.select("doc_id", "text"), labels)
    found = {r.doc_id: r for r in quality_crf.query(documents, labels).collect()}
    assert set(found) == set(texts)
    for d, t in texts.items():
        if t is None or len(t) < 30_000:
            assert found[d].score == pytest.approx(plain_quality(t, weights, transition), abs=1e-6)
            assert found[d].predicted == (found[d].score >= 0.5)


def test_quality_sample_is_bounded(spark):
    """One labelled id in many rows, and a text of line ends."""
    docs = spark.createDataFrame([(1, f"text number {k}.") for k in range(3000)] + [(2, "\n" * 100_000), (3, "fine text.\nand more.")],
                                 "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    seen, real = [], quality_crf.fit

    def spy(features, starts, y, *rest):
        seen.append((len(y), len(features)))
        return real(features, starts, y, *rest)

    quality_crf.fit = spy
    try:
        quality_crf.train(docs, labels, parts=10 ** 9, held_out=-1, max_train_docs=10)
    finally:
        quality_crf.fit = real
    assert seen == [(2, 3)]


# language model: counting, seating and prediction customer by customer

MASK = (1 << 64) - 1


def plain_mixed(x):
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_pitman_yor(docs, buckets=16):
    """docs: (id, words, held_out). Scores by id. Every word is a context; a pair's seed comes from its words' places in their
    hash buckets, as in the operator."""
    end = "\n"
    training = [ws + [end] for _, ws, held in docs if not held]
    counts = collections.Counter(w for ws in training for w in ws)
    n = collections.Counter((u, w) for ws in training for u, w in zip([end] + ws, ws))
    hashes = sorted({xxhash.xxh64_intdigest(w.encode()) for _, ws, _ in docs for w in ws + [end]})
    bucket_of = lambda h: (h >> 32) * buckets >> 32
    slots = collections.Counter()
    place = {}
    for h in hashes:
        place[h] = bucket_of(h) << 32 | slots[bucket_of(h)]
        slots[bucket_of(h)] += 1
    number = lambda w: place[xxhash.xxh64_intdigest(w.encode())]
    strength = pitman_yor.STRENGTH
    seeds = {(u, w): plain_mixed(plain_mixed(number(u)) ^ number(w)) for u, w in n}
    discount = pitman_yor.discount_of(sum(c == 1 for c in n.values()), sum(c == 2 for c in n.values()))
    tables, states = dict.fromkeys(n, 1), []
    for sweep in range(pitman_yor.SWEEPS + 1):
        if sweep:
            last = states[-1]
            for (u, w), c in n.items():
                parent = (last["words"][w] - last["parent_discount"]) / (strength + last["all"])
                weight = (strength + discount * last["contexts"][u]) * parent
                state, t = (seeds[u, w] + (sweep << 32)) & MASK, 1
                for seated in range(1, c):
                    state = plain_mixed(state)
                    t += (state >> 11) / float(1 << 53) < weight / (seated - discount * t + weight)
                tables[u, w] = t
        of_word, of_context = collections.Counter(), collections.Counter()
        for (u, w), t in tables.items():
            of_word[w] += t
            of_context[u] += t
        states.append({"contexts": of_context, "words": of_word, "all": sum(of_context.values()), "own": dict(tables),
                       "parent_discount": pitman_yor.discount_of(sum(t == 1 for t in of_word.values()), sum(t == 2 for t in of_word.values()))})

    def p(u, w):
        values = []
        for s in states[1 + pitman_yor.BURN_IN:]:
            parent = (s["words"][w] - s["parent_discount"]) if w in counts else strength + s["parent_discount"] * len(counts)
            parent /= strength + s["all"]
            own = n[u, w] - discount * s["own"].get((u, w), 0)
            values.append((own + (strength + discount * s["contexts"][u]) * parent) / (strength + counts[u]))
        return sum(values) / len(values)

    every = [*counts, None]
    for u in [*counts, "never seen"]:                # known words and the unknown symbol add up to one
        assert sum(p(u, w) for w in every) == pytest.approx(1)
    return {d: sum(math.log10(p(u, w)) for u, w in zip([end] + ws, ws + [end])) for d, ws, _ in docs}


@pytest.mark.parametrize("chunk_tokens", [1 << 21, 60])
def test_language_model_against_a_plain_sampler(spark, chunk_tokens):
    """Also where documents of one table lie in several chunks, which hold many pairs in common."""
    rng = random.Random(11)
    names = [f"w{k}" for k in range(30)]
    docs = [(d, rng.choices(names, weights=[1 / (k + 1) for k in range(30)], k=rng.randint(0, 25)), d % 5 == 0) for d in range(60)]
    docs += [(100, ["never", "seen", "w0"], True), (101, [], False), (102, ["w0"] * 12, False)]
    frame = spark.createDataFrame([(d, " ".join(ws), held) for d, ws, held in docs], "doc_id long, text string, held_out boolean").coalesce(3)
    found = {r.doc_id: r for r in pitman_yor.score(frame, chunk_tokens).collect()}
    made = pitman_yor.make_chunks(frame, chunk_tokens).count()
    want = plain_pitman_yor(docs, max(16, made))
    assert set(found) == set(want) and (made > 5) == (chunk_tokens == 60)
    for d in want:
        assert found[d].score == pytest.approx(want[d], abs=1e-6), d


# contamination: every document against every item, window by window

def plain_leaks(docs, items):
    width_of = decontamination.WINDOW
    found = set()

    def windows(words, width):
        tokens = [decontamination.token_of(w) for w in words]
        out = []
        for k in range(len(words) - width + 1):
            part = tokens[k:k + width]
            slots = [(j, bare) for j, (token, bare) in enumerate(part) if token[:1] == "<" and token != bare]
            template = tuple(t for t, _ in part) if width - len(slots) >= 2 else None
            out.append((template, tuple(b.casefold() for _, b in part), slots))
        return out

    texts = {d: (t or "").split() for d, t in docs}
    places = {width: collections.defaultdict(list) for width in (3, 4, 5)}
    for width, table in places.items():
        for d, words in texts.items():
            for k, (template, bare, slots) in enumerate(windows(words, width)):
                table[("bare", bare)].append((d, k, None))
                if template:
                    table[("template", template)].append((d, k, slots))

    def agree(pairs):
        return len({i for i, _ in pairs}) == len(pairs) == len({j for _, j in pairs})

    for item, text in items:
        words = (text or "").split()
        if len(words) < decontamination.MIN_ITEM_WORDS:
            continue
        width = min(width_of, len(words))
        own = windows(words, width)
        shifts = collections.defaultdict(lambda: collections.defaultdict(lambda: (set(), set())))
        for at, (template, bare, slots) in enumerate(own):
            for d, k, _ in places[width][("bare", bare)]:
                hit, pairs = shifts[d][k - at]
                hit.add(at)
                pairs.update((v, v) for _, v in slots)
            for d, k, theirs in places[width][("template", template)] if template else []:
                if [j for j, _ in slots] == [j for j, _ in theirs]:
                    hit, pairs = shifts[d][k - at]
                    hit.add(at)
                    pairs.update((a, b) for (_, a), (_, b) in zip(slots, theirs))
        for d, by_shift in shifts.items():
            straight = max((len(hit) for hit, pairs in by_shift.values() if agree(pairs)), default=0)
            every = set().union(*[hit for hit, _ in by_shift.values()])
            whole = len(every) if agree(set().union(*[pairs for _, pairs in by_shift.values()])) else 0
            if max(straight, whole) / len(own) >= decontamination.THRESHOLD:
                found.add((d, item, round(max(straight, whole) / len(own), 9)))
    return found


def test_leaks_against_every_window(spark, data, documents, texts):
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    want = plain_leaks(texts.items(), [(r.item_id, r.text) for r in items.collect()])
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontamination.query(documents, items).collect()}
    assert want and got == want


def test_leaks_of_reparameterised_items_against_every_window(spark):
    rng = random.Random(9)
    names, units, verbs = ["Anna", "Bert", "Carla", "Dora"], ["km", "kg", "hours"], ["runs", "carries", "needs", "walks"]
    form = lambda: (f"{rng.choice(names)} {rng.choice(verbs)} {rng.randint(1, 99)} {rng.choice(units)} and then {rng.choice(names)} "  # noqa: E731
                    f"{rng.choice(verbs)} {rng.randint(1, 99)} {rng.choice(units)} more before the day ends")
    items = [(k, form()) for k in range(25)] + [(100, "two words"), (101, None), (102, "a b c")]
    docs = [(k, "some words first " + form() + rng.choice([" and last", ""])) for k in range(60)] + [(k, form().upper()) for k in range(60, 80)]
    docs += [(200, items[0][1].upper()), (201, None), (202, ""), (203, "so a b c")]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontamination.query(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    want = plain_leaks(docs, items)
    assert len(want) > 20 and got == want
