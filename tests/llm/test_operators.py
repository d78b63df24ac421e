"""Operators against plain versions, and on odd input."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from devsignals.llm import (decontamination, fixity, graph, language_id, licenses, line_rules, pitman_yor, quality_crf,
                            queries, sentence_pieces, simhash, site_lines)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fold(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# language

def test_language_held_out(spark, data, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    found = rows(language_id.query(documents))
    assert len(found) == len(truth)
    held = [d for d in truth if found[d].held_out]
    assert all(found[d].held_out == (fold(d, 5) == 0) for d in truth)
    assert sum(found[d].lang_pred == truth[d] for d in held) / len(held) > 0.97


def test_language_scores_match_a_plain_version(spark, documents):
    docs = documents.limit(40)
    model = language_id.train(docs, F.lit(True))
    letters = language_id.letter_table()

    def bucket(chars):
        h = 0
        for k, c in enumerate(chars):
            h = ((h + ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
            h ^= h >> 15
        return ((h * 0x85EBCA6B) & 0xFFFFFFFF) >> 16

    texts = ["Der, die 7 das!", "a", "über"]
    grams, _ = language_id.ngram_buckets([t.encode() for t in texts], letters)
    for k, t in enumerate(texts):
        spread = " " + re.sub(r"[\W\d_]+", " ", t.lower()).strip() + " "
        for n, (h, starts) in zip((1, 2, 3), grams):
            want = sorted(bucket(spread[i:i + n]) for i in range(len(spread) - n + 1) if n > 1 or spread[i] != " ")
            assert sorted(x for x in h[starts[k]:starts[k + 1]].tolist() if x < language_id.BUCKETS) == want
    assert np.allclose(np.exp(model.log_prob).sum(axis=1), 1)


def test_language_odd(odd, spark):
    found = language_id.query(odd).collect()
    assert len(found) == odd.count()
    none = [r for r in found if r.doc_id in (0, 1, 2, 3, 10)]
    assert none and all(r.lang_pred == "und" and r.score == 0 for r in none)
    assert all(0 <= r.score <= 1 for r in found)
    kept = language_id.keep_identified(odd)
    assert kept.columns == odd.columns and 0 < kept.count() < odd.count()
    assert language_id.query(odd.limit(0)).collect() == []
    assert {r.lang_pred for r in language_id.query(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# quality

def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    emission, move = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))
    starts = np.array([0, 1, 5, 7])
    marginal, pairs, _ = quality_crf.forward_backward(emission, move, starts)
    total_pairs = np.zeros((2, 2))
    for a, b in zip(starts[:-1], starts[1:]):
        weights, seen, pair = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for path in np.ndindex(*[2] * (b - a)):
            w = math.exp(sum(emission[a + t, y] for t, y in enumerate(path)) + sum(move[x, y] for x, y in zip(path, path[1:])))
            weights += w
            for t, y in enumerate(path):
                seen[t, y] += w
            for x, y in zip(path, path[1:]):
                pair[x, y] += w
        assert np.allclose(marginal[a:b], seen / weights)
        total_pairs += pair / weights
    assert np.allclose(pairs, total_pairs)


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = rows(queries.queries()["op2_quality_crf"](spark, folder))
    assert all(r.held_out == (fold(d, 3) == 1) and r.predicted == (r.score >= 0.5) for d, r in found.items())
    held = [d for d in truth if found[d].held_out]
    assert sum(found[d].predicted == truth[d] for d in held) / len(held) > 0.93


def test_quality_odd(odd, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(3, None, None), (None, 1, 0), (4, 0, 0), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    found = quality_crf.query(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality_crf.query(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_crf.query(odd.limit(0), labels).collect() == []


# lines

def test_line_rules_against_a_plain_version(spark, documents):
    found = rows(line_rules.query(documents))
    table = documents.collect()
    hosts, norm = collections.defaultdict(dict), {}
    for r in table:
        lines = [x for x in (r.text or "").encode().split(b"\n") if x.split()]
        norm[r.doc_id] = [(re.sub(rb"[0-9]+", b"0", b" ".join(x.lower().split())), len(x)) for x in lines]
        hosts[r.source][frozenset(k for k, _ in norm[r.doc_id])] = True
    counts = {h: collections.Counter(x for own in sets for x in own) for h, sets in hosts.items()}
    for r in table:
        words = WORD.findall(r.text or "")
        grams = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        again = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        most = 20
        whole = sum(n for _, n in norm[r.doc_id])
        left = 1 - sum(n for k, n in norm[r.doc_id] if counts[r.source][k] > most) / whole if whole else 1.0
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        got = found[r.doc_id]
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words, got.base_failed, got.kept) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in r.text or ""), len(lines) - len(set(lines)),
            len(again), failed, not failed and left >= line_rules.MIN_LEFT)


def crowded(spark):
    """60 documents of a host share a line; one document has nothing else, copies of one text are not boilerplate."""
    shared = "Accept   all COOKIES 12"
    rng = random.Random(8)
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(12))
    own = [(i, "\n".join([shared] + [line() for _ in range(5)])) for i in range(60)]
    copied = "\n".join(line() for _ in range(6))
    copies = [(100 + i, copied) for i in range(60)]
    rows_ = own + [(90, "\n".join([shared] * 30 + ["few own words here"]))] + copies
    return spark.createDataFrame([(i, t, "h") for i, t in rows_], "doc_id long, text string, source string"), shared


def test_line_rules_remove_and_reject(spark):
    docs, shared = crowded(spark)
    decided = rows(line_rules.judge(docs))
    assert not decided[90].kept and not decided[90].removed == []
    assert decided[3].left_share < 1 and decided[3].kept
    assert decided[120].left_share == 1
    stripped = rows(line_rules.strip_lines(docs))
    assert shared not in stripped[3].text and stripped[3].text == rows(docs)[3].text.split("\n", 1)[1] and stripped[120].text == rows(docs)[120].text


def test_line_rules_limit_does_not_grow_with_the_host(spark):
    """21 of 1,000 documents share a line: above the limit of 20, though within 5 % of the host."""
    text = lambda i: ("shared by some\n" if i < 21 else "shared by fewer\n" if i < 41 else "") + f"own {chr(97 + i % 26) * (i // 26 + 1)}"
    docs = spark.createDataFrame([(i, text(i), "h") for i in range(1000)], "doc_id long, text string, source string")
    stripped = rows(line_rules.strip_lines(docs))
    assert "shared by some" not in stripped[0].text and stripped[30].text == text(30)
    found = rows(line_rules.judge(docs))
    assert found[0].left_share < 1 and found[30].left_share == 1


def test_line_rules_odd(odd):
    found = line_rules.query(odd).collect()
    assert len(found) == odd.count()
    assert all(r.base_failed and not r.kept for r in found if r.doc_id in (0, 1, 2, 3, 4))
    assert line_rules.query(odd.limit(0)).collect() == []
    stripped = line_rules.strip_lines(odd)
    assert stripped.columns == odd.columns and stripped.exceptAll(odd).count() == 0


def test_site_lines(spark, odd):
    docs, shared = crowded(spark)
    out = rows(site_lines.drop_boilerplate(docs))
    assert shared not in out[3].text and out[3].lines_dropped == 1 and out[90].text == "few own words here"
    kept = site_lines.without_boilerplate(odd)
    assert kept.columns == odd.columns
    assert kept.exceptAll(odd).count() == 0 and odd.exceptAll(kept).count() == 0
    assert site_lines.without_boilerplate(odd.limit(0)).collect() == []
    five = spark.createDataFrame([(i, "same line\n" + f"own {i}", None) for i in range(5)], "doc_id long, text string, source string")
    assert sorted(r.text for r in site_lines.drop_boilerplate(five).collect()) == [f"own {i}" for i in range(5)]
    assert site_lines.drop_boilerplate(five.where("doc_id < 4")).where("lines_dropped > 0").count() == 0


def test_site_lines_copies_keep_their_text(spark):
    """A group of copies above the share keeps its lines in the stage; boilerplate on distinct pages goes."""
    texts = [f"Menu\nown line {i}" for i in range(12)] + ["Menu\nthe text\nof all copies"] * 6
    docs = spark.createDataFrame([(i, t, "en", "h", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert {d: r.text for d, r in rows(site_lines.without_boilerplate(docs)).items()} == {
        i: t.split("\n", 1)[1] for i, t in enumerate(texts)}


# near-duplicates

def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Smallest id reachable, for (id, fingerprint) pairs."""
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                parent[top(a)] = top(b)
    least = {}
    for d, v in prints.items():
        least[top(v)] = min(d, least.get(top(v), d))
    return {d: least[top(v)] for d, v in prints.items()}


def test_simhash_against_all_pairs(spark, documents, texts):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    found = rows(simhash.query(documents))
    want = plain_components(prints)
    assert {d: (r.fingerprint, r.component_id) for d, r in found.items()} == {
        d: (f"{prints[d]:016x}", want[d]) for d in prints}


def test_more_blocks_for_more_fingerprints():
    assert [simhash.blocks_for(10 ** k) for k in (0, 6, 9, 11, 13)] == [6, 6, 6, 8, 9]


@pytest.mark.parametrize("limit, blocks", [(4096, None), (16, None), (16, 5), (4096, 8)])
def test_shards_lose_no_link(spark, limit, blocks):
    """Chains and dense groups of fingerprints; a low limit cuts the shards into several trees."""
    rng = random.Random(5)
    prints = {}
    for group in range(12):
        value = rng.getrandbits(64)
        for _ in range(25):
            prints[len(prints)] = value
            for _ in range(rng.randint(1, 6)):
                value ^= 1 << rng.randrange(64)
    signed = {v - (1 << 64) if v >= 1 << 63 else v for v in prints.values()}
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = graph.components(simhash.shard_links(df, blocks=blocks, limit=limit))
    part = {r.node & (1 << 64) - 1: r.component for r in links.collect()}
    want = plain_components(prints)
    groups = collections.defaultdict(set)
    for d, v in prints.items():
        groups[want[d]].add(part.get(v, ("alone", v)))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7), (500, 501), (501, 500)]
    found = rows(graph.components(spark.createDataFrame(edges, "a long, b long")), "node")
    assert {n: r.component for n, r in found.items()} == {n: 0 for n in range(41)} | {100: 100, 200: 100, 300: 100, 500: 500, 501: 500}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_simhash_odd(odd):
    found = simhash.query(odd).collect()
    assert len(found) == odd.count()
    assert {r.component_id for r in found if r.doc_id in (0, 1, 2, 3)} == {0}
    assert simhash.query(odd.limit(0)).collect() == []
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 4, 5, 6, 7, 8, 9, 10, 11]


# contamination

def test_leaks_whole_and_reparameterised(spark):
    items = spark.createDataFrame([
        (1, "Anna has 12 apples and gives 5 apples to Bert before lunch, how many apples does Anna have now"),
        (2, "water boils at one hundred degrees when the pressure is that of the sea"), (3, "two words"), (4, None), (5, ""),
        (6, "tiny little item")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "intro text Anna has 12 apples and gives 5 apples to Bert before lunch, how many apples does Anna have now end"),
        (2, "Carla has 30 apples and gives 7 apples to Doris before lunch, how many apples does Carla have now"),
        (3, "Carla has 30 apples and gives 7 apples to Doris before lunch, how many apples does Emil have now"),
        (4, "WATER boils at one hundred degrees when the pressure is that of the sea."),
        (5, "water boils at one hundred and nothing more is said about the sea"), (6, None), (7, ""), (8, "a tiny little item here"),
        (9, "so water boils at one hundred degrees when really the pressure is that of the sea"), (4, "two words"),
        (None, "water boils at one hundred degrees when the pressure is that of the sea")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.reparameterised for r in decontamination.query(docs, items).collect()}
    assert found[(1, 1)] is False and found[(2, 1)] is True and (3, 1) not in found
    assert (5, 2) not in found and (4, 2) in found and (None, 2) in found and (8, 6) in found
    assert not [k for k in found if k[1] in (3, 4, 5)]
    kept = decontamination.without_leaks(docs, items)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [3, 4, 5, 6, 7, 9]


def test_leaks_against_exact_containment(spark, data, documents, texts):
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontamination.query(documents, items).collect()}
    flat = {d: " ".join((t or "").split()) for d, t in texts.items()}
    exact = {(d, r.item_id) for r in items.collect() for d, t in flat.items() if " ".join(r.text.split()) in t}
    assert exact and exact <= found
    assert len(found - exact) <= 0.2 * len(exact)


def test_leaks_in_other_case(spark, data):
    """Upper-cased and lower-cased copies of every item are found, with every item that brute force finds in them."""
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    all_items = {r.item_id: r.text.split() for r in items.collect() if len((r.text or "").split()) >= decontamination.MIN_ITEM_WORDS}
    docs, want = [], set()
    for k, (item, own) in enumerate(sorted(all_items.items())):
        for n, change in enumerate((str.upper, str.lower)):
            docs.append((2 * k + n, "before it " + change(" ".join(own)) + " after it"))
    for d, text in docs:
        flat = f" {text.casefold()} "
        want |= {(d, item) for item, own in all_items.items() if f" {' '.join(own).casefold()} " in flat}
    assert len(want) >= len(docs)
    found = decontamination.query(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert want <= {(r.doc_id, r.item_id) for r in found if r.similarity == 1.0}


def test_leaks_odd(odd, spark):
    items = spark.createDataFrame([(1, "One two three four five six.")], "item_id long, text string")
    assert {r.doc_id for r in decontamination.query(odd, items).collect()} == {5}
    kept = decontamination.without_leaks(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert decontamination.query(odd, items.limit(0)).collect() == []
    assert decontamination.query(odd.limit(0), items).collect() == []


# tokens

def test_pieces_like_the_library(spark, documents, odd):
    path = queries.piece_model()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for docs in (documents, odd):
        got = sentence_pieces.query(docs, path).collect()
        want = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = model.encode(r.text or "")
            want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(model.decode(ids).encode()).hexdigest())] += 1
        assert collections.Counter(map(tuple, got)) == want
    assert sentence_pieces.query(odd.limit(0), path).collect() == []
    coded = sentence_pieces.with_tokens(odd, path)
    again = sentence_pieces.decode(coded, path)
    assert coded.count() == odd.count() and again.select("decoded").exceptAll(coded.select("decoded")).count() == 0


def test_pieces_on_random_texts():
    path = queries.piece_model()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    merger = sentence_pieces.Merger(sentence_pieces.read_vocabulary(path))
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "\r", "é", "▁", "the", "ing", "\x00", "😀", "中", "<0x0A>", "<s>", "aaaa", "!!!!", "=", "　", "();"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(1500)] + ["a" * 4000, " " * 2000, "ab" * 2000]
    ids, starts = merger.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == model.encode(texts)
    table = sentence_pieces.piece_table(merger.v)
    rnd = [[rng.randrange(400) if rng.random() < .5 else rng.randrange(32000) for _ in range(rng.randint(0, 9))] for _ in range(1500)]
    flat, ends = np.array([i for r in rnd for i in r]), np.cumsum([0] + [len(r) for r in rnd])
    assert sentence_pieces.decode_flat(merger.v, flat, ends, table) == [model.decode(r) for r in rnd]


# archives

def test_fixity_finds_what_was_damaged(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html")
    records = fixity.warc_records(pages, pages_per_file=20)
    assert fixity.audit(records, records).collect() == []
    bad = (records.where("page_id <> 3").withColumn("digest", F.when(F.col("page_id") == 7, "x").otherwise(F.col("digest")))
           .union(records.where("page_id = 9").withColumn("offset", F.col("offset") + 10**9)))
    assert {(r.page_id, r.damage) for r in fixity.audit(records, bad).collect()} == {(3, "missing"), (7, "changed"), (9, "extra")}
    whole_file = records.where("file <> 0")
    lost = fixity.audit(records, whole_file)
    assert lost.count() == records.where("file = 0").count() and {r.damage for r in lost.collect()} == {"missing"}


def test_fixity_odd(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", ""), (2, None, "x"), (2, None, "x"), (None, None, None),
                                   (3, "u", "y" * 300_000)], "page_id long, url string, html string")
    records = fixity.warc_records(pages)
    assert records.count() == 5 and records.where("copies = 2").count() == 1
    assert fixity.audit(records, records).collect() == []
    assert fixity.audit(records, records.limit(0)).count() == 5
    assert fixity.query(pages.limit(0)).collect() == []


# language model

def test_pitman_yor_counts_and_base(spark, documents, texts):
    tokens = {d: WORD.findall(lower(t or "")) + ["\n"] for d, t in texts.items()}
    counts = collections.Counter(w for d, ws in tokens.items() if fold(d, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    found = rows(pitman_yor.query(documents))
    assert len(found) == len(texts)
    for d, ws in tokens.items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(d, 7) == 2, len(ws), sum(w in counts for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), abs=1e-6)
        assert r.score < 0


def test_pitman_yor_better_than_base_on_held_out(spark, documents):
    n, base, own = pitman_yor.query(documents).where("held_out").agg(
        F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()
    assert own / n > base / n


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for v in (np.zeros(0), np.zeros(5), rng.integers(0, 300, 1000), rng.integers(0, 1 << 62, 50)):
        assert (pitman_yor.unpacked(pitman_yor.packed(v)) == v.astype(np.uint64)).all()
        assert (pitman_yor.risen(pitman_yor.rising(np.sort(v))) == np.sort(v).astype(np.uint64)).all()
    keys = np.sort(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    runs = list(pitman_yor.bucketed(keys, 64, 37))
    assert [i for _, i, _ in runs][1:] == [j for _, _, j in runs][:-1] and runs[-1][2] == 5000 and {b for b, _, _ in runs} <= set(range(37))


def test_pitman_yor_counts_pairs_over_all_chunks(spark, texts):
    rows_ = [(d, t or "", fold(d, 7) == 2) for d, t in texts.items() if len(t or "") < 5000]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, held_out boolean")
    model = pitman_yor.learned(docs.repartition(3), 0, 3000)
    want, words = collections.Counter(), collections.Counter()
    for _, t, held in rows_:
        own = t.encode().lower().split() + [pitman_yor.END]
        if not held:
            words.update(own)
            want.update(zip([pitman_yor.END] + own, own))
    assert (model["tokens"], model["words"]) == (sum(words.values()), len(words))
    held = [pitman_yor.Pairs(pitman_yor.pa.Table.from_pylist([r.asDict()])) for r in model["pairs"].collect()]
    assert len(held) > 3
    owned = sorted(n for own in held for n in own.n[own.own].tolist())
    assert owned == sorted(want.values())
    assert model["scales"][0][2] == len(want)                # a table for each pair


def test_seats():
    rng = np.random.default_rng(1)
    customers = np.full(4000, 30)
    tables = pitman_yor.seat(customers, np.full(4000, 2.0), 0.0, rng.integers(0, 1 << 62, 4000))
    assert tables.mean() == pytest.approx(1 + sum(2.0 / (2.0 + k) for k in range(1, 30)), rel=0.03)
    big = pitman_yor.seat(np.array([1, 2, 5000, 10**7]), np.array([1., 1., 3., 3.]), 0.3, np.arange(4))
    assert big[0] == 1 and (big <= [1, 2, 5000, 10**7]).all() and big[3] > big[2] / 2


def test_pitman_yor_odd(odd):
    found = pitman_yor.query(odd).collect()
    assert len(found) == odd.count()
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (0, 1, 2, 3))
    assert pitman_yor.query(odd.limit(0)).collect() == []
    # without training rows every word is the unknown symbol, of probability one
    alone = pitman_yor.score(odd.select("doc_id", "text", F.lit(True).alias("held_out"))).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and abs(r.score) < 1e-9 for r in alone)


# licences

def test_licences_odd(odd):
    found = licenses.query(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found}
    assert (by[7].n_base, by[7].first_word, by[7].labels) == (1, 3, "mit") and by[0].n_words == 0 and by[0].first_word is None
    assert licenses.query(odd.limit(0)).collect() == []


def plain_matches(text):
    own, found = licenses.words_of(text or ""), set()
    for label, t in licenses.TEMPLATES:
        members = set(licenses.words_of(t))
        size, step = licenses.block_size(len(licenses.words_of(t)))
        for start in range(0, len(own), step):
            n = len(set(own[start:start + size]) & members)
            if n >= 0.8 * len(members) - 1e-9:
                found.add((start, label, round(n / len(members), 9)))
    return found


def test_licence_join_against_all_blocks(spark):
    rng = random.Random(4)
    vocabulary = [w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)] + ["other", "thing"]
    texts = []
    for _ in range(80):
        own = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            words = licenses.words_of(rng.choice(licenses.TEMPLATES)[1])
            kept = [w for w in words if rng.random() < 0.9]
            own += kept + rng.choices(vocabulary, k=rng.randint(0, 9))
        texts.append("\n".join(" ".join(own[i:i + 9]) for i in range(0, len(own), 9)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: {(m.start, m.label, round(m.containment, 9)) for m in r.matches} for r in licenses.scan(docs).collect()}
    assert found == {i: plain_matches(t) for i, t in enumerate(texts)} and sum(map(len, found.values())) > 100


def wrapped(text, width=60):
    import textwrap

    return "\n".join(" * " + x for x in textwrap.wrap(text, width))


def test_wrapped_licences_are_found_and_long_texts_left_alone(spark):
    full = {label: t for label, t in licenses.TEMPLATES if len(t) > 150}
    rows_ = [(k, "/*\n" + wrapped(t) + "\n */\nint main() { return 0; }") for k, t in enumerate(full.values())]
    clean = "all things come to those whose rights are dear and who wait until the seats are reserved " * 60
    rows_ += [(100, clean), (101, "some words. All rights reserved. more words " * 3), (102, clean.replace(" ", "\n"))]
    found = {r.doc_id: r.labels for r in licenses.query(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    for k, label in enumerate(full):
        assert label in found[k].split(","), (label, found[k])
    assert found[100] == found[102] == "" and found[101] == "all-rights-reserved"


def test_licence_plan_is_native(spark, documents):
    plan = licenses.query(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|Cartesian|NestedLoop", plan)


def test_leaks_of_items_that_share_most_windows(spark):
    """Items of one form that differ in their last words: each is found where it stands, and only there."""
    shared = "the same long question is asked once more in every item of this whole test "
    ends = [f"{a} {b} {c}" for a, b, c in zip("red blue green brown white".split(), "fox dog cat cow hen".split(), "runs sits eats naps sees".split())]
    items = spark.createDataFrame([(k, shared + e) for k, e in enumerate(ends)], "item_id long, text string")
    docs = spark.createDataFrame([(k, "so " + shared + e + " then") for k, e in enumerate(ends)] + [(9, shared)] * 40, "doc_id long, text string")
    before = decontamination.leaks(docs, items, 0.95)
    assert sorted((r.doc_id, r.item_id) for r in before.collect()) == [(k, k) for k in range(5)]
    loose = {(r.doc_id, r.item_id) for r in decontamination.query(docs, items).collect()}
    words = [(shared + e).split() for e in ends]
    grams = [{" ".join(w[i:i + 5]) for i in range(len(w) - 4)} for w in words]
    texts = {k: ("so " + shared + e + " then").split() for k, e in enumerate(ends)} | {9: shared.split()}
    want = {(d, k) for d, w in texts.items() for k, g in enumerate(grams)
            if len(g & {" ".join(w[i:i + 5]) for i in range(len(w) - 4)}) >= 0.8 * len(g)}
    assert loose == want


def test_damage_changes_a_byte_of_the_record(spark):
    pages = spark.createDataFrame([(7, "u", "a page"), (108, "u", "#page"), (209, "u", ""), (310, None, None), (8, "u", "x")],
                                  "page_id long, url string, html string")
    found = {r.page_id: r for r in fixity.warc_records(pages).collect()}
    for page_id, url, html in [(7, "u", "a page"), (108, "u", "#page"), (209, "u", ""), (310, "", None)]:
        body = (html or "").encode()
        head = (f"WARC/1.1\r\nWARC-Type: {'metadata' if html is None else 'response'}\r\nWARC-Target-URI: {url}\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode()
        record = head + body + b"\r\n\r\n"
        at = len(head) if body else 0
        worn = record[:at] + (b"%" if record[at:at + 1] == b"#" else b"#") + record[at + 1:]
        assert found[page_id].digest == hashlib.sha256(record).hexdigest() and found[page_id].worn == hashlib.sha256(worn).hexdigest()
    assert found[8].worn is None


def test_broadcasts_need_no_package(spark, data, monkeypatch):
    """What travels to workers can be read where this package is not installed."""
    import pickle

    from pyspark import SparkContext

    seen, send = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: seen.append(pickle.dumps(value)) or send(self, value))
    for name in ("op2_quality_crf", "op3_sentencepiece", "op4_language_id", "op8_decontamination", "op11_toxicity"):
        queries.queries()[name](spark, data).count()
        assert seen and not any(b"devsignals" in x for x in seen), name
        seen.clear()
