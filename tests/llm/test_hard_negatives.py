"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest

from devsignals.llm import hard_negatives as hn


def plain(rows):
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        kept[(vec_id, label, tuple(max(-hn.LIMIT, min(hn.LIMIT, math.floor(256 * x))) for x in vector))] = True
    out = []
    for a, label, v in kept:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in kept if i != a)
        for score, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [(-s, i) for s, i, other in scored if other != label and 50 * -score <= 100 * -s <= 95 * -score]
            out += [(a, p, rank, i, -score, s) for rank, (s, i) in enumerate(inside[:3], 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_against_all_pairs_in_the_given_table(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    want = plain([tuple(r) for r in table.select("vec_id", "embedding", "label").collect()])
    assert want and sorted(map(tuple, hn.query(table).collect())) == want
    # small blocks and chunks, so that results of many cells are merged
    assert sorted(map(tuple, hn.mine(table, 16, 2).collect())) == want


def test_ties_and_one_very_common_vector(spark):
    rng = np.random.default_rng(4)
    common = rng.normal(size=6)
    rows = [(i, (common if i % 3 == 0 else np.round(rng.normal(size=6), 1)).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    table = spark.createDataFrame(rows, SCHEMA)
    want = plain([tuple(r) for r in table.collect()])
    assert want and sorted(map(tuple, hn.mine(table, 64, 4).collect())) == want


def test_odd_rows(spark):
    big = 3e38
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.1], 2), (3, None, 2), (4, [1.0, None], 2), (5, [float("nan"), 1.0], 2),
            (6, [float("inf"), 1.0], 2), (8, [0.7, 0.7], None), (None, [0.7, 0.7], 2), (9, [], 2), (10, [0.8], 3), (11, [0.8, 0.1, 9.0], 3),
            (2, [0.9, 0.1], 2), (50, [0.0, 0.0], 1), (100, [-1.0, -1.0], 1), (12, [big, -big], 4), (13, [0.7, 0.3], 5), (14, [0.7, 0.3], 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    want = plain([tuple(r) for r in table.collect()])
    clashing = table.selectExpr("*", "1 as id", "'x' as anchor_id", "2 as block", "0 as rank")
    assert want and sorted(map(tuple, hn.query(clashing).collect())) == want
    assert hn.query(table.limit(0)).collect() == []
    assert hn.query(table.where("vec_id % 50 <> 0")).collect() == []
    assert hn.query(table.where("vec_id = 0")).collect() == []


def test_the_scan_drops_rows_without_changing_results():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-60, 60, size=(500, 48)) * (np.arange(48) < 6) + rng.integers(-2, 3, size=(500, 48))
    block = hn.Block(np.arange(500), np.zeros(500, np.int64), list(vectors))
    anchor, seen = vectors[0].astype(np.int64), []

    def shrink(rows, least, most):
        assert (least <= most).all()
        exact = vectors[rows] @ anchor
        assert (least <= exact).all() and (exact <= most).all()
        keep = most >= hn.kth_largest(least, 5)
        seen.append(int(keep.sum()))
        return keep

    rows, scores = block.scan(anchor, np.ones(500, bool), shrink)
    best = np.sort(vectors @ anchor)[::-1][:5]
    assert (np.sort(scores)[::-1][:5] == best).all() and seen[0] < 100


@pytest.mark.parametrize("score", [-7, 0, 1, 10, 19, 20, 101])
def test_windows_are_whole_numbers(score):
    block = hn.Block(np.arange(300), np.ones(300, np.int64), [[x - 100] for x in range(300)])
    ((_, ids, found),) = hn.negatives_of(block, 999, 0, np.array([1]), np.array([score]), 500)
    want = [x for x in range(199, -101, -1) if 50 * score <= 100 * x <= 95 * score]
    assert found.tolist() == want and ids.tolist() == [x + 100 for x in want]
