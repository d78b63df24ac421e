"""Merkle manifest against a plain tree over all rows."""

import collections
import hashlib
import zlib

import pytest

from devsignals.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes):
    """Root, and per leaf the siblings left and right of it and of the nodes above it."""
    paths, level, below = [[] for _ in nodes], list(nodes), [[k] for k in range(len(nodes))]
    while len(level) > 1:
        above, under = [], []
        for i in range(0, len(level), 3):
            run = level[i:i + 3]
            for j in range(len(run)):
                for leaf in below[i + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(h(*run))
            under.append(sum(below[i:i + 3], []))
        level, below = above, under
    return level[0], paths


def plain_manifest(rows):
    sources = collections.defaultdict(list)
    for r in rows:
        leaf = h(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        half = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        bare = r["text"].replace("\n", "") if half and r["text"] is not None else r["text"]
        other = h(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars")], field(bare))
        sources[r["source"]].append(((r["doc_id"] is not None, r["doc_id"] or 0), leaf, other, r["doc_id"]))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[1] for x in sorted(sources[s], key=lambda x: x[:2])]) for s in names}
    root, top = plain_tree([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for k, s in enumerate(names):
        for (_, leaf, other, doc_id), path in zip(sorted(sources[s], key=lambda x: x[:2]), trees[s][1]):
            whole, node = path + top[k], other
            for a, b in whole:
                node = h(a, node, b)
            out.append((doc_id, leaf, trees[s][0], root, h(*[a + b for a, b in whole]), node, node == root))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("height", [1, 2, manifest.HEIGHT])
def test_against_a_plain_tree(documents, height):
    found = manifest.query(documents, height).collect()
    assert in_order(found) == in_order(plain_manifest(documents.collect()))


def test_tampering_is_found_where_it_changed_a_text(documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in manifest.query(documents).collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (text[r.doc_id] or "")
        assert r.verified != changed


def test_odd_rows(odd):
    # any order of equal rows gives the same rows
    assert in_order(manifest.query(odd, 1).collect()) == in_order(plain_manifest(odd.collect()))
    assert manifest.query(odd.limit(0)).collect() == []
    (one,) = manifest.query(odd.where("doc_id = 4")).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == h()


def test_one_large_source_and_many_small_ones(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 700)) as source", "'en' as lang", "id % 9 as n_chars",
        "concat('text\n', id) as text")
    assert in_order(manifest.query(docs, 2).collect()) == in_order(plain_manifest(docs.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28])
def test_frontier_gives_the_plain_witnesses(n):
    leaves = [h(str(k)) for k in range(n)]
    frontier = manifest.Frontier()
    for leaf in leaves:
        frontier.append(leaf)
        assert all(len(nodes) < 3 for nodes in frontier.open)
    root, paths = plain_tree(leaves)
    assert frontier.close() == root
    assert [list(zip(a, b)) for a, b in zip(frontier.left, frontier.right)] == paths
