"""Operator 10 against plain Python."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from helpers import CLASHING, edge_docs, empty_docs, sf_docs, words
from tidelog.llm import simhash


def brute_fingerprint(text, shingle=4):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= bits:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("table", ["edge", "sf"])
def test_near_duplicates_equal_brute_force(spark, table):
    docs = edge_docs(spark) if table == "edge" else sf_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    fp = [brute_fingerprint(r.text) for r in rows]
    root = brute_components(set(fp), 4)
    low = {}
    for r, f in zip(rows, fp):
        if r.doc_id is not None:
            low[root[f]] = min(low.get(root[f], r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{f:016x}", low.get(root[f])) for r, f in zip(rows, fp))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want


@pytest.mark.parametrize("bits,segments,block", [(4, 3, 4096), (4, 3, 2), (4, 2, 4096), (3, 4, 3), (6, 3, 4096)])
def test_links_connect_every_close_pair(spark, bits, segments, block):
    """Clusters around a few centres, with buckets split in a grid and not."""
    rnd = random.Random(bits * 10 + segments)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rnd.getrandbits(64)
        fps.add(centre)
        for _ in range(15):
            x = centre
            for b in rnd.sample(range(64), rnd.randint(1, 8)):
                x ^= 1 << b
            fps.add(x)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(df, bits, segments, block)
    for r in edges.collect():
        assert r.fp > r.root
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = brute_components(fps, bits)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(signed(f))
    for g in groups.values():
        low = min(g)
        assert {got.get(f, f) for f in g} == {low}


def test_ball_and_forest():
    assert sorted(simhash.ball(4, 2)) == sorted(
        sum(1 << b for b in c) for r in (1, 2) for c in itertools.combinations(range(4), r))
    a, b = simhash.forest(np.array([5, 3, 9]), np.array([3, 1, 8]))
    assert dict(zip(a.tolist(), b.tolist())) == {3: 1, 5: 1, 9: 8}


def test_deduplicated_keeps_one_of_each_group(spark):
    docs = edge_docs(spark)
    out = simhash.deduplicated(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    ids = [r.doc_id for r in rows]
    assert 4 in ids and 5 not in ids and 6 not in ids and 1 in ids and 2 not in ids
    assert ids.count(None) == 2
    assert simhash.deduplicated(empty_docs(spark)).collect() == []


def test_deduplicated_with_repeated_ids(spark):
    """A text stays or goes with its own group, whatever else has its id, and
    one row of a group stays."""
    import random
    rnd = random.Random(9)
    a, b, c, d = (" ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, c), (4, c), (5, d), (5, d + "  "), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, f"n{k}") for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, note string")
    out = simhash.deduplicated(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text.strip()) for r in out.collect())
    assert got == sorted([(1, a), (2, b), (3, c), (5, d), (0, a), (0, a)])
