"""Periodic runs against brute force over every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from helpers import edge_docs, empty_docs, sf_docs, words
from tidelog.llm import periodic_runs


def brute(x):
    """(start, length, period) by start and period: every stretch of every
    period, of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(x)):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    ws = words(text)
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = brute(ws)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def random_lists(seed, many):
    rnd = random.Random(seed)
    for _ in range(many):
        lists = []
        for _ in range(rnd.randint(1, 5)):
            n, v = rnd.randint(0, 130), rnd.choice([1, 2, 2, 3, 5, 50])
            x = [b"%d" % rnd.randrange(v) for _ in range(n)]
            if rnd.random() < .6 and n:
                a = rnd.randrange(n)
                p = rnd.randint(1, max(1, (n - a) // 2))
                x = x[:a] + (x[a:a + p] * n)[:n - a]
                if rnd.random() < .5:
                    x[rnd.randrange(n)] = b"z"
            lists.append(x)
        yield lists


def found(lists):
    runs = periodic_runs.numbered(lists).runs()
    return [[tuple(r[1:]) for r in runs.tolist() if r[0] == t] for t in range(len(lists))]


def test_random_lists_equal_brute_force():
    for lists in random_lists(6, 250):
        assert found(lists) == [brute(x) for x in lists]


def test_blocks_longer_than_a_transform(monkeypatch):
    # Only the first words of a block are looked for, a few distances at a time.
    monkeypatch.setattr(periodic_runs, "LONGEST", 2)
    monkeypatch.setattr(periodic_runs, "SPAN", 3)
    monkeypatch.setattr(periodic_runs, "ASKED", 1)
    for lists in random_lists(8, 120):
        assert found(lists) == [brute(x) for x in lists]


def test_hashes_that_lie_do_not_decide(monkeypatch):
    # Hashes that are all alike: only the word by word comparison tells.
    monkeypatch.setattr(periodic_runs.Texts, "same", lambda self, a, b, n: np.ones(len(a), bool))
    for lists in random_lists(7, 25):
        assert found(lists) == [brute(x) for x in lists]


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    p = periodic_runs.PRIME
    a, b = rng.integers(0, p, (2, 3, 64), dtype=np.uint64)
    back = periodic_runs.ntt(periodic_runs.ntt(a), inverse=True)
    assert (back == a).all()
    product = periodic_runs.ntt(periodic_runs.ntt(a) * periodic_runs.ntt(b) % np.uint64(p), inverse=True)
    for r in range(3):
        for k in range(64):
            assert int(product[r, k]) == sum(int(a[r, i]) * int(b[r, (k - i) % 64]) for i in range(64)) % p


def test_long_and_extreme_texts():
    one = [b"a"] * 30000
    assert found([one, [], one[:11], one[:12]]) == [[(0, 30000, 1)], [], [], [(0, 12, 1)]]
    rnd = random.Random(1)
    block = [b"%d" % rnd.randrange(10 ** 9) for _ in range(5001)]
    assert found([block * 2, block * 2 + block[:7], block + [b"x"] + block]) == [
        [(0, 10002, 5001)], [(0, 10009, 5001)], []]


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


@pytest.mark.parametrize("make", [edge_docs, sf_docs])
def test_tables_equal_brute_force(spark, make):
    docs = make(spark).filter("doc_id IS NULL OR length(text) IS NULL OR length(text) < 12000")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    out = periodic_runs.digests(docs)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    got = sorted_rows(map(tuple, out.collect()))
    assert sum(1 for r in got if r[1]) > 0 and got == sorted_rows(brute_row(*r) for r in rows)


def test_runs_and_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y"), (2, None), (None, "q " * 20)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in periodic_runs.runs_of(docs).collect()}
    assert [tuple(r) for r in rows[1]["runs"]] == [(1, 15, 3)] and rows[1]["collapsed"] == "x a b c y"
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == "" and rows[None]["collapsed"] == "q"


def test_empty_table_and_string_ids(spark):
    assert periodic_runs.digests(empty_docs(spark)).collect() == []
    named = spark.createDataFrame([("77", "a b " * 20)], "doc_id string, text string")
    assert tuple(periodic_runs.digests(named).first()) == tuple(["77", *brute_row(77, "a b " * 20)[1:]])
