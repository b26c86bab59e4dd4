"""Operator 6 against sets of shingles."""

import hashlib

import numpy as np
import pytest

from helpers import edge_docs, empty_docs, sf_docs, words
from tidelog.llm import bottomk


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("table", ["edge", "sf"])
def test_pairs_equal_brute_force(spark, table):
    docs = (edge_docs(spark).filter("doc_id IS NULL OR doc_id NOT IN (17, 18)").dropDuplicates(["doc_id"])
            if table == "edge" else sf_docs(spark))
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    out = {r.doc_id: r for r in bottomk.sketch_pairs(docs).collect()}
    assert len(out) == len(rows)
    off = []
    for i, r in enumerate(rows):
        text, following = r.text or "", rows[(i + 1) % len(rows)].text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        got = out[r.doc_id]
        assert got.n_chars == len(text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = bottomk.sketches([text])[0]
        assert got.fingerprint == bottomk.to_text(own)
        assert got.edited_fingerprint == bottomk.to_text(bottomk.sketches([edited])[0])
        a, b, c = shingles(text), shingles(edited), shingles(following)
        for est, x, y in ((got.near_edited, a, b), (got.near_next, a, c)):
            if len(x | y) <= bottomk.K:
                assert abs(est - jaccard(x, y)) < 1e-12
            off.append(abs(est - jaccard(x, y)))
        if len(a) < bottomk.K:
            assert len(own) == len(a)
        else:
            assert abs(bottomk.distinct(own) / len(a) - 1) < 0.5
    assert max(off) < 0.2 and np.mean(off) < 0.03


def test_repeated_ids_and_rows(spark):
    docs = edge_docs(spark)
    assert bottomk.sketch_pairs(docs).count() == docs.count()
    one = docs.filter("doc_id = 4")
    r = bottomk.sketch_pairs(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert bottomk.sketch_pairs(empty_docs(spark)).collect() == []
    by_text = {}
    for x in docs.select("doc_id", "text").collect():
        by_text.setdefault(x.text or "", set()).add(x.doc_id)
    found = bottomk.fingerprints(docs).collect()
    of = {x.doc_id: x.fingerprint for x in found if x.doc_id in (4, 5, 6)}
    assert len(set(of.values())) == 1 and len(found) == docs.count()


def test_sketches_merge_and_measure():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 64, 6000, dtype=np.uint64)
    a, b = h[:4000], h[2000:]
    s = lambda x: bottomk.sketch_of(x, 512)
    assert np.array_equal(bottomk.merge(s(a), s(b), 512), s(h))
    assert abs(bottomk.resemblance(s(a), s(b), 512) - 1 / 3) < 0.08
    assert abs(bottomk.containment(s(a), s(b), 512) - 0.5) < 0.12
    assert abs(bottomk.distinct(s(a), 512) / 4000 - 1) < 0.2
    assert np.array_equal(bottomk.from_text(bottomk.to_text(s(a))), s(a))
    copies = np.concatenate([np.full(5000, h[0]), h[:1000]])
    assert np.array_equal(s(copies), s(h[:1000]))


def test_ids_of_any_type_and_many_partitions(spark, monkeypatch):
    """String and date ids follow each other in their own order; the plan of
    8,000 parts is made in seconds."""
    import time
    from pyspark.sql import functions as F
    docs = sf_docs(spark).select("doc_id", "text")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for make in (lambda c: F.concat(F.lit("d'\"é"), c.cast("string")), lambda c: F.date_add(F.lit("2000-01-01"), c.cast("int"))):
        named = docs.withColumn("doc_id", make(F.col("doc_id")))
        ids = {r.n: r.doc_id for r in docs.select(make(F.col("doc_id")).alias("n"), "doc_id").collect()}
        order = sorted(ids)
        out = {r.doc_id: r for r in bottomk.sketch_pairs(named).collect()}
        assert len(out) == len(order)
        for i, n in enumerate(order):
            t, following = text[ids[n]], text[ids[order[(i + 1) % len(order)]]]
            half = len(t) // 2
            assert out[n].edited_sha256 == hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()
    monkeypatch.setattr(bottomk, "partitions", lambda s: 1000)
    many = spark.range(60000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    t = time.time()
    dealt = bottomk._dealt(many)
    assert dealt.select("part").distinct().count() > 5000 and time.time() - t < 60


def test_a_much_repeated_id_is_cut_by_its_texts(spark):
    from pyspark.sql import functions as F
    docs = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    sizes = [r["count"] for r in bottomk._dealt(docs).groupBy("part").count().collect()]
    assert max(sizes) < 300 and bottomk.sketch_pairs(docs).count() == 4000


def test_sketches_of_parts_merge_into_those_of_the_whole(spark):
    from pyspark.sql import functions as F
    docs = edge_docs(spark, clashing=False)
    key = F.when(F.col("doc_id") < 40, F.col("source"))
    parts = bottomk.fingerprints(docs).drop("n_shingles").join(
        docs.select("doc_id", key.alias("host")).distinct(), "doc_id")
    got = {r.host: (r.fingerprint, r.n_shingles) for r in bottomk.merged(parts, ["host"]).collect()}
    rows = docs.filter("doc_id IS NOT NULL").select(key.alias("host"), "text").collect()
    for host in {r.host for r in rows}:
        hasher = bottomk.WordHasher()
        own = [bottomk.sketches([r.text or ""], hasher=hasher)[0] for r in rows if r.host == host]
        whole = bottomk.sketch_of(np.concatenate(own))
        assert got[host] == (bottomk.to_text(whole), bottomk.distinct(whole))
    pairs = spark.createDataFrame([("x", got["a"][0], got["b"][0]), ("y", got["a"][0], got["a"][0])], "n string, a string, b string")
    out = {r.n: r for r in bottomk.compared(pairs).collect()}
    a, b = (bottomk.from_text(got[h][0]) for h in "ab")
    assert out["x"].resemblance == bottomk.resemblance(a, b) and out["x"].a_in_b == bottomk.containment(a, b)
    assert out["y"].resemblance == out["y"].b_in_a == 1.0 and out["y"].a_shingles == bottomk.distinct(a)
