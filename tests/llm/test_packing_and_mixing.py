"""Operators 4 and 5: exact round trips, invariants, and closeness to bounds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import CLASHING, edge_docs, empty_docs, sf_docs, words
from tidelog.llm import curriculum, packing


def whole_ids(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    return [tok.encode(t, add_special_tokens=False).ids for t in texts]


ODD = ["", " ", "Hello, World. It's 'S fine... 4.05,x", "a b c", "x\x1cy z", "é ́ Été.",
       "<|endoftext|> a<|ENDOFTEXT|>b. C", "İstanbul ΣΑΣ straße", "a.b,c d.,e !!, f", "​z﻿ w", "I'LL we'Ve. 'd,"]


def test_word_encoder_equals_whole_texts(spark):
    texts = ODD + [r.text for r in sf_docs(spark).select("text").collect()] * 2
    enc = packing.WordEncoder(packing.tokenizer_path())
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)]
    assert got == whole_ids(texts)


def test_word_encoder_equals_whole_texts_of_any_latin_characters():
    rnd = random.Random(9)
    latin = "".join(map(chr, range(1, 256)))
    alphabets = [latin, "aB.,é É", "x.y,z '\"()-", "12.,½²³ªºµß×÷ÀÞ", "a.b <|endoftext|>", "\x85\xa0\x1c a."]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.randint(0, 40))) for a in alphabets for _ in range(500)]
    texts += [t.replace("b", "日") for t in texts[::7]]
    enc = packing.WordEncoder(packing.tokenizer_path())
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)]
    assert got == whole_ids(texts)


def test_word_encoder_forgets_when_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    monkeypatch.setattr(packing, "CALL_WORDS", 2)
    enc = packing.WordEncoder(packing.tokenizer_path())
    texts = ["one two three four five six seven", "eight two nine", "one ten"]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == whole_ids(texts)


@pytest.mark.parametrize("table,capacity", [("edge", 64), ("sf", 4096)])
def test_pieces_and_places(spark, table, capacity):
    docs = edge_docs(spark) if table == "edge" else sf_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    want = Counter()
    for r, ids in zip(rows, whole_ids([r.text or "" for r in rows])):
        ids = ids + [1]
        for p, a in enumerate(range(0, len(ids), capacity)):
            part = np.asarray(ids[a:a + capacity], "<u4")
            want[r.doc_id, p, a, len(part), zlib.crc32(part.tobytes())] += 1
    out = packing.packed(docs, capacity=capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def first_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        for i, r in enumerate(rooms):
            if r >= x:
                rooms[i] -= x
                break
        else:
            rooms.append(capacity - x)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_as_tight_as_first_fit_decreasing(seed):
    rnd = random.Random(seed)
    n = [1, 7, 300, 1500, 1500, 1500][seed]
    lengths = [min(4096, max(1, int(rnd.lognormvariate(6.4, 1.1)))) for _ in range(n)]
    hist = Counter(lengths)
    plan = packing.plan(dict(hist))
    load, places = Counter(), defaultdict(list)
    covered = Counter()
    for length, a, b, first, offset in plan.tolist():
        covered[length] += b - a
        for k in range(b - a):
            load[first + k] += length
            places[first + k].append((offset, length))
    assert covered == hist and max(load.values()) <= 4096
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert len(load) <= 1.01 * first_fit_decreasing(lengths, 4096) + 1


def test_packing_empty_table(spark):
    assert packing.packed(empty_docs(spark)).collect() == []


def targets(sizes):
    """Water filling by whole rounds of resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in sizes if s not in capped)
        share = {s: 3 * sizes[s] if s in capped else rest * weight[s] / w for s in sizes}
        over = {s for s in sizes if s not in capped and share[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return share
        capped |= over


@pytest.mark.parametrize("table", ["edge", "sf"])
def test_mixture(spark, table):
    docs = edge_docs(spark) if table == "edge" else sf_docs(spark)
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    want = targets(sizes)
    source_of = defaultdict(set)
    for r in rows:
        source_of[r.doc_id].add(r.source)
    out = curriculum.mixture(docs).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r.doc_id, len(words(r.text))) for r in rows)
    assert Counter(tuple(r) for r in map(lambda r: (r.doc_id, r.size, r.taken), out)) == Counter(
        (r.doc_id, r.size, r.taken) for r in curriculum.mixture(docs.repartition(5)).collect())
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    taken, biggest = Counter(), Counter()
    for r in out:
        s = next(s for s in source_of[r.doc_id] if sizes[s] == r.source_size and abs(want[s] - r.target) < 1e-6 * max(1, r.target))
        taken[s] += r.taken
        biggest[s] = max(biggest[s], r.size)
        assert r.taken <= 3 * r.size and len(r.positions) * r.size == r.taken
        assert all(0 <= p <= 1 for p in r.positions)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s]


def test_schedule_is_inverted(spark):
    """Up to t the source has supplied target * (t + slope * (t^2 - t))."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(u, s) for u in (0.0, 0.1, 0.5, 0.9, 1.0) for s in (-1.0, -0.5, 0.0, 0.5, 1.0)], "u double, s double")
    for r in df.withColumn("t", curriculum.training_time(F.col("u") * 7, F.lit(7.0), F.col("s"))).collect():
        assert abs(r.t + r.s * (r.t * r.t - r.t) - r.u) < 1e-9


def test_mixed_documents_come_in_order_as_often_as_taken(spark):
    docs = edge_docs(spark)
    out = curriculum.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    mix = curriculum.mixture(docs).collect()
    want = Counter()
    for r in mix:
        want[r.doc_id] += len(r.positions)
    assert Counter(r.doc_id for r in rows) == +want
    at = {r.doc_id: iter(sorted(r.positions)) for r in mix if list(m.doc_id for m in mix).count(r.doc_id) == 1}
    order = [next(at[r.doc_id]) for r in rows if r.doc_id in at]
    assert order == sorted(order) and len(order) > 20


@pytest.mark.parametrize("table", ["edge", "sf"])
def test_mixture_tells_the_places_in_the_sorted_mix(spark, table):
    """The documents of the sorted mix are those whose places say so, in each
    place; what is taken is what is there."""
    docs = edge_docs(spark) if table == "edge" else sf_docs(spark)
    mix = curriculum.mixture(docs).collect()
    rows = curriculum.mixed_documents(docs).collect()
    at = sorted((place, position, r.doc_id, r.size) for r in mix for place, position in zip(r.places, r.positions, strict=True))
    assert [place for place, *_ in at] == list(range(len(rows)))
    assert [position for _, position, *_ in at] == sorted(position for _, position, *_ in at)
    assert [(i, n) for *_, i, n in at] == [(r.doc_id, len(words(r.text))) for r in rows]
    assert all(r.places == sorted(r.places) for r in mix)
    assert table == "edge" or any(not r.places for r in mix)


def test_mixture_is_counted_in_the_sorted_texts(spark, monkeypatch):
    """A mix without some of its rows has none of their words."""
    docs = edge_docs(spark)
    whole = curriculum.training_order
    monkeypatch.setattr(curriculum, "training_order", lambda *a: whole(*a).filter("_cu_own_0 % 2 = 0"))
    for r in curriculum.mixture(docs).collect():
        assert r.taken == len(r.places) * r.size and (not r.places or r.doc_id % 2 == 0)


def test_texts_are_moved_twice_to_be_mixed(spark):
    """To their places and to be sorted; equal rows are numbered on the way."""
    docs = sf_docs(spark)
    numbered = curriculum._numbered(curriculum.supply(docs))
    plan = curriculum.training_order(docs, numbered)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Union")]
    assert above.count("Exchange") == 2 and above.count("Exchange rangepartitioning") == 1


def test_repeated_rows_are_each_taken(spark):
    rows = [(1, "a b c", "x")] * 40 + [(2, "d e", "x")] * 3 + [(None, "f", None)] * 5 + [(3, "g h", "y"), (3, "i", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    mix = curriculum.mixture(docs).collect()
    assert Counter((r.doc_id, r.size) for r in mix) == Counter((i, len(words(t))) for i, t, _ in rows)
    assert sorted(p for r in mix for p in r.places) == list(range(sum(len(r.places) for r in mix)))
    taken = Counter()
    for r in curriculum.mixed_documents(docs).collect():
        taken[r.doc_id] += len(words(r.text))
    assert {r.doc_id: 0 for r in mix} | taken == {
        i: sum(r.taken for r in mix if r.doc_id == i) for i in (1, 2, None, 3)}


def test_mixing_empty_table(spark):
    assert curriculum.mixture(empty_docs(spark)).collect() == []
    assert curriculum.mixed_documents(empty_docs(spark)).collect() == []
