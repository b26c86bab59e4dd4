"""Operators 2 and 7 against plain Python."""

import hashlib
from collections import Counter, defaultdict

import pytest

from helpers import CLASHING, edge_docs, empty_docs, sf_docs, words
from tidelog.llm import line_dedup, line_frequency as lf

WHITE = " \t\n\x0b\f\r"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), n < 10 or 100 * len(covered) > 20 * n)


def line_verdicts(rows):
    """depleted and words left by (host, text)."""
    import re
    norm = lambda x: re.sub("[0-9]+", "0", x.lower()).strip(WHITE)
    texts = {(r.source, r.text or "") for r in rows}
    hosts = Counter(h for h, _ in texts)
    held = Counter((h, x) for h, t in texts for x in {norm(y) for y in t.split("\n")} if x)
    often = {k for k, n in held.items() if n >= lf.MIN_DOCS and n > lf.MAX_SHARE * hosts[k[0]]}
    out = {}
    for h, t in texts:
        gone = [x for x in t.split("\n") if (h, norm(x)) in often]
        left = len(words(t)) - sum(len(words(x)) for x in gone)
        chars = sum(map(len, words(t)))
        left_chars = chars - sum(len("".join(words(norm(x)))) for x in gone)
        out[h, t] = (bool(gone) and (left < lf.MIN_WORDS or left_chars < lf.MIN_LEFT * chars), len(gone), left)
    return out


@pytest.mark.parametrize("table", ["edge", "sf"])
def test_verdicts_equal_brute_force(spark, table):
    docs = edge_docs(spark) if table == "edge" else sf_docs(spark)
    rows = docs.select("doc_id", "text", "source").collect()
    lines = line_verdicts(rows)
    want = Counter()
    for r in rows:
        b, (depleted, gone, left) = base(r.text), lines[r.source, r.text or ""]
        want[(r.doc_id, *b, gone, left, depleted, not b[-1] and not depleted)] += 1
    got = Counter(tuple(r) for r in lf.verdicts(docs).collect())
    assert got == want
    assert any(k[-2] for k in want) or table == "sf"


def test_clean_cuts_frequent_lines_and_keeps_columns(spark):
    docs = edge_docs(spark)
    out = lf.clean(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    kept = Counter((r.doc_id, r.source) for r in lf.verdicts(docs).join(
        docs.select("doc_id", "source").distinct(), "doc_id").filter("kept").collect())
    assert {r.doc_id for r in rows if r.doc_id} == {k[0] for k in kept}
    for r in rows:
        if r.source == "a" and r.doc_id and r.doc_id >= 30:
            assert "common line" not in r.text.lower() and len(r.text.split("\n")) == 2
        if r.doc_id == 8:
            assert len(r.text.split("\n")) == 900


def test_a_line_of_all_hosts_is_cut_in_every_host(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lines = lambda t: {x.strip(WHITE) for x in (t or "").split("\n")}
    texts = {(r.source, r.text) for r in docs.select("source", "text").collect()}
    line = Counter(x for _, t in texts for x in lines(t) if x).most_common(1)[0][0]
    hosts = {h for h, t in texts if line in lines(t)}
    assert hosts == {h for h, _ in texts} and len(hosts) == 20
    keys = lf.line_keys(docs)
    found = lf.frequent_lines(keys, docs).collect()
    assert len(found) == len(hosts) and len({r._lf_h for r in found}) == 1
    assert not [r for r in lf.clean(docs).select("text").collect() if line in lines(r.text)]


def test_removed_lines_take_their_own_characters_once(spark):
    """Frequent lines that differ in their numbers, and copies of a text."""
    def text(i):
        if i == 0:                     # 100 characters in 12 words, and 1,000 digits
            return "\n".join(["eightchr " * 11 + "lasttwelvech", "page " + "7" * 1000])
        if i < 4:                      # equal texts: the line is in each of them once
            return "enough words are left in this text of copies to be kept well beyond it\npage 5 of 5"
        if i == 4:                     # two frequent lines of one hash and two lengths
            return "twelve words stay in this one so that only its characters can decide\npage 1\nPage " + "3" * 400
        return f"page {i}\n" + " ".join(f"own{chr(97 + i)}word{chr(97 + j)}" for j in range(15))
    docs = spark.createDataFrame([(i, text(i), "a") for i in range(30)], "doc_id long, text string, source string")
    out = {r.doc_id: r for r in lf.verdicts(docs).collect()}
    assert out[0].n_words_left == 12 and out[0].depleted and not out[0].kept
    for i in range(1, 4):
        assert not out[i].n_lines_removed and out[i].kept
    assert (out[4].n_lines_removed, out[4].n_words_left) == (2, 13) and out[4].depleted
    assert all(out[i].n_lines_removed == 1 and out[i].n_words_left == 15 and out[i].kept for i in range(5, 30))
    copied = docs.unionByName(docs.filter("doc_id >= 5")).unionByName(docs.filter("doc_id >= 5"))
    assert {tuple(r) for r in lf.verdicts(copied).collect()} == {tuple(r) for r in out.values()}


def test_lines_removed_equal_brute_force_at_the_limit(spark):
    """sf0.1 holds a frequent line in every host, also in copied texts."""
    rows = (docs := spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).select(
        "doc_id", "text", "source").collect()
    want = line_verdicts(rows)
    got = {r.doc_id: r for r in lf.verdicts(docs).collect()}
    for r in rows:
        x = got[r.doc_id]
        assert (x.depleted, x.n_lines_removed, x.n_words_left) == want[r.source, r.text or ""]
    assert sum(x.n_lines_removed > 0 for x in got.values()) > 1000


def test_rules_empty_table(spark):
    assert lf.verdicts(empty_docs(spark)).collect() == [] and lf.clean(empty_docs(spark)).collect() == []


def dedup(rows, min_chars=10):
    norm = lambda x: x.strip(WHITE).translate(A_Z)
    order = lambda i: (i is None, i or 0)
    first, holders = {}, defaultdict(set)
    for r in rows:
        for x in map(norm, (r.text or "").split("\n")):
            holders[x].add(r.doc_id)
            first[x] = min(first.get(x, order(r.doc_id)), order(r.doc_id))
    out = Counter()
    for r in rows:
        lines = (r.text or "").split("\n")
        stay = [x for x in lines if not (len(norm(x)) >= min_chars and len(holders[norm(x)]) > 1
                                         and first[norm(x)] != order(r.doc_id))]
        out[r.doc_id, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("table", ["edge", "sf", "hot"])
def test_line_dedup_equals_brute_force(spark, table, monkeypatch):
    from pyspark.sql import functions as F
    docs = edge_docs(spark) if table == "edge" else sf_docs(spark)
    if table == "hot":                 # every repeated hash is spread over blocks
        monkeypatch.setattr(line_dedup, "HOT_PARTS", 1000)
    rows = docs.select("doc_id", "text").collect()
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    got = Counter(tuple(r) for r in out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect())
    assert got == dedup(rows)
    for r in out.select("n_dropped", "dropped_runs").collect():
        assert r[0] == sum(x["to"] - x["from"] + 1 for x in r[1] or [])


def test_line_dedup_columns_and_empty_table(spark):
    docs = edge_docs(spark)
    out = line_dedup.cleaned(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING)
    assert [r for r in out.filter("doc_id = 1").collect()][0].text is None
    assert line_dedup.cleaned(empty_docs(spark)).collect() == []
