"""Spelling variants against brute force on all pairs, for small buckets too."""

import random
import re
import zlib

import duckdb
import pytest

from helpers import edge_docs, empty_docs, sf_docs
from tidelog.llm import spelling
from tidelog.llm.oracle import SPELLING


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, drop_mod=31, min_length=7):
    n = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            if h % drop_mod == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_length:
                n[w] = n.get(w, 0) + 1
    n = {w: c for w, c in n.items() if c >= 2}
    form, out = {}, {}
    for w in n:
        others = sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x))
        form[w] = others[0] if others and n[others[0]] >= 10 * n[w] else None
        out[w] = [n[w], len(others), form[w], n[form[w]] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def variant_rows():
    """Families of words: a frequent one, its edits and edits of those, words
    of one letter multiset, repeated letters, accents, very long words."""
    rnd = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyzéßñ×"

    def edit(w):
        k, c = rnd.randrange(len(w)), rnd.choice(letters)
        return rnd.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])

    rows, i = [], 1
    for _ in range(25):
        base = "".join(rnd.choice(letters) for _ in range(rnd.choice([7, 8, 9, 12, 60])))
        family = [base] + [edit(base) for _ in range(4)]
        family += [edit(w) for w in family[1:]]
        text = (base + " ") * 120 + " ".join(w.upper() if rnd.random() < .2 else w for w in family * rnd.choice([1, 2, 11]))
        rows.append((i, text.replace(" ", rnd.choice([" ", "\n", "1", "Ā", "日"]))))
        i += 1
    bag = list("aabbccdd")
    for _ in range(60):
        rnd.shuffle(bag)
        rows.append((i, " ".join(["".join(bag), "".join(bag) + "e"] * 2)))
        i += 1
    rows += [(i, " ".join(["a" * n for n in range(7, 60)] * 2)), (i, "x" * 3000 + " " + "x" * 2999 + " " + "x" * 3000 + " " + "x" * 2999)]
    return rows + [(None, rows[0][1]), (None, None), (1, ""), (2, "...")]


@pytest.mark.parametrize("bucket,queries,drop_mod", [(1 << 14, 1 << 18, 31), (1, 1, 31), (1, 1, 2)])
def test_variants_equal_brute_force(spark, bucket, queries, drop_mod):
    rows = variant_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    df = spelling.variants(docs.repartition(3), bucket=bucket, queries=queries, drop_mod=drop_mod)
    expected = brute(rows, drop_mod)
    assert sum(1 for v in expected.values() if v[2]) > 10 and got(df) == expected


def test_edge_tables(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(spelling.variants(docs)) == brute(rows)
    assert spelling.variants(empty_docs(spark)).collect() == []
    named = docs.withColumn("doc_id", docs["doc_id"].cast("string"))
    assert got(spelling.variants(named)) == brute(rows)


def test_sf_table_equals_sql(spark):
    docs = sf_docs(spark)
    df = spelling.variants(docs)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    table = con.execute(SPELLING).fetchall()
    assert len(table) > 100
    assert got(df) == {w: (n, k, form, form_n, root) for w, n, k, form, form_n, root in table}


def test_ratio_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(empty_docs(spark), ratio=1)


def test_roots_follow_long_chains(spark):
    words = ["w%02d" % k for k in range(9)]
    rows = [(w, 10 ** k, 1, words[k + 1] if k < 8 else None, 10 ** (k + 1) if k < 8 else None) for k, w in enumerate(words)]
    t = spark.createDataFrame(rows, "word string, n long, n_near long, form string, form_n long")
    assert {r["root"] for r in spelling.with_roots(t).collect()} == {"w08"}
