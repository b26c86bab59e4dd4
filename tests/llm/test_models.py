"""Operators 1, 3, 8 and 9: brute-force versions, held-out accuracy, edge cases."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import edge_docs, empty_docs, sf_docs
from tidelog.llm import centroid_langid, ngram_lm, queries, toxicity, url_filter

SF = "/root/testdata/sf0.01"


# --- 1 ------------------------------------------------------------------------

def model_symbols(text):
    out = []
    for c in text or "":
        c = "0" if c in "0123456789" else " " if c in " \t\n\x0b\f\r" else c
        if not (c == " " and out and out[-1] == " "):
            out.append(c)
    return ["\x02"] * 3 + out + ["\x03"]


def kneser_ney(trusted, corpus):
    """Perplexity of each corpus text by the textbook recursion over dicts."""
    grams = lambda t: [tuple(t[i:i + 4]) for i in range(len(t) - 3)]
    counts = {4: Counter(g for t in trusted for g in grams(model_symbols(t)))}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    contexts, discounts = {}, {}
    for n, c in counts.items():
        contexts[n] = defaultdict(Counter)
        for g, k in c.items():
            contexts[n][g[:-1]][min(k, 3)] += 1
            contexts[n][g[:-1]]["total"] += k
        many = Counter(c.values())
        n1, n2, n3, n4 = (many[k] for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [0.0]
        for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)):
            d.append(min(float(k), max(0.0, k - (k + 1) * y * b / a)) if a and b else max(d[-1], 0.5))
        discounts[n] = d
    known = {g[-1] for t in corpus for g in grams(model_symbols(t))}

    def p(g):
        n = len(g)
        lower = p(g[1:]) if n > 1 else 1 / (len(known) + 1)
        h, d = contexts[n].get(g[:-1]), discounts[n]
        if not h:
            return lower
        c = counts[n].get(g, 0)
        own = max(c - d[min(c, 3)], 0) / h["total"] if c else 0.0
        return own + max(sum(d[k] * h[k] for k in (1, 2, 3)) / h["total"], 1e-9) * lower
    all_grams = [grams(model_symbols(t)) for t in corpus]
    return [math.exp(-sum(math.log(p(g)) for g in x) / len(x)) for x in all_grams]


@pytest.mark.parametrize("hot", [1 << 17, 50, 0])
def test_perplexities_equal_brute_force(spark, hot):
    """With every 4-gram broadcast, with few, and with none."""
    docs = edge_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    labels = spark.createDataFrame([(i, i % 2) for i in range(70)] + [(7, None), (7, 1), (None, 1)],
                                   "doc_id long, quality int")
    good = {i for i in range(70) if i % 2}
    want = kneser_ney([r.text for r in rows if r.doc_id in good], [r.text for r in rows])
    out = ngram_lm.classified(docs, labels, quantile=0.9, hot_rows=hot).collect()
    got = sorted((str(r.doc_id), round(r.perplexity, 6)) for r in out)
    assert got == sorted((str(r.doc_id), round(p, 6)) for r, p in zip(rows, want))
    for lang in {r.lang for r in out}:
        mine = sorted(r.perplexity for r in out if r.lang == lang and r.doc_id in good)
        if mine:
            limit = {r.threshold for r in out if r.lang == lang}.pop()
            q = mine[max(0, math.ceil(0.9 * len(mine) - 1e-9) - 1)]
            assert q <= limit <= q * math.exp(0.0011)
    assert all(r.kept == (r.perplexity <= r.threshold) for r in out)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_only_texts_that_pass_the_bitmap_are_moved(spark, threshold):
    """Going up from the scan of the texts, the bitmap's join comes before any
    exchange, whatever may be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
        out = ngram_lm.trusted_documents(docs.select("doc_id", "text"), labels)
        plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
        trusted = {r.doc_id for r in labels.filter("quality = 1").collect()}
        assert sorted(r.doc_id for r in out.collect()) == sorted(
            r.doc_id for r in docs.collect() if r.doc_id in trusted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "text#" in line)
    above = [line for line in plan[:scan][::-1] if "Exchange" in line or "HashJoin" in line or "MergeJoin" in line]
    assert "BroadcastHashJoin [_lm_word" in above[0] and "Exchange hashpartitioning" in above[1], plan
    assert any("ShuffledHashJoin [doc_id" in line for line in plan)


def test_quality_without_trust_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = ngram_lm.classified(edge_docs(spark), labels).collect()
    assert all(r.kept and r.threshold is None for r in out) and out
    assert ngram_lm.classified(empty_docs(spark), labels).collect() == []


def test_quality_labels_with_the_production_setting(spark):
    """Low-quality documents are told from trusted ones, and the limit isn't the
    perplexity of a text of a few characters."""
    sf = "/root/testdata/sf0.1"
    out = queries.op1_kneser_ney_quality(spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    bad, good = ([r for r in out if r.quality == k] for k in (0, 1))
    assert sum(not r.kept for r in bad) > 0.95 * len(bad)
    assert sum(r.kept for r in good) > 0.97 * len(good)
    for lang in {r.lang for r in good}:
        mine = sorted((r.perplexity, r.n_symbols) for r in good if r.lang == lang)
        limit = {r.threshold for r in good if r.lang == lang}.pop()
        above = sum(n for p, n in mine if p > limit)
        assert above <= (1 - ngram_lm.QUANTILE) * sum(n for _, n in mine)


def test_a_short_trusted_text_does_not_move_the_limit(spark):
    text = "plain words of the language in a text of some length " * 4
    rows = [(i, "en", text) for i in range(20)] + [(20, "en", "Zq."), (21, "en", "xkq jwv zzq " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, int(i < 21)) for i in range(22)], "doc_id long, quality int")
    out = {r.doc_id: r for r in ngram_lm.classified(docs, labels, by_symbols=True).collect()}
    assert out[20].perplexity > out[20].threshold >= out[0].perplexity and not out[21].kept


# --- 3 ------------------------------------------------------------------------

def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path] + [len(path)])]
    best = None
    for rule, verdict in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (0, "", ""), (len(rule), rule, verdict))
    return host, path, best and best[1], best and best[2]


URLS = [None, "", "no scheme", "https://", "http://ORG/", "http://org", "http://xorg/a", "https://a.Example.ORG/es/1?x#y",
        "https://example.org/en/12", "https://example.org/en/2", "ftp://b.com/fr/", "http://b.com/fr", "http://b.com/de/x",
        "http://É.com/de/a//b", "a://b://c/d", "http://h?q=/de/", "http://h#f", "https://example.org/es"] * 2


def test_url_rules_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").selectExpr(
        "*", "'x' AS host", "1 AS features", "2 AS label", "3 AS suffix", "4 AS rule")
    out = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(out) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute_rule(u)
        r = out[i]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
        assert r.verdict in ("allow", "block")


def test_url_filter_degenerate_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none).collect() == []
    plain = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(plain).collect()} == {"allow"}


# --- 8 and 9 ------------------------------------------------------------------

def test_toxicity_on_held_out_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = toxicity.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert hit / sum(r.predicted for r in out) > 0.85 and hit / sum(r.toxic for r in out) > 0.6
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in out)


def test_toxicity_edge_cases(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(4, 70)] + [(4, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.scored(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    empty = {r.score for r in out if r.doc_id in (1, 2, 3, 16)}
    assert len(empty) == 1
    only = toxicity.scored(docs, labels.filter("toxic = 0")).collect()
    assert {r.score for r in only} == {0.0}
    assert toxicity.scored(empty_docs(spark), labels).collect() == []


def test_scores_equal_brute_force():
    """Blocks of four words by their words' mean n-grams, the four best pooled:
    word by word, in plain Python."""
    import math
    rng = np.random.default_rng(4)
    model = {"gram": rng.normal(size=toxicity.BUCKETS).astype(np.float32), "bias": 0.3}
    texts = ["", None, "a", " \n ", "Über naïve words", "one two three four five six", "x " * 41,
             " ".join(f"w{k}" for k in range(99)), "日本 語 ok " * 7]

    def word_score(w):
        values = [model["gram"][b] for _, buckets in toxicity.grams([w]) for b in buckets.tolist()]
        return sum(map(float, values)) / len(values)

    def text_odds(text):
        words = [word_score(w) for w in (text or "").lower().encode().split()]
        if not words:
            return math.nan
        blocks = [words[i:i + 4] for i in range(0, len(words), 4)]
        if len(blocks) > 1 and len(blocks[-1]) < 2:
            blocks[-2:] = [blocks[-2] + blocks[-1]]
        best = sorted((sum(b) / len(b) + model["bias"] for b in blocks), reverse=True)[:4]
        return math.log(sum(map(math.exp, best)) / len(best))
    got = toxicity.log_odds(texts, model)
    assert np.allclose(got, [text_odds(t) for t in texts], atol=1e-4, equal_nan=True)


def test_words_share_subwords():
    a, b = (list(toxicity.grams([w])) for w in (b"worthless", b"worthlesss"))
    shared = set(np.concatenate([x[1] for x in a])) & set(np.concatenate([x[1] for x in b]))
    assert len(shared) > 0.6 * sum(len(x[1]) for x in a)
    together = list(toxicity.grams([b"ab", b"worthless", b"c"]))
    alone = np.sort(np.concatenate([x[1] for x in a]))
    assert np.array_equal(np.sort(np.concatenate([g[w == 1] for w, g in together])), alone)


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = centroid_langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)


def test_nearest_centroids_equal_brute_force(spark):
    """Counted n-grams, document frequencies, cosines and the nearest centroid of
    every document against plain Python over the same centroids."""
    import math
    from collections import Counter
    docs = sf_docs(spark).filter("doc_id % 4 = 0")
    train = docs.filter("lang IS NOT NULL").select("doc_id", "text", "lang")
    model = centroid_langid.fit(train)

    def hashed(*cs):
        muls = {3: (0xC2B2AE35, 0x85EBCA6B), 2: (0x85EBCA6B,), 1: ()}[len(cs)]
        h = ord(cs[0])
        for m, c in zip(muls, cs[1:]):
            h = (h * m & 0xFFFFFFFF) ^ ord(c)
        return (h * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - centroid_langid.BITS)

    def grams(text):
        # Letters, all else a space: 1 to 3 in a row around a letter.
        x = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        n = Counter()
        for a, b, c in zip(x, x[1:], x[2:]):
            if b != " ":
                n[hashed(b)] += 1
                n[hashed(a, b, c)] += 1
            if b != " " or c != " ":
                n[hashed(b, c)] += 1
        return n
    rows = docs.collect()
    own = {r.doc_id: grams(r.text or "") for r in rows}
    known = [own[r.doc_id] for r in train.collect()]
    df = Counter(g for n in known for g in n)
    idf = [math.log((1 + len(known)) / (1 + df[g])) + 1 for g in range(centroid_langid.DIMS)]
    assert np.allclose(model["idf"], idf, atol=1e-5)
    out = {r.doc_id: r for r in centroid_langid.predict(docs, model).collect()}
    for r in rows:
        v = {g: math.log1p(n) * idf[g] for g, n in own[r.doc_id].items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        cosines = [sum(x * float(c[g]) for g, x in v.items()) / size for c in model["centres"]]
        if not any(c.isalpha() for c in r.text or ""):
            assert out[r.doc_id].lang_pred == "und"
            continue
        best = max(cosines)
        assert abs(out[r.doc_id].score - min(1.0, max(0.0, best))) < 1e-4
        near = {model["lang"][j] for j, c in enumerate(cosines) if c > best - 1e-4}
        assert out[r.doc_id].lang_pred in near


def test_language_edge_cases(spark):
    docs = edge_docs(spark)
    out = centroid_langid.identified(docs).collect()
    und = [r for r in out if r.lang_pred == "und"]
    assert {r.doc_id for r in und} == {1, 2, 3, 15, 16, None} and len(out) == docs.count()
    assert all(r.score == 0 and r.rejected for r in und)
    assert {r.lang_pred for r in centroid_langid.identified(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()} == {"und"}
    assert centroid_langid.identified(empty_docs(spark)).collect() == []
