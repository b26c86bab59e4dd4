"""URL filter by gradient-boosted trees on lexical features (operator 3).

Rules of (host, path) allow or block a URL where one fits; those verdicts are
the labelled URLs. Boosted trees are trained on them and judge the others by
lexical features: lengths, depth, digit ratio, entropy of the host, parameter
counts, marks, and statistics of the host's suffix (how many pages it has, and
its smoothed share of blocked labels over all labelled pages).

Trees are fitted on at most ``TRAIN_ROWS`` labelled URLs (expected; chosen by
the hash of the URL); the suffix statistics cover all pages. Everything is
DataFrame functions and Spark's own tree learner.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and fits no rule; it is judged like any other. Without labels of both verdicts
there is nothing to learn: the one verdict seen is given, or allow if none.
Repeated rows count as often as they occur. Extra columns are ignored;
working columns have a ``_uf_`` prefix.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: (rule, verdict): the rule is a host and the start of a path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
TRAIN_ROWS = 50_000
TREES = 20
DEPTH = 4
SEED = 3
#: Labels that a suffix is given beforehand, at the overall share of blocked ones.
PRIOR_ROWS = 20.0


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path."""
    u = F.col(url)
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u)))
    out = pages.withColumn("_uf_rest", F.coalesce(rest, F.lit("")))
    host = F.regexp_extract("_uf_rest", r"^[^/?#]*", 0)
    out = out.withColumn("_uf_host", host)
    path = F.substring(F.col("_uf_rest"), F.length("_uf_host") + 1, F.length("_uf_rest"))
    return out.withColumns({
        "host": ascii_lower(F.col("_uf_host")),
        "path": F.regexp_extract(path, r"^[^?#]*", 0)}).drop("_uf_rest", "_uf_host")


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Add rule and rule_verdict: the longest rule that fits (the first of
    equally long ones), else null. A rule fits its host and all its subdomains
    where the path starts with the rule's path."""
    def fits(rule: str) -> Column:
        host, slash, path = rule.partition("/")
        return ((F.col("host") == host) | F.col("host").endswith("." + host)) & (
            F.col("path").startswith(slash + path))
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    name = F.coalesce(*[F.when(fits(r), F.lit(r)) for r, _ in ordered], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(fits(r), F.lit(v)) for r, v in ordered], F.lit(None).cast("string"))
    return pages.withColumns({"rule": name, "rule_verdict": verdict})


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.greatest(F.size(chars), F.lit(1))
    counts = F.transform(F.array_distinct(chars), lambda d: F.size(
        F.filter(chars, lambda c: c == d)) / n)
    return F.aggregate(counts, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def lexical_features(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add the lexical feature columns, prefixed ``f_``."""
    u = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    ratio = lambda a, b: a / F.greatest(b, F.lit(1.0))
    length = F.length(u).cast("double")
    host, path = F.col("host"), F.col("path")
    first, last = F.get(F.split(path, "/"), 1), F.element_at(F.split(path, "/"), -1)
    return pages.withColumns({
        "f_length": length,
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_query_length": F.length(query).cast("double"),
        "f_depth": count(path, "/[^/]"),
        "f_labels": count(host, r"[^.]+"),
        "f_digit_ratio": ratio(count(u, "[0-9]"), length),
        "f_path_digits": count(path, "[0-9]"),
        "f_host_digits": count(host, "[0-9]"),
        "f_hyphens": count(host, "-"),
        "f_entropy": _entropy(host),
        "f_params": F.when(query == "", F.lit(0.0)).otherwise(count(query, "&") + 1.0),
        "f_fragment": F.contains(u, F.lit("#")).cast("double"),
        "f_secure": F.startswith(u, F.lit("https:")).cast("double"),
        "f_page_file": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "f_slash_end": path.endswith("/").cast("double"),
        # Each letter pair of the first and the leading digit of the last path
        # segment as a number: ordered codes that trees can cut.
        "f_first_a": F.coalesce(F.ascii(F.substring(first, 1, 1)), F.lit(0)).cast("double"),
        "f_first_b": F.coalesce(F.ascii(F.substring(first, 2, 1)), F.lit(0)).cast("double"),
        "f_first_length": F.coalesce(F.length(first), F.lit(0)).cast("double"),
        "f_last_digit": F.coalesce(F.ascii(last), F.lit(0)).cast("double"),
    })


FEATURES = ["f_length", "f_host_length", "f_path_length", "f_query_length", "f_depth", "f_labels",
            "f_digit_ratio", "f_path_digits", "f_host_digits", "f_hyphens", "f_entropy", "f_params",
            "f_fragment", "f_secure", "f_page_file", "f_slash_end", "f_first_a", "f_first_b",
            "f_first_length", "f_last_digit", "f_suffix_pages", "f_suffix_blocked"]


def suffix_statistics(pages: DataFrame) -> DataFrame:
    """Per suffix (the last two labels of the host): pages, and the smoothed
    share of blocked among its labelled pages."""
    per = pages.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n"), F.count("rule_verdict").alias("labelled"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked"))
    every = per.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    share = (every["b"] or 0) / every["l"] if every["l"] else 0.5
    return per.select(
        "suffix", F.log1p("n").alias("f_suffix_pages"),
        ((F.col("blocked") + F.lit(PRIOR_ROWS * share)) / (F.col("labelled") + F.lit(PRIOR_ROWS)))
        .alias("f_suffix_blocked"))


def judge(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url",
          train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, and the model's block score."""
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    known = with_rule(with_parts(src), rules)
    known = known.withColumn("suffix", F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0))
    rows = lexical_features(known)
    stats = suffix_statistics(known)
    full = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        rows.join(stats, "suffix"))
    labels = {r["rule_verdict"]: r["count"] for r in known.filter(
        "rule_verdict IS NOT NULL").groupBy("rule_verdict").count().collect()}
    if len(labels) < 2:
        only = next(iter(labels), "allow")
        scored = full.withColumn("block_score", F.lit(1.0 if only == "block" else 0.0))
    else:
        rate = min(1.0, train_rows / sum(labels.values()))
        chosen = F.pmod(F.xxhash64(F.lit(SEED), "url"), F.lit(1 << 20)) < F.lit(rate * (1 << 20))
        train = stored(full.filter(F.col("rule_verdict").isNotNull() & chosen).select(
            "features", (F.col("rule_verdict") == "block").cast("double").alias("label")))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(train)
        scored = model.transform(full).withColumn(
            "block_score", F.get(vector_to_array("probability"), 1))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(
            F.lit("allow"))).alias("verdict"), "block_score")
