"""Quality rules by cross-document line frequency (operator 2).

Base rules look at one document: too few words, or too many words in repeated
5-word windows. The method then looks across documents: lines are normalised
and hashed, the distinct documents holding each line are counted per host,
lines above the host's limit are removed, and a document of which too little
is left is rejected.

Defined cases: a null text is an empty text; a null host is a host of its own;
a null id stays null (ids take no part in any decision). Documents of one host
with equal texts are one document to the counts, so a text that was merely
copied doesn't turn its own lines into boilerplate. Lines without a word are
never counted nor removed. Extra columns are carried through ``clean`` and
ignored by ``verdicts``; working columns have a ``_lf_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, WHITE_CHARS, two_hashes, words

#: A line is boilerplate of a host when more than this share of the host's
#: distinct documents hold it, and at least MIN_DOCS of them. The share is well
#: below that of a site's boilerplate, which varies by host around a tenth, and
#: above that of lines that documents share by chance.
MAX_SHARE = 0.05
MIN_DOCS = 10
#: A document is depleted when fewer words are left, or a smaller share of its
#: word characters.
MIN_WORDS = 10
MIN_LEFT = 0.3
#: Blocks in which the documents of one line are spread when the frequent lines
#: are looked up, so a line of a third of the documents isn't one task.
SPREAD = 16

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def repeated_words(df: DataFrame, words_col: str, name: str) -> DataFrame:
    """Add the number of words that lie in a 5-word window found twice or more
    in the same array. Windows are compared as hashes of word hashes; only
    arrays with equal windows are sorted to find their places."""
    i5 = F.sequence(F.lit(1), F.size("_lf_wh") - (WINDOW - 1))
    out = df.withColumn("_lf_wh", F.transform(words_col, lambda w: F.xxhash64(w)))
    out = out.withColumn("_lf_g", F.when(F.size("_lf_wh") >= WINDOW, F.transform(
        i5, lambda i: F.xxhash64(F.slice("_lf_wh", i, WINDOW)))))
    twice = F.size(F.array_distinct("_lf_g")) < F.size("_lf_g")
    out = out.withColumn("_lf_s", F.when(twice, F.sort_array(F.transform(
        "_lf_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_lf_s")
    equal = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
    out = out.withColumn("_lf_p", F.sort_array(F.transform(
        F.filter(s, lambda x, i: equal(i, i - 1) | equal(i, i + 1)), lambda x: x["i"])))
    p = F.col("_lf_p")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(
            F.get(p, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return out.withColumn(name, F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_lf_wh", "_lf_g", "_lf_s", "_lf_p")


def base_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed, each from the document alone."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_lf_t", t).withColumn("_lf_w", words(F.col("_lf_t")))
    out = out.withColumn("_lf_l", F.filter(
        F.split("_lf_t", "\n"), lambda x: F.trim(x, F.lit(WHITE_CHARS)) != ""))
    out = out.withColumns({
        "n_words": F.size("_lf_w").cast("long"),
        "word_chars": F.char_length(F.array_join("_lf_w", "")).cast("long"),
        "n_symbols": F.regexp_count("_lf_t", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lf_l") - F.size(F.array_distinct("_lf_l"))).cast("long")})
    out = repeated_words(out.drop("_lf_l", "_lf_t"), "_lf_w", "n_repeat_words").drop("_lf_w")
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    # A later filter on a feature would be pushed below the steps above and repeat
    # them inside one another; behind a generator (of one row) it stays where it is.
    features = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return out.withColumn("_lf_x", F.explode(F.array(F.struct(*features)))).withColumns(
        {c: F.col(f"_lf_x.{c}") for c in features}).drop("_lf_x")


def normalised(text: Column) -> Column:
    """Lines as they are compared: lower-cased, digit runs as one 0."""
    return F.regexp_replace(F.lower(text), "[0-9]+", "0")


def host_key(host: str) -> Column:
    """Never null, and different for a null and an empty host."""
    return F.coalesce(F.concat(F.lit("h"), F.col(host).cast("string")), F.lit(""))


def _keyed(docs: DataFrame, host: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    a, b = two_hashes(t)
    return docs.withColumns({"_lf_host": host_key(host), "_lf_a": a, "_lf_b": b})


def line_keys(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """One row per line with a word: host, text hashes, the line's number, its
    hash as it is compared, its words and word characters as they stand."""
    one = _keyed(docs, host, text).select(
        "_lf_host", "_lf_a", "_lf_b",
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_lf_i", "_lf_line"))
    return one.filter(F.trim("_lf_line", F.lit(WHITE_CHARS)) != "").select(
        "_lf_host", "_lf_a", "_lf_b", "_lf_i",
        F.xxhash64(F.trim(normalised(F.col("_lf_line")), F.lit(WHITE_CHARS))).alias("_lf_h"),
        F.regexp_count("_lf_line", F.lit(r"[^\x20\x09-\x0D]+")).alias("_lf_n"),
        F.char_length(F.regexp_replace("_lf_line", WHITE, "")).alias("_lf_c"))


def frequent_lines(lines: DataFrame, docs: DataFrame, host: str = "source",
                   text: str = "text") -> DataFrame:
    """host, line hash and the number of distinct documents holding the line,
    for lines above the host's limit."""
    hosts = (_keyed(docs, host, text).select("_lf_host", "_lf_a", "_lf_b").distinct()
             .groupBy("_lf_host").agg(F.count(F.lit(1)).alias("_lf_docs")))
    counts = (lines.select("_lf_host", "_lf_h", "_lf_a", "_lf_b").distinct()
              .groupBy("_lf_host", "_lf_h").agg(F.count(F.lit(1)).alias("line_docs"))
              .filter(F.col("line_docs") >= MIN_DOCS))
    return counts.join(hosts, "_lf_host").filter(
        F.col("line_docs") > MAX_SHARE * F.col("_lf_docs")).select(
            "_lf_host", "_lf_h", "line_docs")


def removed(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per host and text: the words and word characters that frequent lines
    take, and those lines' hashes. The lines of equal texts are one text's. The
    rows of one line are spread over blocks; the (few) frequent lines are
    repeated into each block."""
    f = frequent.select("_lf_host", "_lf_h", F.explode(
        F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_lf_x"))
    per_text = lines.groupBy("_lf_host", "_lf_a", "_lf_b", "_lf_i").agg(
        F.max("_lf_h").alias("_lf_h"), F.max("_lf_n").alias("_lf_n"), F.max("_lf_c").alias("_lf_c"))
    return (per_text.withColumn("_lf_x", F.pmod("_lf_a", F.lit(SPREAD)).cast("int"))
            .join(f, ["_lf_host", "_lf_h", "_lf_x"])
            .groupBy("_lf_host", "_lf_a", "_lf_b")
            .agg(F.sum("_lf_n").alias("_lf_rw"), F.sum("_lf_c").alias("_lf_rc"),
                 F.count(F.lit(1)).alias("_lf_rl"),
                 F.collect_set("_lf_h").alias("_lf_gone")))


def _depleted(left_words: Column, left_chars: Column) -> Column:
    return F.col("_lf_rl").isNotNull() & (
        (left_words < MIN_WORDS) | (left_chars < MIN_LEFT * F.col("word_chars")))


def _features_and_gone(docs: DataFrame, host: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents' keys and base features, and what frequent lines take."""
    lines = line_keys(docs, host, text)
    gone = removed(lines, frequent_lines(lines, docs, host, text))
    keyed = base_features(_keyed(docs, host, text), text)
    return keyed, gone


def _judged(features: DataFrame, gone: DataFrame) -> DataFrame:
    out = features.join(gone, ["_lf_host", "_lf_a", "_lf_b"], "left")
    left_w = F.col("n_words") - F.coalesce("_lf_rw", F.lit(0))
    left_c = F.col("word_chars") - F.coalesce("_lf_rc", F.lit(0))
    out = out.withColumns({
        "n_lines_removed": F.coalesce("_lf_rl", F.lit(0)).cast("long"),
        "n_words_left": left_w.cast("long"), "depleted": _depleted(left_w, left_c)})
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


VERDICT_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   "base_failed", "n_lines_removed", "n_words_left", "depleted", "kept"]


def verdicts(docs: DataFrame, host: str = "source", text: str = "text",
             doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, the base features, what the frequent lines
    took, depleted and kept. Texts are read twice and never shuffled."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("source"),
                    F.col(text).alias("text"))
    features, gone = _features_and_gone(d, "source", "text")
    return _judged(features.drop("text"), gone.drop("_lf_gone")).select(
        "doc_id", *VERDICT_COLUMNS)


def clean(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents kept, without their frequent lines; all columns stay (a
    text that loses no line is unchanged byte for byte)."""
    names = docs.columns
    own = docs.select(*[F.col(c).alias(f"_lf_own_{i}") for i, c in enumerate(names)],
                      F.col(host).alias("source"), F.col(text).alias("text"))
    judged = _judged(*_features_and_gone(own, "source", "text"))
    parts = F.split("text", "\n")
    stay = F.filter(parts, lambda x: ~F.array_contains(
        "_lf_gone", F.xxhash64(F.trim(normalised(x), F.lit(WHITE_CHARS))))
        | (F.trim(x, F.lit(WHITE_CHARS)) == ""))
    cleaned = F.when(F.col("_lf_rl").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    return judged.filter("kept").withColumn("_lf_clean", cleaned).select(*[
        (F.col("_lf_clean") if c == text else F.col(f"_lf_own_{i}")).alias(c)
        for i, c in enumerate(names)])
