"""Small tables with every awkward case, and readers for brute-force checks."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def edge_rows():
    """(doc_id, text, lang, source): nulls, empty and white texts, a very long
    one, copies, near copies, repeated rows and ids, shared lines."""
    rnd = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "kalo teri suvi mento brag eño über".split() for b in "an er is ou te".split()]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = "\n".join(line(15) for _ in range(4))
    common = "This Common Line is in many of the documents "
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n \x0b", None, None), (4, base, "en", "a"),
            (5, base, "en", "b"), (6, base, "de", "a"), (7, base.replace("kaloan", "kaloen", 1), "en", "a"),
            (8, "\n".join(line(12) for _ in range(900)), "fr", "c"), (9, "one", "en", None),
            (10, common + "\n" + line(30), "en", "a"), (11, line(30) + "\n" + common.upper() + "\n" + line(5), "en", "b"),
            (12, common.strip() + "\n" + common + "\nshort\nshort", "es", "b"), (13, "ÀB é\n" + "ÀB É STRASSE LINE\n" + "àb é strasse line", "de", "c"),
            (14, "àB É strasse line", "de", "c"), (15, "9 10 8 !!", "en", "a"), (16, "\n\n\n", "en", "a"),
            (None, line(40), "en", "a"), (None, None, None, "b"), (17, line(20), "en", "a"), (17, line(20), "en", "a"),
            (20, "a b c d e f " * 3 + line(20), "en", "a"), (21, "x " * 40, "en", "c"), (22, line(3), "en", "a")]
    rows += [(18, "repeated row " + base, "en", "b")] * 3
    for i in range(30, 70):
        rows.append((i, common + "\n" + line(rnd.randint(3, 60)) + "\n" + line(8), "en" if i % 3 else "fr", "a" if i % 2 else "b"))
    return rows


#: Names that operators could use themselves.
CLASHING = ["size", "start", "part", "guest", "pos", "n", "h", "fp", "gram", "length", "position",
            "kept", "n_lines", "n_dropped", "dropped_runs", "kept_text", "n_words", "component_id",
            "fingerprint", "sequence_id", "offset", "taken", "target", "score", "threshold", "row"]


def edge_docs(spark, clashing=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.char_length("text").cast("long"))
    if clashing:
        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
    return df


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def sf_docs(spark, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/documents.parquet")


def key(v):
    return (v is not None, v if v is not None else 0)
