"""Exact line dedup by range-partitioned line hashes (operator 7).

Every line of at least ``min_chars`` code points (stripped, A-Z lower-cased)
is hashed. The hashes are range-partitioned with a secondary sort by document
and position, and each run of equal hashes is streamed: lines of the run's
first document stay, the others are dropped. The result is one compressed
keep bitmap per document that loses lines (the runs of dropped positions, and
the number of lines), never text; ``apply_bitmaps`` filters texts with it.

A hash of more rows than a partition should hold is range-partitioned in as
many blocks of documents as there are partitions. There are at most lines / threshold such
hashes, so their first documents fit a broadcast of proven size; each block
streams against that first document.

Defined cases: a null or empty text is one empty line; a null doc_id comes
after every other id; rows that repeat a doc_id are the same document to the
rule. Extra columns are carried along; working columns have a ``_ld_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE_CHARS, ascii_lower, partitions, stored, two_hashes

MIN_CHARS = 10
#: Hot hashes: those with more rows than lines / (HOT_PARTS * partitions); at
#: most HOT_PARTS * partitions of them.
HOT_PARTS = 8


def _with_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    a, b = two_hashes(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumns({
        "_ld_doc": F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("id")),
        "_ld_a": a, "_ld_b": b})


def line_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line long enough: hashes, document, text hash, position."""
    lines = F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), "\n")
    rows = _with_keys(docs, doc_id, text).select(
        "_ld_doc", "_ld_a", "_ld_b", F.posexplode(lines).alias("pos", "_ld_raw"))
    rows = rows.withColumn("_ld_line", F.trim("_ld_raw", F.lit(WHITE_CHARS))).filter(
        F.char_length("_ld_line") >= min_chars)
    h1, h2 = two_hashes(F.col("_ld_line"))
    return rows.select(h1.alias("h1"), h2.alias("h2"), "_ld_doc", "_ld_a", "_ld_b", "pos")


def dropped_lines(rows: DataFrame) -> DataFrame:
    """The lines to drop: document, text hashes, position."""
    n_parts = partitions(rows.sparkSession)
    sums = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_ld_n"),
                                        F.min("_ld_doc").alias("_ld_hot_first"))
    threshold = max(1, rows.count() // (HOT_PARTS * n_parts))
    hot = sums.filter(F.col("_ld_n") > threshold).drop("_ld_n")
    spread = F.when(F.col("_ld_hot_first").isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64("_ld_doc"), F.lit(n_parts)).cast("int"))
    ranged = (rows.join(F.broadcast(hot), ["h1", "h2"], "left")
              .withColumn("_ld_block", spread)
              .repartitionByRange(n_parts, "h1", "h2", "_ld_block"))
    run = Window.partitionBy("h1", "h2", "_ld_block").orderBy("_ld_doc", "pos")
    first = F.coalesce("_ld_hot_first", F.first("_ld_doc").over(run))
    return (ranged.withColumn("_ld_first", first)
            .filter(~F.col("_ld_doc").eqNullSafe(F.col("_ld_first")))
            .select("_ld_doc", "_ld_a", "_ld_b", "pos"))


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document that loses lines: its keys, n_dropped and the keep
    bitmap, run-length encoded as the dropped runs [from, to] of positions."""
    rows = stored(line_rows(docs, doc_id, text, min_chars))
    # Equal rows (a repeated doc_id with the same text) give each position twice.
    gone = dropped_lines(rows).groupBy("_ld_doc", "_ld_a", "_ld_b").agg(
        F.sort_array(F.collect_set("pos")).alias("_ld_pos"))
    p = F.col("_ld_pos")
    starts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) < x - 1))
    ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) > x + 1))
    return gone.select(
        "_ld_doc", "_ld_a", "_ld_b", F.size(p).cast("long").alias("n_dropped"),
        F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("from"), b.alias("to"))).alias(
            "dropped_runs"))


def _applied(docs: DataFrame, bitmaps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents with _ld_kept, _ld_lines, _ld_n and _ld_runs."""
    keys = ["_ld_doc", "_ld_a", "_ld_b"]
    d = _with_keys(docs, doc_id, text)
    b = bitmaps.select(*[F.col(k).alias(f"{k}_r") for k in keys],
                       F.col("n_dropped").alias("_ld_n"), F.col("dropped_runs").alias("_ld_runs"))
    on = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
    out = d.join(b, on[0] & on[1] & on[2], "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    out = out.withColumns({"_ld_lines": F.split(whole, "\n"), "_ld_gone": F.flatten(
        F.transform("_ld_runs", lambda r: F.sequence(r["from"], r["to"])))})
    stay = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), "_ld_gone")
    kept = F.when(F.col("_ld_gone").isNull(), whole).otherwise(F.array_join(
        F.transform(stay, lambda i: F.get("_ld_lines", i)), "\n"))
    return out.withColumn("_ld_kept", kept)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """The documents with ``kept_text``, n_lines (before dropping), n_dropped
    and dropped_runs (columns of these names are replaced)."""
    out = _applied(docs, bitmaps, doc_id, text).withColumns({
        "kept_text": F.col("_ld_kept"), "n_lines": F.size("_ld_lines").cast("long"),
        "n_dropped": F.coalesce("_ld_n", F.lit(0).cast("long")), "dropped_runs": F.col("_ld_runs")})
    return out.drop(*[c for c in out.columns if c.startswith("_ld_") and c not in docs.columns])


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents without their repeated lines, in the columns they came with
    (a null text stays null)."""
    out = _applied(docs, keep_bitmaps(docs, doc_id, text, **settings), doc_id, text)
    return out.select(*[
        F.when(F.col(text).isNotNull(), F.col("_ld_kept")).alias(c) if c == text else F.col(c)
        for c in docs.columns])
