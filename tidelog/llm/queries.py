"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bottomk, centroid_langid, curriculum, line_dedup, line_frequency, ngram_lm,
               packing, periodic_runs, piece_bpe, simhash, spelling, toxicity, url_filter)
from .common import table
from .oracle import ORACLE_SQL  # noqa: F401 - of the queries that SQL can express


def op1_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                               by_symbols=True)


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.verdicts(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op5_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mixture(table(spark, sf_dir, "documents"))


def op6_bottomk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.sketch_pairs(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"),
                      F.array_join(F.transform("dropped_runs", lambda r: F.concat(
                          r["from"].cast("string"), F.lit("-"), r["to"].cast("string"))), ",").alias("dropped_runs"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_centroid_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_langid.identified(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_kneser_ney_quality, op2_line_frequency, op3_url_filter, op4_best_fit_packing, op5_curriculum_mixing,
    op6_bottomk_fingerprints, op7_line_dedup, op8_toxicity, op9_centroid_langid,
    op10_simhash_near_dedup, op11_spelling_variants, op12_sentencepiece, op13_periodic_runs)}
