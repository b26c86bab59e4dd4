"""A training corpus from `documents` in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and read again as the next one's documents. All but the last
return the columns of documents, with n_chars of the text as it then is:

1. quality rules: rejected documents go, frequent lines are cut from the others;
2. line dedup: repeated lines stay in the first document only;
3. SimHash near-dedup: the document of the smallest id stays of each group;
4. mixing: documents in training order, as often as their source's target asks;
5. best-fit packing: one row for each piece with its sequence and offset; the
   sequences are numbered in training order.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm import curriculum, line_dedup, line_frequency, packing, simhash
from tidelog.session import new_folder


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_frequency.clean(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.cleaned(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mixed_documents(docs)


def in_written_order(docs: DataFrame) -> DataFrame:
    """The documents with ``_position``, their place in the order they were
    written in (files, then rows): the mixing stage has no column for it.
    Documents that were not read from files are in no order: all 0."""
    try:
        placed = docs.withColumns({
            "_file": F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long"),
            "_row": F.col("_metadata.row_index")})
    except AnalysisException:
        return docs.withColumn("_position", F.lit(0))
    # One row a file.
    sizes = placed.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(bases), "_file").withColumn("_position", F.col("_base") + F.col("_row"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(in_written_order(docs), position=F.col("_position"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("best-fit packing", best_fit_packing),
]

#: SimHash, the tokenizer and the packing plan can't be said in SQL; the stages
#: are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
