"""Log ends that outlive the records: ``topic, partition, start_offset, end_offset``.

The bounds of a log's rows forget its end once retention or compaction has
removed the last records, and a publish that continued from them would give
offsets out twice. The ends table keeps what the rows cannot: a publish (K1)
moves the end, retention (M1) moves the start, compaction (M2) moves neither.
It has one row per topic partition, so its size never follows the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..log import TP, bounds

ENDS_SCHEMA = "topic string, partition int, start_offset long, end_offset long"
ENDS_COLUMNS = [*TP, "start_offset", "end_offset"]


def log_ends(log: DataFrame) -> DataFrame:
    """The ends of a log none of whose records was removed yet."""
    return bounds(log).select(*ENDS_COLUMNS)


def with_written(ends: DataFrame, written: DataFrame) -> DataFrame:
    """Ends after a publish: partitions written to end after their last record;
    a partition that is new starts at its first one."""
    return (ends.select(*ENDS_COLUMNS).unionByName(log_ends(written)).groupBy(*TP)
            .agg(F.min("start_offset").alias("start_offset"),
                 F.max("end_offset").alias("end_offset")))


def after_retention(ends: DataFrame, kept: DataFrame) -> DataFrame:
    """Ends after retention left ``kept``: a partition starts at its first record
    left, or at its end when none is."""
    first = bounds(kept).select(*TP, F.col("start_offset").alias("_first"))
    return (ends.join(first, TP, "left")
            .withColumn("start_offset", F.coalesce("_first", "end_offset"))
            .select(*ENDS_COLUMNS))


def save_ends(ends: DataFrame, path: str, version: int) -> None:
    """Keep the ends as version ``version=<n>`` (rewritten if repeated). Write
    them after the records of a publish and before records are removed: a
    crash in between leaves the higher of two ends to be found from the rows."""
    ends.select(*ENDS_COLUMNS).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/version={int(version)}")


def load_ends(spark: SparkSession, path: str) -> DataFrame:
    """The latest ends kept (empty when none were; a failed read raises)."""
    from ..session import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], ENDS_SCHEMA)
    kept = spark.read.parquet(path)
    last = kept.agg(F.max("version")).first()[0]
    return kept.filter(F.col("version") == last).select(*ENDS_COLUMNS)


def known_bounds(log: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """topic, partition, start_offset and end_offset: the log's own bounds, or with
    ``ends`` the kept ones, moved on by records found after them."""
    own = log_ends(log)
    if ends is None:
        return own
    kept = ends.select(*TP, F.col("start_offset").alias("_s"), F.col("end_offset").alias("_e"))
    return own.join(kept, TP, "full").select(
        *TP, F.coalesce("_s", "start_offset").alias("start_offset"),
        F.greatest("end_offset", "_e").alias("end_offset"))
