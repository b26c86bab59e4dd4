"""The canonical topic-log DataFrame and the position arithmetic around it.

A *log* has the columns of Spark's Kafka source that carry data::

    key binary, value binary, topic string, partition int, offset long,
    timestamp timestamp

so every operator accepts either ``spark.read.format("kafka")`` output or a
Parquet-backed log. Offsets are dense per (topic, partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import utf8_or_null
from .scan import dense_position

LOG_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
])
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]
TP = ["topic", "partition"]

COMMITS_SCHEMA = "group string, topic string, partition int, offset long"

def to_log(df: DataFrame) -> DataFrame:
    """Select and cast the six log columns (extra columns are dropped)."""
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )


def key_string(col: str | Column = "key") -> Column:
    """UTF-8 key bytes as a string (null for a null key and for bad bytes)."""
    return utf8_or_null(col)


def wall_clock(col: str | Column = "timestamp") -> Column:
    """Timestamp as a zone-free wall-clock value for reports and oracles."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")


def record_view(log: DataFrame, *extra: str | Column) -> DataFrame:
    """Plain projection used by reports: position, string key, time."""
    return log.select(
        "topic", "partition", "offset",
        key_string("key").alias("key"),
        wall_clock("timestamp").alias("timestamp"),
        *extra,
    )


def bounds(log: DataFrame) -> DataFrame:
    """topic, partition, start_offset, end_offset (end = last + 1), records.

    A partial aggregate per input split, then one small shuffle of
    (topic, partition) rows, so its cost is one scan of two columns."""
    return log.groupBy(*TP).agg(
        F.min("offset").alias("start_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("records"),
    )


# Small side tables are broadcast only when their
# counted size is at most this many rows; beyond it they are shuffle-joined.
BROADCAST_ROWS = 1 << 20


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Compute a small derived table once and cut its lineage: a reliable
    checkpoint in the shared ``spark.checkpoint.dir`` (so a lost executor
    does not recompute it from the scan). Returns it with its row count
    (read from the checkpoint) for the broadcast check."""
    from .session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    return out, out.count()


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table whose counted size allows it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def with_offsets(df: DataFrame, order: list[str], base: DataFrame | None = None) -> DataFrame:
    """Assign dense offsets per (topic, partition) in ``order``.

    ``base`` (topic, partition, end_offset) continues an existing log."""
    out = dense_position(df, TP, order, "offset", few_groups=True)
    if base is None:
        return out
    b = base.select(*TP, F.col("end_offset").alias("_base_end"))
    return (out.join(b, TP, "left")
            .withColumn("offset", F.col("offset") + F.coalesce("_base_end", F.lit(0)))
            .drop("_base_end"))


# Per-partition tables (start positions, end offsets) up to this many rows
# are collected once, checked with a bounded ``limit``, and used as local
# tables; larger ones are checkpointed.
LOCAL_ROWS = 100_000


def pin_small(df: DataFrame, schema: str | T.StructType) -> tuple[DataFrame, list | None]:
    """Fix a small per-partition table: returns (table, rows). Up to
    ``LOCAL_ROWS`` rows it becomes a broadcast local table built from the
    collected rows (so it is computed once and never re-read from a source
    that may change, e.g. a log about to be appended to); beyond that it is
    checkpointed (rows = None)."""
    rows = df.limit(LOCAL_ROWS + 1).collect()
    if len(rows) <= LOCAL_ROWS:
        return F.broadcast(df.sparkSession.createDataFrame(rows, schema)), rows
    table, n = materialize(df)
    return small(table, n), None
