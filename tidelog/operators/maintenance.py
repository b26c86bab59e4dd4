"""Topic maintenance (M1-M5): retention, compaction, placement, stats,
de-duplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.murmur2 import murmur2_partition
from ..log import TP, bounds


def _instant(now: str | datetime | Column) -> Column:
    if isinstance(now, Column):
        return now.cast("timestamp")
    if isinstance(now, datetime):
        return F.lit(now).cast("timestamp")
    return F.to_timestamp(F.lit(now))


# --- M1 ---------------------------------------------------------------------

def apply_retention(log: DataFrame, retention_ms: int,
                    now: str | datetime | Column | None = None) -> DataFrame:
    """Drop records older than ``retention_ms`` at ``now`` (default: the
    query's start time). The bound folds to a constant, which Parquet scans
    push down."""
    if now is None:
        now = F.current_timestamp()
    cutoff = F.timestamp_micros(F.unix_micros(_instant(now)) - F.lit(int(retention_ms) * 1000))
    return log.filter(F.col("timestamp") >= cutoff)


# --- M2 ---------------------------------------------------------------------

def compact(log: DataFrame) -> DataFrame:
    """Latest record per (topic, partition, key); a latest null value is a
    deletion marker and removes the key. Records without a key cannot be
    compacted and are left out.

    The largest offset of each key is a hash aggregate of fixed width (a hot
    key sends one row per task); the winners are joined back by position, so
    values are neither aggregated nor sorted by key."""
    last = (log.filter(F.col("key").isNotNull())
            .groupBy("topic", "partition", "key").agg(F.max("offset").alias("offset"))
            .select(*TP, "offset"))
    kept = log.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    return kept.join(last, [*TP, "offset"], "left_semi").select(
        "key", "value", "topic", "partition", "offset", "timestamp")


# --- M3 ---------------------------------------------------------------------

PLACEMENTS = ("murmur2", "murmur3", "md5")


def partition_for(key: Column, n: int = 3, method: str = "murmur3",
                  spread: Column | None = None) -> Column:
    """Partition of a key: the same key always gets the same partition.

    ``murmur3`` (the default) is Spark's ``hash``, inside the plan; ``md5`` is
    portable to SQL engines (used by the oracle); ``murmur2`` is a producer
    client's placement of keyed records (``positive(murmur2(key)) % n``, a
    vectorized Pandas UDF over the keys only), for records that must land
    where such a producer would put them. A null key is spread by the hash of
    ``spread`` (the value, in ``write_topic``) so keyless records do not pile
    onto one partition; unlike the producer's random choice this is
    repeatable."""
    other = F.pmod(F.xxhash64(spread), F.lit(n)) if spread is not None else F.lit(0)
    if method == "murmur2":
        placed = murmur2_partition(key, n)
    elif method == "murmur3":
        placed = F.pmod(F.hash(key), F.lit(n))
    elif method == "md5":
        def _md5(c: Column) -> Column:
            return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % F.lit(n)
        placed = _md5(key)
    else:
        raise ValueError(f"unknown partitioner: {method}")
    return F.when(key.isNotNull(), placed).otherwise(other).cast("int")


def assign_partition(df: DataFrame, key: str = "key", n: int = 3,
                     method: str = "murmur3", spread: str | None = None,
                     out: str = "partition") -> DataFrame:
    return df.withColumn(out, partition_for(
        F.col(key), n, method, F.col(spread) if spread else None))


# --- M4 ---------------------------------------------------------------------

def topic_stats(log: DataFrame) -> DataFrame:
    """Per topic partition: records, offset bounds and time span."""
    return log.groupBy(*TP).agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("start_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.min("timestamp").cast("timestamp_ntz").alias("first_timestamp"),
        F.max("timestamp").cast("timestamp_ntz").alias("last_timestamp"),
    )


def list_topics(log: DataFrame) -> DataFrame:
    """Topics with their partition count and record count."""
    return bounds(log).groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("records").alias("records"))


# --- M5 ---------------------------------------------------------------------

def dedupe(df: DataFrame, ids: list[str] | None = None,
           order: list[str] | None = None) -> DataFrame:
    """One row per record despite retries or replays.

    With the default id (topic, partition, offset) copies are identical, so
    any one is kept. With a payload id, the first written copy is kept
    (smallest ``order``, default timestamp then position), so the result
    does not depend on task order. ``min_by`` aggregates partially, so a
    record retried many times costs one row per task in the shuffle."""
    if not ids or ids == ["topic", "partition", "offset"]:
        return df.dropDuplicates(["topic", "partition", "offset"])
    rest = [c for c in df.columns if c not in ids]
    order = order or [c for c in ("timestamp", "topic", "partition", "offset")
                      if c in df.columns]
    order = F.struct(*[F.col(c) for c in order])
    first = df.groupBy(*ids).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*ids, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(
        *df.columns)


__all__ = ["apply_retention", "compact", "partition_for", "assign_partition",
           "topic_stats", "list_topics", "dedupe"]
