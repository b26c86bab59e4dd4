"""Keyed state and aggregation (A1-A4), batch forms. The live forms are in
``tidelog.streaming``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scan import dense_position
from .maintenance import partition_for


def rekey(df: DataFrame, field: str, n: int = 3, method: str = "murmur3") -> DataFrame:
    """A1: re-publish records keyed by ``field`` so every record of one key
    lands in one partition of the re-keyed topic. Within Spark a later
    ``groupBy(field)`` shuffles by itself; an explicit
    ``repartition(n, partition)`` belongs only in front of a write."""
    return (df.withColumn("key", F.encode(F.col(field).cast("string"), "UTF-8"))
              .withColumn("partition", partition_for(F.col(field).cast("string"), n, method)))


def count_by_key(df: DataFrame, field: str, name: str = "count") -> DataFrame:
    """A2: the table of counts per key (partial counts before the shuffle,
    so a hot key costs one row per task)."""
    return df.groupBy(field).agg(F.count(F.lit(1)).alias(name))


def running_count(df: DataFrame, field: str, order: list[str],
                  name: str = "count") -> DataFrame:
    """A3: per event, the count of its key as it stood after that event.

    The 1-based rank of the event inside its key in ``order``; computed by
    ``dense_position``, which spreads a hot key over range partitions instead
    of ordering it in one task."""
    out = dense_position(df, [field], order, "_rc_pos")
    return out.withColumn(name, F.col("_rc_pos") + 1).drop("_rc_pos")


def lookup_count(counts: DataFrame, keys: DataFrame, field: str,
                 name: str = "count") -> DataFrame:
    """A4: read the table for some keys; a key never seen reads 0."""
    return (keys.select(field).join(counts.select(field, name), field, "left")
            .select(field, F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)))
