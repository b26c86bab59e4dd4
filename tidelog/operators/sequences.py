"""De-duplication by producer sequence (M5 without state per id).

A producer numbers its records per partition; a retry sends the same number
again. What has been received is then a few ranges per (producer, topic,
partition): their number follows the gaps, not the records, and they are the
whole state between runs. Records carry ``producer``, ``topic``, ``partition``,
``sequence`` and ``offset`` (where they arrived).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..log import TP, materialize, small
from ..scan import dense_position, running_max

BY = ["producer", *TP]
RANGES_SCHEMA = "producer string, topic string, partition int, first long, last long"


def received(records: DataFrame) -> DataFrame:
    """The ranges of sequence numbers received: producer, topic, partition,
    first, last. A number less its rank among the distinct ones is the same
    within a range; ranks come from range partitions, so a producer that sent a
    third of all records is no single task."""
    numbers = records.select(*BY, "sequence").distinct()
    ranked = dense_position(numbers, BY, ["sequence"], "_sq_rank")
    return (ranked.groupBy(*BY, (F.col("sequence") - F.col("_sq_rank")).alias("_sq_range"))
            .agg(F.min("sequence").alias("first"), F.max("sequence").alias("last"))
            .select(*BY, "first", "last"))


def merged(ranges: DataFrame, more: DataFrame) -> DataFrame:
    """Ranges put together: those that overlap or touch become one. Rows are
    ranges, so a window of one producer's partition is small."""
    both = ranges.select(*BY, "first", "last").unionByName(more.select(*BY, "first", "last"))
    earlier = Window.partitionBy(*BY).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*BY).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    starts = both.withColumn("_sq_before", F.max("last").over(earlier)).withColumn(
        "_sq_new", (F.col("_sq_before").isNull() | (F.col("first") > F.col("_sq_before") + 1)).cast("int"))
    return (starts.withColumn("_sq_range", F.sum("_sq_new").over(upto))
            .groupBy(*BY, "_sq_range").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .drop("_sq_range"))


def accepted(records: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """The records without retries: of each sequence number the first that
    arrived, and none that is in ``seen`` (ranges of earlier runs). ``late`` is
    set where an earlier arrival of the producer's partition has a larger number
    (reordering). Whole records aren't grouped: first arrivals are found by
    position, and records are kept by it."""
    places = records.select(*BY, "sequence", "offset")
    if seen is not None:
        known, rows = materialize(seen.select(*BY, F.col("first").alias("_sq_a"), F.col("last").alias("_sq_b")))
        places = places.join(small(known, rows), [
            *[places[c].eqNullSafe(known[c]) for c in BY],
            F.col("sequence").between(F.col("_sq_a"), F.col("_sq_b"))], "left_anti")
    first = places.groupBy(*BY, "sequence").agg(F.min("offset").alias("offset"))
    largest = running_max(first, BY, ["offset"], "sequence", "_sq_before")
    kept = largest.select(*TP, "offset", F.coalesce(
        F.col("sequence") < F.col("_sq_before"), F.lit(False)).alias("late"))
    return records.join(kept, [*TP, "offset"])


def missing(ranges: DataFrame) -> DataFrame:
    """The gaps between a producer's ranges: producer, topic, partition,
    first_missing, last_missing."""
    after = Window.partitionBy(*BY).orderBy("first")
    return (ranges.withColumn("_sq_next", F.lead("first").over(after))
            .filter("_sq_next IS NOT NULL")
            .select(*BY, (F.col("last") + 1).alias("first_missing"), (F.col("_sq_next") - 1).alias("last_missing")))
