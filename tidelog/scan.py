"""Running totals and dense positions over any number of rows.

``running_total`` range-partitions rows by group and order, so a group that
holds a third of the rows spans a third of the partitions; each range partition
is summed on its own, and a small table of (partition, group) totals,
running-summed per group, gives every partition its base.

``dense_position`` moves each row once. Groups with more rows than a task should
hold (there are at most ``HOT_PARTS`` of them a partition, by count) are sorted
in range partitions and written; a row's place in its file, which the reader
knows, less that of the group's first row there, is its rank in the partition,
so only the bases are joined, as a broadcast of proven size. All other groups
are numbered in the one hash partition they are moved to.

Nulls, strings, ties and descending sizes need no special case: the order is
Spark's own (nulls first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import new_folder, stored

#: Hot groups: those of more than rows / (HOT_PARTS * partitions) rows, and of
#: more than any one task can be given.
HOT_PARTS = 4
TASK_ROWS = 1 << 16


def running_total(df: DataFrame, by: list[str], order: list[str],
                  value: str | Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one in its
    ``by`` group (0 for the first), in ``order``; ties in an order of their own."""
    zero = F.lit(0).cast("long")
    return _running(df, by, order, value, name, F.sum, lambda base, own: F.coalesce(base, zero) + F.coalesce(own, zero))


def running_max(df: DataFrame, by: list[str], order: list[str],
                value: str | Column, name: str) -> DataFrame:
    """Add ``name``: the largest ``value`` of the rows before this one in its
    ``by`` group (null for the first), in ``order``."""
    return _running(df, by, order, value, name, F.max, lambda base, own: F.greatest(base, own))


def _running(df: DataFrame, by: list[str], order: list[str], value: str | Column, name: str,
             fold: Callable[[str], Column], both: Callable[[Column, Column], Column]) -> DataFrame:
    """The ranged rows are written to the shared checkpoint folder once: their
    partition numbers must not change when a lost task is computed again.
    Working columns have a ``_scan_`` prefix."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(value) if isinstance(value, str) else value
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    keyed = df.withColumns({"_scan_group": group, "_scan_value": value})
    ranged = stored(keyed.repartitionByRange(n, "_scan_group", *order)
                    .withColumn("_scan_part", F.spark_partition_id()))
    keys = ["_scan_part", "_scan_group"]
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_scan_in", fold("_scan_value").over(before))
    earlier = Window.partitionBy("_scan_group").orderBy("_scan_part").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = (ranged.groupBy(*keys).agg(fold("_scan_value").alias("_scan_sum"))
             .select(*keys, fold("_scan_sum").over(earlier).alias("_scan_base")))
    return (inside.join(bases, keys)
            .withColumn(name, both(F.col("_scan_base"), F.col("_scan_in")))
            .drop(*keys, "_scan_value", "_scan_in", "_scan_base"))


def dense_position(df: DataFrame, by: list[str], order: list[str],
                   name: str = "position", few_groups: bool = False) -> DataFrame:
    """Add ``name``: the 0-based rank of each row inside its ``by`` group; ties
    in an order of their own. With ``few_groups`` (their number is known to be
    small, like topic partitions) all groups take the ranged path, and no counts
    are taken first."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if few_groups or not by:
        return _ranged_position(df, by, order, name, n)
    keyed = df.withColumn("_scan_group", F.struct(*by))
    sizes = stored(keyed.groupBy("_scan_group").agg(F.count(F.lit(1)).alias("_scan_n")))
    limit = max(TASK_ROWS, (sizes.agg(F.sum("_scan_n")).first()[0] or 0) // (HOT_PARTS * n))
    # At most HOT_PARTS * n groups are larger than that.
    hot = sizes.filter(F.col("_scan_n") > limit).select("_scan_group")
    if hot.isEmpty():
        return _hashed_position(df, by, order, name)
    on = F.struct(*by).eqNullSafe(F.col("_scan_group"))
    cold = _hashed_position(df.join(F.broadcast(hot), on, "left_anti"), by, order, name)
    return cold.unionByName(_ranged_position(
        df.join(F.broadcast(hot), on, "left_semi"), by, order, name, n))


def _hashed_position(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, rank.cast("long") - 1)


def _ranged_position(df: DataFrame, by: list[str], order: list[str], name: str, n: int) -> DataFrame:
    spark = df.sparkSession
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    ranged = (df.withColumn("_scan_group", group)
              .repartitionByRange(n, "_scan_group", *order)
              .sortWithinPartitions("_scan_group", *order)
              .withColumn("_scan_part", F.spark_partition_id()))
    path = new_folder(spark, "ranged")
    # One file a partition, so that a row's place in its file is its place in it.
    ranged.write.option("maxRecordsPerFile", 0).parquet(path)
    keys = ["_scan_part", "_scan_group"]
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn("_scan_at", F.col("_metadata.row_index"))
    earlier = Window.partitionBy("_scan_group").orderBy("_scan_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = rows.groupBy(*keys).agg(F.min("_scan_at").alias("_scan_first"), F.count(F.lit(1)).alias("_scan_n"))
    # A partition has rows of few groups here: at most n + the number of groups.
    bases = parts.select(*keys, (F.coalesce(F.sum("_scan_n").over(earlier), F.lit(0))
                                 - F.col("_scan_first")).alias("_scan_base"))
    return (rows.join(F.broadcast(stored(bases)), keys)
            .withColumn(name, F.col("_scan_base") + F.col("_scan_at"))
            .drop(*keys, "_scan_at", "_scan_base"))
