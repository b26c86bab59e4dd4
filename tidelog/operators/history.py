"""The count table after each update (K6), as a change log with versions.

Update v of the table is the v-th event in order; it sets its key's count. The
change log has one row per update, in blocks of ``every`` updates, and a stored
version of the whole table at the start of each block. The table after any
update is the stored version of its block and the block's changes up to it, so
no more than a version and a block are read.

    changes/block=<b>/    version, key, count
    tables/block=<b>/     key, count: the table before the block's first update
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scan import dense_position
from .state import running_count


def table_changes(events: DataFrame, field: str, order: list[str], name: str = "count") -> DataFrame:
    """The events with ``version`` (from 1, in ``order``) and the key's count
    after the event: the table's change log."""
    counted = running_count(events, field, order, name)
    return dense_position(counted, [], order, "_hs_at").withColumn("version", F.col("_hs_at") + 1).drop("_hs_at")


def save_history(events: DataFrame, field: str, order: list[str], path: str, every: int) -> None:
    """Store the change log and a version of the table every ``every`` updates.
    A stored version has one row per key seen, so with ``every`` at least the
    number of keys, all versions together have no more rows than the log."""
    block = F.floor((F.col("version") - 1) / F.lit(int(every))).cast("long")
    changes = table_changes(events.select(*dict.fromkeys([field, *order])), field, order).select(
        "version", field, "count", block.alias("block"))
    changes.repartition("block").sortWithinPartitions("block", "version").write.partitionBy("block").parquet(
        f"{path}/changes")
    stored = events.sparkSession.read.schema(
        changes.drop("block").schema.add("block", "long")).parquet(f"{path}/changes")
    last = stored.groupBy(field, "block").agg(F.max("count").alias("count"))
    end = stored.agg(F.max("block")).first()[0]
    # A key's count stands from the block after its change to that of its next one.
    following = Window.partitionBy(field).orderBy("block")
    spans = (last.withColumn("_hs_next", F.coalesce(F.lead("block").over(following), F.lit(end)))
             .filter(F.col("_hs_next") > F.col("block")))
    tables = spans.select(field, "count", F.explode(F.sequence(F.col("block") + 1, "_hs_next")).alias("block"))
    tables.repartition("block").write.partitionBy("block").parquet(f"{path}/tables")


def table_at(spark: SparkSession, path: str, field: str, version: int, every: int) -> DataFrame:
    """The whole table after update ``version`` (from 1; beyond the last update,
    after that)."""
    log = spark.read.parquet(f"{path}/changes")
    block = min((version - 1) // every, log.agg(F.max("block")).first()[0])      # folder names only
    changes = log.filter((F.col("block") == block) & (F.col("version") <= version)).select(field, "count")
    if block == 0:
        return changes.groupBy(field).agg(F.max("count").alias("count"))
    tables = spark.read.parquet(f"{path}/tables").filter(F.col("block") == block).select(field, "count")
    return changes.unionByName(tables).groupBy(field).agg(F.max("count").alias("count"))


def table_snapshots(events: DataFrame, field: str, instants: list[datetime], time_col: str = "timestamp",
                    name: str = "count") -> DataFrame:
    """The whole table at each instant (updates at or before it), from one scan:
    events are counted per key and interval, and summed over the intervals."""
    at = sorted(instants)
    moments = F.array(*[F.lit(t).cast("timestamp") for t in at])
    first = F.size(F.filter(moments, lambda m: m < F.col(time_col)))      # instants it comes after
    per = (events.filter(F.col(time_col) <= F.lit(at[-1]).cast("timestamp"))
           .groupBy(field, first.alias("_hs_i")).agg(F.count(F.lit(1)).alias(name)))
    spread = per.select(field, name, F.explode(F.sequence(F.col("_hs_i"), F.lit(len(at) - 1))).alias("_hs_i"))
    return spread.groupBy(F.get(moments, F.col("_hs_i")).alias("at"), field).agg(F.sum(name).alias(name))
