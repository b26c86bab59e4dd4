"""Incremental compaction (M2): a cleaned head and the log's tail.

The head holds the latest record of every (topic, partition, key) up to the
cleaned offsets, without deletion markers, in hash buckets of the key, each
sorted by key. A step takes the tail (the records between the cleaned offsets
and the log's ends), finds each key's last record there, and rewrites only the
buckets that one of these keys falls in; the other buckets stay the files they
are. The result equals ``maintenance.compact`` of the whole log.

    heads/<id>/bucket=<b>/    buckets as written by one step
    cleaned/<id>/             topic, partition, end_offset: where the head ends
    versions/<n>.json         the step's commit: which step wrote each bucket

A step that is lost before its commit has changed nothing. Buckets double when
they hold more than ``BUCKET_ROWS`` rows on average.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import commits
from ..committed import CommittedLog
from ..log import BROADCAST_ROWS, LOG_COLUMNS, LOG_SCHEMA, TP, materialize, pin_small, small
from .ends import log_ends

KEY = [*TP, "key"]
BUCKETS = 16
BUCKET_ROWS = 4_000_000


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(n)).cast("int")


def _heads(spark: SparkSession, path: str, state: dict, buckets: list[int]) -> DataFrame:
    """The head's records in the given buckets."""
    folders = [f"{path}/heads/{state['heads'][str(b)][0]}/bucket={b}" for b in buckets if str(b) in state["heads"]]
    if not folders:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(*folders).select(*LOG_COLUMNS)


def compacted(spark: SparkSession, path: str) -> DataFrame:
    """The head: the latest record per topic, partition and key as of the last
    step."""
    state = commits.latest(spark, f"{path}/versions")
    if state is None:
        return spark.createDataFrame([], LOG_SCHEMA)
    return _heads(spark, path, state, list(range(state["buckets"])))


def compact_step(spark: SparkSession, path: str, log: DataFrame | CommittedLog,
                 buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> list[int]:
    """Clean the log's tail into the head at ``path``; returns the buckets that
    were rewritten. A committed log is read by its index: only the files that
    the tail is in."""
    path = path.rstrip("/")
    state = commits.latest(spark, f"{path}/versions") or {
        "version": -1, "buckets": buckets, "heads": {}, "cleaned": None}
    ends = log.ends() if isinstance(log, CommittedLog) else log_ends(log)
    last, _ = pin_small(ends.select(*TP, "end_offset"), "topic string, partition int, end_offset long")
    starts = last.select(*TP, F.lit(0).cast("long").alias("start_offset"))
    if state["cleaned"]:
        before = spark.read.parquet(f"{path}/cleaned/{state['cleaned']}")
        starts = last.join(before.withColumnRenamed("end_offset", "start_offset"), TP, "left").select(
            *TP, F.coalesce("start_offset", F.lit(0)).alias("start_offset"))
    starts, _ = pin_small(starts, "topic string, partition int, start_offset long")
    records = log.read_from(starts) if isinstance(log, CommittedLog) else log
    tail = (records.join(starts, TP).join(last, TP)
            .filter((F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("end_offset"))
                    & F.col("key").isNotNull()).select(*LOG_COLUMNS))
    # Keys and offsets only: a hot key sends one row a task.
    winners, n = materialize(tail.groupBy(*KEY).agg(F.max("offset").alias("offset")))
    total = sum(rows for _, rows in state["heads"].values())
    target, touched = state["buckets"], None
    while total > 2 * bucket_rows * target:
        target *= 2
    if target == state["buckets"]:
        touched = sorted(r.b for r in winners.select(_bucket(target).alias("b")).distinct().collect())
    old = list(range(state["buckets"])) if touched is None else touched
    if n <= BROADCAST_ROWS:
        new = tail.join(F.broadcast(winners.select(*TP, "offset")), [*TP, "offset"], "left_semi")
    else:      # one candidate of a key and task moves
        new = tail.groupBy(*KEY).agg(F.max_by(F.struct("value", "offset", "timestamp"), "offset").alias("_c")).select(
            *KEY, "_c.*")
    kept = _heads(spark, path, state, old).join(small(winners.select(*KEY), n), KEY, "left_anti")
    merged = kept.unionByName(new.filter("value IS NOT NULL").select(*LOG_COLUMNS)).withColumn(
        "bucket", _bucket(target))
    name = uuid.uuid4().hex
    (merged.repartition("bucket").sortWithinPartitions("bucket", *KEY)
     .write.partitionBy("bucket").parquet(f"{path}/heads/{name}"))
    sizes = {}
    if old:
        written = spark.read.schema("bucket int, offset long").parquet(f"{path}/heads/{name}")
        sizes = {str(r["bucket"]): [name, r["count"]] for r in written.groupBy("bucket").count().collect()}
    heads = {} if touched is None else {b: h for b, h in state["heads"].items() if int(b) not in touched}
    cleaned = uuid.uuid4().hex
    last.write.parquet(f"{path}/cleaned/{cleaned}")
    commits.commit(spark, f"{path}/versions", state["version"] + 1, {
        "version": state["version"] + 1, "buckets": target, "heads": heads | sizes, "cleaned": cleaned})
    return touched if touched is not None else list(range(target))
