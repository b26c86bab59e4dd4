"""Registered queries that run the live forms: the greetings log is
published in three time-ordered parts, and after each part the streaming
query restarts from its checkpoint with ``availableNow`` (the incremental-run
pattern), so state is carried across runs and micro-batches. The results
must equal the batch queries' (same SQL oracle)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..committed import CommittedLog
from ..log import LOG_COLUMNS, LOG_SCHEMA, record_view
from ..operators import serde as C
from ..session import checkpoint_dir
from ..sinks.writes import accepted
from ..sources import generators as G
from ..streaming import live as L
from . import fixtures as fx

PARTS = 3
REPUBLISH_EPOCH_S = 1706745600              # 2024-02-01T00:00:00Z


@contextmanager
def _state_partitions(spark: SparkSession):
    """A stateful query fixes its state partitions (the session's shuffle
    partitions) at its first start; size them to the cores the cluster has
    for this harness, only while the query starts (streaming clones the
    session conf at start)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _time_parts(log: DataFrame) -> tuple[int, int]:
    """First second and length of the parts of a log's time."""
    t = F.unix_seconds("timestamp")
    lo, hi = log.agg(F.min(t), F.max(t)).first()
    return lo, (hi - lo) // PARTS + 1


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tidelog-live/{what}-{uuid.uuid4().hex}"


def _publish_in_parts(spark: SparkSession, d: str, path: str):
    """Yield after each part of the greetings log is appended at ``path``
    (parts are ranges of the log's time, so later parts hold later events)."""
    log = fx.greetings_log(spark, d)
    t = F.unix_seconds("timestamp")
    lo, step = _time_parts(log)
    for k in range(PARTS):
        part = log.filter((t >= lo + k * step) & (t < lo + (k + 1) * step))
        part.select(*LOG_COLUMNS).write.mode("append").parquet(path)
        yield k


def live_count_greetings(spark: SparkSession, d: str) -> DataFrame:
    """A2 + K6 live: the complete count table, replaced at every batch."""
    root = _scratch(spark, "counts")
    path, out = f"{root}/log", f"{root}/table"
    name = f"live_counts_{uuid.uuid4().hex}"

    def replace_table(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    for _ in _publish_in_parts(spark, d, path):
        items = accepted(C.items(L.log_stream(spark, path), C.GREETING))
        with _state_partitions(spark):
            q = (L.live_counts(items, "greeter").writeStream.queryName(name)
                 .outputMode("complete")
                 .option("checkpointLocation", f"{root}/checkpoint")
                 .foreachBatch(replace_table).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out)


def live_running_count(spark: SparkSession, d: str) -> DataFrame:
    """A3 live: per event the greeter's count after it, from state kept
    across runs."""
    root = _scratch(spark, "running")
    path, out = f"{root}/log", f"{root}/events"
    name = f"live_running_{uuid.uuid4().hex}"
    for _ in _publish_in_parts(spark, d, path):
        items = accepted(C.items(L.log_stream(spark, path), C.GREETING))
        live = L.running_count_stream(items.select("partition", "offset", "timestamp", "greeter"),
                                      "greeter", ["timestamp", "partition", "offset"])
        with _state_partitions(spark):
            q = (live.writeStream.queryName(name).outputMode("append").format("parquet")
                 .option("path", out).option("checkpointLocation", f"{root}/checkpoint")
                 .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out).select("partition", "offset", "greeter", "count")


def live_running_count_split(spark: SparkSession, d: str) -> DataFrame:
    """A3 live, hot keys split inside each micro-batch: ranking per batch
    plus a totals table per batch id."""
    root = _scratch(spark, "running-split")
    path, out = f"{root}/log", f"{root}/events"
    name = f"live_running_split_{uuid.uuid4().hex}"
    for _ in _publish_in_parts(spark, d, path):
        items = accepted(C.items(L.log_stream(spark, path), C.GREETING))
        q = L.running_count_batches(
            items.select("partition", "offset", "timestamp", "greeter"), name, "greeter",
            ["timestamp", "partition", "offset"], out, f"{root}/totals", available_now=True)
        q.awaitTermination()
    return spark.read.parquet(out).select("partition", "offset", "greeter", "count")


def live_read_from_latest(spark: SparkSession, d: str) -> DataFrame:
    """S2 live: a reader starts when the first part is there, and restarts after
    each later one; what came while it was down is read. The start is kept in
    the query's own checkpoint."""
    root = _scratch(spark, "latest")
    path, out, name = f"{root}/log", f"{root}/read", f"live_latest_{uuid.uuid4().hex}"
    for _ in _publish_in_parts(spark, d, path):
        L.start(L.stream_from_latest(spark, path, "greetings"), name, sink="parquet", path=out,
                available_now=True).awaitTermination()
    return record_view(spark.read.schema(LOG_SCHEMA).parquet(out))


def live_incremental_paused(spark: SparkSession, d: str) -> DataFrame:
    """J1 live: after each part a paused run, twice, and then an enabled one; the
    paused runs take what the enabled one then takes, and leave the bookmark."""
    root = _scratch(spark, "paused")
    path, out, job = f"{root}/log", f"{root}/out", f"job{uuid.uuid4().hex}"
    runs = None
    for k in _publish_in_parts(spark, d, path):
        for turn in (1, 2):
            rows = L.run_incremental_live(spark, path, out, job, "paused").select(
                "partition", "offset", F.lit(k).alias("run"), F.lit(f"paused {turn}").alias("mode"))
            runs = rows if runs is None else runs.unionByName(rows)
        L.run_incremental_live(spark, path, out, job, "enabled")
    rows = spark.read.parquet(out).select(
        "partition", "offset", F.lit(-1).alias("run"), F.lit("enabled").alias("mode"))
    return runs.unionByName(rows)


def live_publish_after_retention(spark: SparkSession, d: str) -> DataFrame:
    """K1 live over M1: the people topic, a committed log, loses all its records
    to retention; the generated people are published in three micro-batches
    after its kept ends, and what the first of them published expires before the
    query restarts for the last. The log then holds the other two parts."""
    root = _scratch(spark, "publish")
    path, src, name = f"{root}/log", f"{root}/people", f"live_publish_{uuid.uuid4().hex}"
    log = CommittedLog(spark, path)
    log.append(fx.people_log(spark, d))
    log.retain(0, F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S)))
    people = G.generate_people(fx.table(spark, d, "customer"), id_col="c_custkey")
    people = C.encode_json(people, ["id", "name", "title"]).withColumn(
        "at", F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S) + F.col("seq")))
    people = people.select("seq", F.encode("key", "UTF-8").alias("key"), "value", "at")
    last = people.agg(F.max("seq")).first()[0]
    for k in range(PARTS):
        people.filter(F.floor(F.col("seq") * PARTS / F.lit(last + 1)) == k).write.mode("append").parquet(src)
        if k == PARTS - 1:
            log.retain(0, F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S + -(-(last + 1) // PARTS))))
        L.publish_stream(spark.readStream.schema(people.schema).parquet(src), name, "people", "key", "value",
                         ["seq"], path, method="md5", available_now=True, timestamp="at").awaitTermination()
    return record_view(log.records())
