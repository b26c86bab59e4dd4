"""Live forms with Structured Streaming: reading a topic as it grows (from
the end at start), keyed counts in update/complete mode, per-event running
counts with state, publishing with receipts and dead-letter routing per
micro-batch, de-duplication within a watermark, incremental runs with
``availableNow``, and rate-driven generators and ticks.

Checkpoints go under the shared folder named by ``spark.checkpoint.dir``
(``tidelog.session.checkpoint_dir``), never a machine-local folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import commits
from ..committed import CommittedLog
from ..log import LOG_SCHEMA, TP, bounds, to_log
from ..operators.positions import from_positions
from ..session import checkpoint_dir, new_folder, path_exists
from ..sources import generators as G


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of one named live query, under spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


# --- sources ------------------------------------------------------------------

def log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
               ) -> DataFrame:
    """A Parquet-backed log as a stream: each new file is read once."""
    r = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return to_log(r.parquet(path))


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Spark's Kafka source (needs the connector package on the classpath);
    ``startingOffsets``/``startingTimestamp`` select S1-S5 live."""
    return to_log(spark.readStream.format("kafka").options(**options).load())


@dataclass
class LiveStart:
    """A live read that begins at given positions. ``start`` makes it a stream:
    when the query first starts, its start table (one row per partition) is
    written into its own checkpoint folder, and every restart reads it there, so
    records that came while the query was down are never passed over."""

    spark: SparkSession
    path: str
    topics: list[str]
    starts: Callable[[DataFrame], DataFrame]

    def frame(self, checkpoint: str) -> DataFrame:
        kept = f"{checkpoint}/start"
        of_topics = F.col("topic").isin(self.topics)
        if not path_exists(self.spark, f"{kept}/_SUCCESS"):
            log = self.spark.read.schema(LOG_SCHEMA).parquet(self.path).filter(of_topics)
            self.starts(log).select(*TP, F.col("start_offset").cast("long")).write.mode(
                "overwrite").parquet(kept)
        starts = self.spark.read.schema("topic string, partition int, start_offset long").parquet(kept)
        return from_positions(log_stream(self.spark, self.path).filter(of_topics), starts, default="earliest")


def stream_from_latest(spark: SparkSession, path: str, topic: str) -> LiveStart:
    """S2 live: only records that arrive after the query first starts."""
    return LiveStart(spark, path, [topic], lambda log: bounds(log).select(
        *TP, F.col("end_offset").alias("start_offset")))


def stream_from_offsets(spark: SparkSession, path: str, spec: dict[str, dict[int, int]]) -> LiveStart:
    """S3 live: records at or after the given offset per partition
    (``{topic: {partition: offset}}``, -2 earliest, -1 latest when the query
    first starts); unlisted partitions of a listed topic from their start."""
    from ..sources.topics import EARLIEST, LATEST
    rows = [(t, int(p), 0 if o == EARLIEST else int(o)) for t, parts in spec.items() for p, o in parts.items()]

    def starts(log: DataFrame) -> DataFrame:
        asked = spark.createDataFrame(rows, "topic string, partition int, start_offset long")
        ends = bounds(log).select(*TP, "end_offset")
        at_end = F.coalesce("end_offset", F.lit(0))
        return asked.join(ends, TP, "left").withColumn("start_offset", F.when(
            F.col("start_offset") == LATEST, at_end).otherwise(F.col("start_offset")))

    return LiveStart(spark, path, list(spec), starts)


def stream_from_timestamp(spark: SparkSession, path: str, topic: str, epoch_ms: int) -> LiveStart:
    """S4/S5 live: per partition from the first offset whose timestamp is at
    or after the instant, looked up when the query first starts; a partition
    with no such record then starts at its end."""
    from ..operators.positions import first_at_or_after

    def starts(log: DataFrame) -> DataFrame:
        firsts = first_at_or_after(log, epoch_ms).withColumnRenamed("start_offset", "_first")
        return bounds(log).join(firsts, TP, "left").select(
            *TP, F.coalesce("_first", "end_offset").alias("start_offset"))

    return LiveStart(spark, path, [topic], starts)


def rate_ids(spark: SparkSession, per_batch: int, start_epoch_s: int,
             every_s: int) -> DataFrame:
    """Ids for live generators: ``per_batch`` new ids per micro-batch, event
    time advancing ``every_s`` per batch (``rate-micro-batch``: the rows of a
    batch depend only on the batch number, so a replayed batch is identical).
    Columns ``id`` and ``timestamp``."""
    rate = (spark.readStream.format("rate-micro-batch")
            .option("rowsPerBatch", int(per_batch))
            .option("startTimestamp", int(start_epoch_s) * 1000)
            .option("advanceMillisPerBatch", int(every_s) * 1000).load())
    return rate.select(F.col("value").alias("id"), "timestamp")


def records_stream(spark: SparkSession, per_batch: int = 1, start_epoch_s: int = 0,
                   every_s: int = 1, fields: dict[str, list[str]] | None = None,
                   seed: str = "technologists", key_field: str = G.TECHNOLOGIST_KEY
                   ) -> DataFrame:
    """S9 live: the record generator (technologists by default) fed by
    ``rate_ids``; same picks as the batch form for the same ids."""
    ids = rate_ids(spark, per_batch, start_epoch_s, every_s)
    return ids.select("id", "timestamp", *G.record_columns(fields, seed)).withColumn(
        "key", F.col(key_field))


def greetings_stream(spark: SparkSession, start_epoch_s: int, per_batch: int = 1,
                     every_s: int = G.GREETING_EVERY_S, seed: str = "greetings",
                     form: str = "record") -> DataFrame:
    """S11 live: ``per_batch`` greetings per micro-batch, event time advancing
    ``every_s`` per batch."""
    src = rate_ids(spark, per_batch, start_epoch_s, every_s).withColumnRenamed(
        "timestamp", "_at")
    if form == "record":
        message = F.concat_ws(" ", G.pick(G.GREETING_PREFIXES, f"{seed}.prefix"),
                              G.pick(G.GREETING_RECIPIENTS, f"{seed}.recipient"))
        return src.select("id", message.alias("message"),
                          G.pick(G.GREETERS, f"{seed}.greeter").alias("greeter"),
                          F.col("_at").alias("timestamp"))
    return src.select("id", G.pick(G.GREETING_WORDS, f"{seed}.word").alias("greeting"),
                      F.col("_at").alias("timestamp"))


def ticks_stream(spark: SparkSession, start_epoch_s: int,
                 every_s: int = G.TICK_EVERY_S) -> DataFrame:
    """S12 live: one tick per micro-batch (run it with
    ``trigger(processingTime=f"{every_s} seconds")``)."""
    rate = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1)
            .option("startTimestamp", int(start_epoch_s) * 1000)
            .option("advanceMillisPerBatch", int(every_s) * 1000).load())
    return rate.select((F.col("value") + 1).alias("tick"), F.lit("interval").alias("kind"),
                       F.col("timestamp").alias("at"),
                       F.concat(F.lit("A task executing on interval at "),
                                F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("line"))


# --- keyed state ----------------------------------------------------------------

def live_counts(events: DataFrame, field: str, name: str = "count") -> DataFrame:
    """A2 live: counts per key; write in ``update`` mode for changed keys per
    batch or ``complete`` mode for the whole table (K6)."""
    return events.groupBy(field).agg(F.count(F.lit(1)).alias(name))


def _packed(rows: pd.DataFrame) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue()


def _running(batches: Iterator[pd.DataFrame], state: GroupState,
             order: list[str], name: str) -> Iterator[pd.DataFrame]:
    """Counts of one key's rows of a micro-batch. They come in chunks: only the
    order columns are put together and sorted, the chunks wait compressed, and
    each is given out with its rows' ranks (nulls first, like Spark's order)."""
    total = state.get[0] if state.exists else 0
    keys, chunks = [], []
    for rows in batches:
        keys.append(rows[order].reset_index(drop=True))
        chunks.append(_packed(rows))
    ordered = pd.concat(keys, ignore_index=True).sort_values(order, kind="mergesort", na_position="first").index
    count = np.empty(len(ordered), np.int64)
    count[ordered] = np.arange(total + 1, total + len(ordered) + 1)
    state.update((total + len(ordered),))
    lo = 0
    for chunk, key in zip(chunks, keys):
        rows = pa.ipc.open_stream(chunk).read_pandas()
        rows[name] = count[lo:lo + len(key)]
        lo += len(key)
        yield rows


def running_count_stream(events: DataFrame, field: str, order: list[str],
                         name: str = "count") -> DataFrame:
    """A3 live: each event with its key's count after it. Per key the state
    is one number; rows of a micro-batch are ordered by ``order`` inside the
    processor (arrival order is not trusted), in chunks of which only the order
    columns are held together. A key's rows of one batch are one task's work,
    bounded by ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``;
    ``running_count_batches`` splits them."""
    cols = events.columns
    out_schema = T.StructType(list(events.schema.fields) + [T.StructField(name, T.LongType())])

    def fn(key, batches, state):
        return _running((b[cols] for b in batches), state, order, name)
    return events.groupBy(field).applyInPandasWithState(
        fn, out_schema, "total long", "append", GroupStateTimeout.NoTimeout)


# --- sinks and runs -------------------------------------------------------------

def start(df: DataFrame | LiveStart, name: str, sink: str = "memory", mode: str = "append",
          path: str | None = None, available_now: bool = False, every: str | None = None,
          transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start a live query with its checkpoint under spark.checkpoint.dir. A
    ``LiveStart`` begins where the query first began; ``transform`` is applied to
    the stream."""
    spark = df.spark if isinstance(df, LiveStart) else df.sparkSession
    checkpoint = checkpoint_location(spark, name)
    if isinstance(df, LiveStart):
        df = df.frame(checkpoint)
    df = transform(df) if transform else df
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    if sink in ("parquet", "text", "json"):
        return w.format(sink).option("path", path).start()
    return w.format(sink).start()


def _copy_of_checkpoint(spark: SparkSession, name: str) -> str:
    """A copy of a query's checkpoint under a new name (an empty one if it never
    ran), without the query's identity, so that it is a query of its own."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    copy = f"{name}-{uuid.uuid4().hex}"
    at = jvm.org.apache.hadoop.fs.Path(checkpoint_location(spark, name))
    to = jvm.org.apache.hadoop.fs.Path(checkpoint_location(spark, copy))
    fs = at.getFileSystem(conf)
    if fs.exists(at):
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, fs, to, False, True, conf)
        for own in ("metadata", ".metadata.crc"):
            fs.delete(jvm.org.apache.hadoop.fs.Path(to, own), False)
    return copy


def run_incremental_live(spark: SparkSession, path: str, out: str, job: str,
                         mode: str = "enabled", transform=None) -> DataFrame | None:
    """J1 live with ``trigger(availableNow=True)``; the job's checkpoint is its
    bookmark. ``enabled`` appends to ``out`` what earlier enabled runs haven't
    seen and moves the bookmark; ``disabled`` appends the whole log, as a batch;
    ``paused`` runs from a copy of the bookmark that is thrown away, so it stays
    where it is: it returns what the next enabled run would take, and leaves
    ``out`` alone."""
    from ..operators.positions import bookmark_mode
    mode = bookmark_mode(mode)
    transform = transform or (lambda d: d)
    name = f"incremental-{job}"
    if mode == "disabled":
        rows = transform(to_log(spark.read.schema(LOG_SCHEMA).parquet(path)))
        rows.write.mode("append").parquet(out)
        return rows
    stream = transform(log_stream(spark, path))
    if mode == "paused":
        taken, copy = new_folder(spark, "stored"), _copy_of_checkpoint(spark, name)
        q = (stream.writeStream.queryName(copy)
             .option("checkpointLocation", checkpoint_location(spark, copy))
             .foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(f"{taken}/batch={k}"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        commits.delete(spark, checkpoint_location(spark, copy))
        if not path_exists(spark, taken):
            return spark.createDataFrame([], stream.schema)
        return spark.read.schema(stream.schema).option("basePath", taken).parquet(f"{taken}/batch=*")
    start(stream, name, sink="parquet", path=out, available_now=True).awaitTermination()
    return None


# --- write paths per micro-batch -------------------------------------------------

def route_stream(df: DataFrame, name: str, good_path: str, bad_path: str,
                 available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """K3 live: each micro-batch is split into accepted and dead-letter
    records, written apart from one persisted batch. Each batch goes to its
    own ``batch=<id>`` folder written in overwrite mode, so a batch replayed
    after a failure replaces its earlier output instead of adding to it."""
    from ..sinks.writes import route

    def each(batch: DataFrame, batch_id: int) -> None:
        route(batch, f"{good_path}/batch={batch_id}", f"{bad_path}/batch={batch_id}",
              mode="overwrite")

    w = (df.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
         .foreachBatch(each))
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    return w.start()


def publish_batch(batch: DataFrame, batch_id: int, topic: str, key: str, value: str,
                  order: list[str], path: str, partitions: int = 3,
                  method: str = "murmur3", receipts_path: str | None = None,
                  receipt_cols: list[str] | None = None, publisher: str = "publisher",
                  timestamp: str | None = None) -> bool:
    """Append one micro-batch to the committed log at ``path`` and write its
    receipts; returns False when the publisher has committed the batch before.

    Each record is published exactly once: the batch's records, their index and
    the log's ends after it become visible with one commit that also names the
    batch (``tidelog.committed``). A batch that failed before its commit left
    nothing that readers see, and gets the same offsets when it is replayed; one
    that failed after it is left out. Offsets continue the kept ends, also after
    retention has removed the last records. Receipts are per batch, and replaced
    by a replay."""
    from ..sinks.writes import delivery_receipts, write_topic

    spark = batch.sparkSession
    log = CommittedLog(spark, path)
    state = log.state()
    if state.version < 0 and path_exists(spark, f"{path}/topic={topic}"):
        raise ValueError(f"{path} is a log of plain files, not a committed log")
    if state.batches.get(publisher, -1) >= batch_id:
        return False
    keep = list(receipt_cols or [])
    cached = batch.persist()
    try:
        written = write_topic(cached, topic, key, value, order, partitions=partitions,
                              method=method, timestamp=timestamp, keep=keep, ends=log.ends(state))
        if receipts_path is not None:
            delivery_receipts(written, keep).write.mode("overwrite").parquet(
                f"{receipts_path}/batch={batch_id}")
        return log.append(written, publisher, batch_id)
    finally:
        cached.unpersist()


def publish_stream(df: DataFrame, name: str, topic: str, key: str, value: str,
                   order: list[str], path: str, partitions: int = 3,
                   method: str = "murmur3", available_now: bool = False,
                   receipts_path: str | None = None,
                   receipt_cols: list[str] | None = None,
                   timestamp: str | None = None) -> StreamingQuery:
    """K1 live: each micro-batch goes through ``publish_batch`` (one commit of
    the log at ``path`` with offsets continuing its ends, receipts per
    ``batch=<id>`` folder, replays left out). The query's ``name`` is the
    publisher's."""
    def each(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, topic, key, value, order, path, partitions, method,
                      receipts_path, receipt_cols, name, timestamp)

    w = (df.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
         .foreachBatch(each))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def follow(spark: SparkSession, path: str, name: str, each: Callable[[DataFrame, int], None],
           available_now: bool = False, commits_per_batch: int = 100) -> StreamingQuery:
    """Read a committed log as it grows: the stream is of its commits, and
    ``each`` gets the records that a micro-batch of them appended (retention
    appends nothing)."""
    stream = (spark.readStream.schema("value string").option("maxFilesPerTrigger", commits_per_batch)
              .option("wholetext", True).option("pathGlobFilter", "[0-9]*.json").text(f"{path}/commits"))

    def records(batch: DataFrame, batch_id: int) -> None:
        names = [a for r in batch.toLocalIterator() if (a := json.loads(r.value)["appended"])]
        log = CommittedLog(spark, path)
        each(log.appended(names), batch_id)

    w = (stream.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint_location(spark, name)).foreachBatch(records))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def dedupe_stream(df: DataFrame, ids: list[str], time_col: str = "timestamp",
                  delay: str = "10 minutes") -> DataFrame:
    """M5 live: drop repeats of a record id that arrive within ``delay`` of
    each other (state is kept per id only as long as the watermark needs)."""
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(ids)


def start_ticks(spark: SparkSession, name: str, start_epoch_s: int, path: str,
                every_s: int = G.TICK_EVERY_S) -> StreamingQuery:
    """S12 live: the run-once startup action (one batch job writing the
    startup line), then one interval line per ``every_s`` seconds as a
    processing-time stream into the text folder ``path``."""
    G.ticks(spark, start_epoch_s, 0, every_s).select("line").write.mode("append").text(
        f"{path}/startup")
    stream = ticks_stream(spark, start_epoch_s, every_s).select("line")
    return start(stream, name, sink="text", path=f"{path}/interval", every=f"{every_s} seconds")


#: Batches after which the totals of running counts are folded into one table.
FOLD_EVERY = 16


class _Totals:
    """Totals per key before a batch, from a folded table (``base=<batch>``) and
    what each later batch added (``added=<batch>``). A batch writes a row for
    each of its own keys only; every ``FOLD_EVERY`` batches the tables are
    folded, and those that the fold before it had replaced are deleted, so what
    is stored follows the number of keys. A replayed batch finds the tables that
    it first read and writes the same ones again."""

    def __init__(self, spark: SparkSession, path: str, fold_every: int):
        self.spark, self.path, self.fold_every = spark, path, fold_every

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}={batch_id}"

    def _base(self, before: int) -> int:
        """The last batch before this one at which totals were folded, or -1."""
        return before // self.fold_every * self.fold_every - 1

    def before(self, batch_id: int) -> DataFrame | None:
        base = self._base(batch_id)
        paths = [self._folder("base", base)] if base >= 0 else []
        paths += [self._folder("added", k) for k in range(base + 1, batch_id)]
        # Every batch writes its rows, so none is missing; a failed read raises.
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, batch_id: int, added: DataFrame) -> None:
        added.write.mode("overwrite").parquet(self._folder("added", batch_id))
        if (batch_id + 1) % self.fold_every:
            return
        base = self._base(batch_id)
        paths = [self._folder("base", base)] if base >= 0 else []
        paths += [self._folder("added", k) for k in range(base + 1, batch_id + 1)]
        folded = self.spark.read.parquet(*paths).groupBy("_rc_grp").agg(F.sum("_rc_total").alias("_rc_total"))
        folded.write.mode("overwrite").parquet(self._folder("base", batch_id))
        older = self._base(base) if base >= 0 else None
        if older is not None:
            gone = [self._folder("base", older)] if older >= 0 else []
            for path in gone + [self._folder("added", k) for k in range(older + 1, base + 1)]:
                commits.delete(self.spark, path)


def running_count_batches(events: DataFrame, name: str, field: str, order: list[str],
                          out_path: str, totals_path: str, available_now: bool = False,
                          every: str | None = None, count_name: str = "count",
                          fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """A3 live without a task per key: each micro-batch is ranked with
    ``dense_position`` (a hot key is spread over range partitions, as in the
    batch form) and offset by the key's total before the batch.

    Totals are kept as what each batch added, folded every ``fold_every``
    batches (``_Totals``), so a batch's work follows its own rows, and a batch
    replayed after a failure rewrites its own output and rows identically.
    Of the totals only the batch's keys are summed."""
    from ..scan import dense_position

    spark = events.sparkSession
    grp = "_rc_grp"
    totals = _Totals(spark, totals_path, fold_every)

    def each(batch: DataFrame, batch_id: int) -> None:
        cached = batch.withColumn(grp, F.struct(field)).persist()
        try:
            own = cached.groupBy(grp).agg(F.count(F.lit(1)).alias("_rc_total"))
            ranked = dense_position(cached, [field], order, "_rc_pos")
            prev = totals.before(batch_id)
            if prev is not None:
                prev = prev.join(own.select(grp), grp, "left_semi").groupBy(grp).agg(
                    F.sum("_rc_total").alias("_rc_total"))
                ranked = ranked.join(prev, grp, "left")
            else:
                ranked = ranked.withColumn("_rc_total", F.lit(0).cast("long"))
            out = ranked.withColumn(
                count_name, F.coalesce("_rc_total", F.lit(0)) + F.col("_rc_pos") + 1
            ).drop("_rc_pos", "_rc_total", grp)
            out.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
            totals.add(batch_id, own)
        finally:
            cached.unpersist()

    w = (events.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint_location(spark, name))
         .foreachBatch(each))
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    return w.start()
