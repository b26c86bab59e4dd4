"""Sinks (K1-K6): publishing to a log, receipts, dead letters, printed
lines and table snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import utf8_or_null
from ..log import LOG_COLUMNS, TP, pin_small, with_offsets
from ..operators.ends import known_bounds
from ..operators.maintenance import partition_for
from ..operators.serde import ERROR


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- K1 ---------------------------------------------------------------------

def write_topic(df: DataFrame, topic: str, key: str | Column, value: str | Column,
                order: list[str], existing: DataFrame | None = None,
                partitions: int = 3, method: str = "murmur3",
                timestamp: str | Column | None = None,
                path: str | None = None, keep: list[str] | None = None,
                ends: DataFrame | None = None) -> DataFrame:
    """Publish keyed records: place each by key, give it the next dense
    offset of its partition (continuing ``existing``'s end, and the kept
    ``ends`` of a log that retention or compaction may have emptied) and, with
    ``path``, append it to the Parquet log laid out by topic/partition.

    Placement defaults to Spark's own hash of the key (``method``: ``murmur3``,
    ``md5`` or ``murmur2``; keyless records are spread by the value's hash).
    Offsets are assigned by ``tidelog.log.with_offsets`` (range partitions, no
    single task per partition); ``order`` must be a total order of the records.
    Without ``timestamp``
    the records get the query's start time. Returns the written records
    (plus ``keep`` columns), which ``delivery_receipts`` projects."""
    k = _c(key).cast("binary")
    ts = _c(timestamp).cast("timestamp") if timestamp is not None else F.current_timestamp()
    staged = df.select(
        *dict.fromkeys([*order, *(keep or [])]),
        k.alias("key"), _c(value).cast("binary").alias("value"),
        F.lit(topic).alias("topic"), ts.alias("timestamp"))
    staged = staged.withColumn("partition", partition_for(F.col("key"), partitions, method,
                                                          F.col("value")))
    base = None
    if existing is not None or ends is not None:
        # The end offsets (one row per partition) are pinned before anything
        # is written, so the offsets never depend on re-reading a log that
        # this very write appends to: a recomputed task, or a second use of
        # the returned frame, gets the same offsets.
        of_topic = F.col("topic") == topic
        last = (ends.filter(of_topic) if existing is None else known_bounds(
            existing.filter(of_topic), None if ends is None else ends.filter(of_topic)))
        base, _ = pin_small(last.select(*TP, "end_offset"),
                            "topic string, partition int, end_offset long")
    written = with_offsets(staged, order, base)
    cols = LOG_COLUMNS + [c for c in (keep or []) if c not in LOG_COLUMNS]
    written = written.select(*cols)
    if path is not None:
        append_log(written, path)
    return written


def append_log(written: DataFrame, path: str) -> None:
    """Append log records under ``path`` in topic/partition folders. The
    rows are already spread by range of offsets, so there is no extra shuffle:
    each task writes its offset ranges, sorted (offset min/max statistics then
    let position reads skip files)."""
    (written.select(*LOG_COLUMNS).sortWithinPartitions(*TP, "offset")
     .write.mode("append").partitionBy(*TP).parquet(path))


def write_kafka(log: DataFrame, options: dict[str, str]) -> None:
    """K1 to a broker: Spark's Kafka sink takes key, value and topic (and an
    optional partition); needs the connector package on the classpath."""
    cols = [c for c in ("key", "value", "topic", "partition") if c in log.columns]
    log.select(*cols).write.format("kafka").options(**options).save()


# --- K2 ---------------------------------------------------------------------

def delivery_receipts(written: DataFrame, payload: list[str]) -> DataFrame:
    """Per record: what was sent and where it landed."""
    return written.select(*payload, "topic", "partition", "offset")


# --- K3 ---------------------------------------------------------------------

def dead_letters(df: DataFrame, reason: str = ERROR) -> DataFrame:
    """Records that failed, with their error, kept apart."""
    return df.filter(F.col(reason).isNotNull())


def accepted(df: DataFrame, reason: str = ERROR) -> DataFrame:
    return df.filter(F.col(reason).isNull()).drop(reason)


def route(df: DataFrame, good_path: str, bad_path: str, reason: str = ERROR,
          mode: str = "append") -> None:
    """Write good and bad records of one batch apart. The batch is persisted
    once so both writes read it a single time (a lost cached block is
    recomputed from the batch's own lineage)."""
    cached = df.persist()
    try:
        accepted(cached, reason).write.mode(mode).parquet(good_path)
        dead_letters(cached, reason).write.mode(mode).parquet(bad_path)
    finally:
        cached.unpersist()


# --- K4 ---------------------------------------------------------------------

def keyed_lines(log: DataFrame) -> DataFrame:
    """Console form ``key<TAB>value``; a missing key or value, or one that isn't
    UTF-8, prints null."""
    def txt(c: str) -> Column:
        return F.coalesce(utf8_or_null(c), F.lit("null"))
    return log.select(*TP, "offset", F.concat(txt("key"), F.lit("\t"), txt("value")).alias("line"))


# --- K5 ---------------------------------------------------------------------

def message_lines(df: DataFrame, template: str, *cols: str,
                  keep: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """One formatted text line per record (``printf`` template)."""
    present = [c for c in keep if c in df.columns]
    return df.select(*present, F.format_string(template, *cols).alias("line"))


# --- K6 ---------------------------------------------------------------------

def table_snapshot(events: DataFrame, field: str, as_of: str | Column | None = None,
                   time_col: str = "timestamp", name: str = "count") -> DataFrame:
    """The whole keyed count table as it stood after the last update at or
    before ``as_of`` (all updates when None), one row per key, ordered by key
    like the printed table."""
    src = events if as_of is None else events.filter(
        F.col(time_col) <= (_c(as_of) if isinstance(as_of, Column) else F.to_timestamp(F.lit(as_of))))
    return src.groupBy(field).agg(F.count(F.lit(1)).alias(name)).orderBy(field)
