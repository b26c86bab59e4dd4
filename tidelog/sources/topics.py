"""Reading a topic log.

Every reader takes the canonical log DataFrame (``tidelog.log``): either a
Parquet-backed log (``open_log``) or Spark's Kafka source
(``kafka_options``; the connector package must be on the classpath).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import utf8_or_null
from ..log import TP, LOG_SCHEMA, to_log
from ..operators.positions import epoch_ms_of, first_at_or_after, from_positions
from ..operators.serde import ERROR

EARLIEST, LATEST = -2, -1


def open_log(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet-backed log (laid out by topic and partition folders when
    written by ``tidelog.sinks.write_topic``), or what is committed of a
    committed log (``tidelog.committed``)."""
    from ..committed import CommittedLog, is_committed
    if is_committed(spark, path):
        return CommittedLog(spark, path).records()
    return to_log(spark.read.schema(LOG_SCHEMA).parquet(path))


def kafka_options(bootstrap: str, topics: list[str] | None = None,
                  pattern: str | None = None, starting: str | None = None,
                  ending: str | None = None, starting_ms: int | None = None,
                  security: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``spark.read/readStream.format("kafka")``. Secured reads
    pass protocol, mechanism and credentials through as ``kafka.*``."""
    opts = {"kafka.bootstrap.servers": bootstrap}
    if topics:
        opts["subscribe"] = ",".join(topics)
    if pattern:
        opts["subscribePattern"] = pattern
    if starting:
        opts["startingOffsets"] = starting
    if ending:
        opts["endingOffsets"] = ending
    if starting_ms is not None:
        opts["startingTimestamp"] = str(int(starting_ms))
    for k, v in (security or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = v
    return opts


def starting_offsets_json(spec: dict[str, dict[int, int]]) -> str:
    """S3's spec as the Kafka source's ``startingOffsets`` JSON."""
    import json
    return json.dumps({t: {str(p): int(o) for p, o in parts.items()}
                       for t, parts in spec.items()})


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return to_log(spark.read.format("kafka").options(**options).load())


# --- S1 / S6 -----------------------------------------------------------------

def read_from_earliest(log: DataFrame, topic: str) -> DataFrame:
    """Every record of the topic from the beginning."""
    return log.filter(F.col("topic") == topic)


def read_topics(log: DataFrame, topics: list[str]) -> DataFrame:
    """Subscribe to a list of topics."""
    return log.filter(F.col("topic").isin(list(topics)))


# --- S2 ---------------------------------------------------------------------

def read_from_latest(log: DataFrame, topic: str,
                     ends_at_start: DataFrame | None = None) -> DataFrame:
    """Only records that arrived after the reader started.

    ``ends_at_start`` holds the end offsets (topic, partition, end_offset)
    the topic had when the reader started; without it the reader starts now
    and a batch read sees nothing yet (live reads: ``tidelog.streaming``)."""
    records = log.filter(F.col("topic") == topic)
    if ends_at_start is None:
        return records.limit(0)
    starts = ends_at_start.filter(F.col("topic") == topic).select(
        *TP, F.col("end_offset").alias("start_offset"))
    return from_positions(records, starts, default="earliest")


# --- S3 ---------------------------------------------------------------------

def read_from_offsets(log: DataFrame, spec: dict[str, dict[int, int]],
                      spark: SparkSession | None = None) -> DataFrame:
    """S3: records at or after a given offset per partition, in the
    ``startingOffsets`` shape ``{topic: {partition: offset}}`` where -2 is
    earliest and -1 latest. Unlisted partitions of a listed topic start at
    the earliest offset; unlisted topics are not read."""
    spark = spark or log.sparkSession
    rows = []
    for topic, parts in spec.items():
        for p, off in parts.items():
            start = 0 if off == EARLIEST else (2**63 - 1 if off == LATEST else int(off))
            rows.append((topic, int(p), start))
    starts = spark.createDataFrame(rows, "topic string, partition int, start_offset long")
    return from_positions(read_topics(log, list(spec)), starts, default="earliest")


# --- S4 / S5 -----------------------------------------------------------------

def read_from_timestamp(log: DataFrame, epoch_ms: int,
                        topic: str | None = None) -> DataFrame:
    """Per partition, from the first offset whose timestamp is at or
    after the instant; a partition with no such record yields nothing."""
    records = log if topic is None else log.filter(F.col("topic") == topic)
    return from_positions(records, first_at_or_after(records, epoch_ms), default="latest")


def read_from_datetime(log: DataFrame, iso: str, topic: str | None = None) -> DataFrame:
    """S4 with an ISO-8601 instant (``2026-02-13T00:00:00Z``)."""
    return read_from_timestamp(log, epoch_ms_of(iso), topic)


# --- S7 ---------------------------------------------------------------------

def read_keyed_lines(df: DataFrame, col: str = "line", sep: str = "|") -> DataFrame:
    """``key<sep>value`` lines; only the first separator splits, so the
    value may contain more. A line without a separator is an error record."""
    line = F.col(col)
    at = F.locate(sep, line)
    rest = F.substring(line, at + len(sep), F.char_length(line))
    return df.select(
        "*",
        F.when(at > 0, F.substring(line, F.lit(1), at - 1)).alias("key"),
        F.when(at > 0, rest).alias("value"),
        F.when(line.isNotNull() & (at == 0), F.lit("no key separator")).alias(ERROR),
    )


# --- S8 ---------------------------------------------------------------------

def read_raw_strings(log: DataFrame) -> DataFrame:
    """The value bytes as a plain string, no parsing; bytes that are not
    UTF-8 become an error record instead of replacement characters."""
    text = utf8_or_null("value")
    return log.select(
        "*", text.alias("text"),
        F.when(F.col("value").isNotNull() & text.isNull(), F.lit("invalid utf-8"))
         .alias(ERROR))
