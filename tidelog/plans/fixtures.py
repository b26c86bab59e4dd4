"""Topic logs derived from the driver's tables, so every operator has a
repeatable input whose size grows with the tables (see FIXTURES.md).

Partitions are arithmetic (``id % 3``), not hashed, so a SQL engine can
repeat them; offsets are dense per partition in the stated order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import message_key
from ..committed import CommittedLog
from ..log import LOG_COLUMNS, TP, bounds, dense_position, with_offsets
from ..operators.serde import frame
from ..session import checkpoint_dir
from ..sinks.writes import append_log
from ..sources.topics import open_log

# Fixed values of the fixtures.
EPOCH_S = 1704067200          # 2024-01-01T00:00:00Z
GREETING_EVERY_S = 5
PARTITIONS = 3
UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Etc/Universal", "Universal"}

EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its timestamps are zone-free wall clocks, and the
    fixtures define them as UTC instants (as the SQL oracle does), so the
    session zone is pinned to UTC here."""
    if spark.conf.get("spark.sql.session.timeZone") not in UTC_NAMES:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _json(*cols) -> F.Column:
    return F.encode(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), "UTF-8")


# The logs this process has written, by application, table folder and name.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(name: str) -> Callable[[Callable], Callable]:
    """A fixture log is written once per session and table folder, in the shared
    folder, and opened from there, so that queries read a log as their users
    do: positions and times are filtered in the Parquet scan."""
    def of(build: Callable[[SparkSession, str], DataFrame]):
        def log(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _WRITTEN:
                path = f"{checkpoint_dir(spark).rstrip('/')}/fixtures-{uuid.uuid4().hex}"
                append_log(build(spark, sf_dir), path)
                _WRITTEN[key] = path
            return open_log(spark, _WRITTEN[key])
        log.__name__, log.__doc__ = build.__name__, build.__doc__
        return log
    return of


@written("events")
def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: key user_id, value {event_type, value, props}, partition
    user_id % 3, offsets in event_id order, time = ts."""
    ev = table(spark, sf_dir, "events")
    staged = ev.select(
        "event_id",
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        _json("event_type", "value", "props").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("ts").cast("timestamp").alias("timestamp"))
    return with_offsets(staged, ["event_id"]).select(*LOG_COLUMNS)


def _ranked_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ranked = dense_position(cv, [], ["conv_id", "turn"], "seq")
    ranked = ranked.withColumn(
        "partition", F.pmod(F.col("conv_id"), F.lit(PARTITIONS)).cast("int"))
    ranked = dense_position(ranked, ["partition"], ["seq"], "offset")
    return ranked.withColumn(
        "timestamp", F.timestamp_seconds(F.lit(EPOCH_S) + F.col("seq") * GREETING_EVERY_S))


@written("greetings")
def greetings_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """greetings: one Greeting(message=text, greeter=role) per turn, key
    role, partition conv_id % 3, one every 5 s in (conv_id, turn) order."""
    r = _ranked_conversations(spark, sf_dir)
    return r.select(
        F.encode("role", "UTF-8").alias("key"),
        _json(F.col("text").alias("message"), F.col("role").alias("greeter")).alias("value"),
        F.lit("greetings").alias("topic"), "partition", "offset", "timestamp")


@written("greetings.raw")
def raw_greetings_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """greetings.raw: the same turns as plain strings without a key."""
    r = _ranked_conversations(spark, sf_dir)
    return r.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("text", "UTF-8").alias("value"),
        F.lit("greetings.raw").alias("topic"), "partition", "offset", "timestamp")


def _people_staged(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return cu.select(
        "c_custkey", "c_name", "c_mktsegment",
        F.encode(message_key("c_mktsegment"), "UTF-8").alias("key"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("c_custkey"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.timestamp_seconds(F.lit(EPOCH_S) + F.col("c_custkey")).alias("timestamp"))


@written("people")
def people_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """people: Person(id, name, title) JSON per customer, key P1(title)."""
    s = _people_staged(spark, sf_dir, "people").withColumn(
        "value", _json(F.col("c_custkey").cast("string").alias("id"),
                       F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title")))
    return with_offsets(s, ["c_custkey"]).select(*LOG_COLUMNS)


@written("people.dirty")
def people_dirty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """people.dirty: the people records, of which (by c_custkey % 8) 0 is a
    deletion marker, 1 has single quotes, 2 has text after the record, 3 isn't
    UTF-8, 4 lacks the name, 5 has a key that isn't UTF-8, 6 has no key."""
    s = _people_staged(spark, sf_dir, "people.dirty")
    ident = F.col("c_custkey").cast("string")
    person = _json(ident.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"))
    nameless = _json(ident.alias("id"), F.col("c_mktsegment").alias("title"))
    kind = F.col("c_custkey") % 8
    value = (F.when(kind == 0, F.lit(None).cast("binary"))
             .when(kind == 1, F.encode(F.concat(F.lit("{'id':'"), ident, F.lit("'}")), "UTF-8"))
             .when(kind == 2, F.concat(person, F.encode(F.lit(" and more"), "UTF-8")))
             .when(kind == 3, F.unhex(F.lit("7BC328")))
             .when(kind == 4, nameless).otherwise(person))
    key = F.when(kind == 5, F.unhex(F.lit("FF"))).when(kind != 6, F.col("key"))
    s = s.withColumn("value", value).withColumn("key", key)
    return with_offsets(s, ["c_custkey"]).select(*LOG_COLUMNS)


@written("people.avro")
def people_mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """people.avro: wire-framed values, odd customers written with Person v1
    (schema id 1: name, title), even ones with v2 (schema id 2: first_name,
    last_name from the name split at '#', title)."""
    s = _people_staged(spark, sf_dir, "people.avro")
    parts = F.split(F.col("c_name"), "#", 2)
    v1 = frame(1, _json(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title")))
    v2 = frame(2, _json(F.try_element_at(parts, F.lit(1)).alias("first_name"),
                        F.try_element_at(parts, F.lit(2)).alias("last_name"),
                        F.col("c_mktsegment").alias("title")))
    s = s.withColumn("value", F.when(F.col("c_custkey") % 2 == 1, v1).otherwise(v2))
    return with_offsets(s, ["c_custkey"]).select(*LOG_COLUMNS)


PRODUCERS = 5


def sequenced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as numbered sends of five producers (user_id % 5) to the
    partitions of topic sends (user_id % 3): a producer numbers its sends per
    partition in event_id order; those of event_id % 97 = 0 never arrive, those
    of event_id % 11 = 0 arrive twice, and arrival is up to 12 ids late."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").withColumns({
        "producer": F.concat(F.lit("p"), (F.col("user_id") % PRODUCERS).cast("string")),
        "topic": F.lit("sends"), "partition": (F.col("user_id") % PARTITIONS).cast("int")})
    numbered = dense_position(ev, ["producer", "partition"], ["event_id"], "sequence")
    sent = numbered.filter("event_id % 97 <> 0").withColumn("copy", F.explode(F.when(
        F.col("event_id") % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    arrival = F.col("event_id") + F.col("event_id") * 7 % 13 + F.col("copy") * 20
    return with_offsets(sent.withColumn("arrival", arrival), ["arrival", "event_id", "copy"])


@written("people.typed")
def people_typed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """people.typed: wire-framed values with fields whose types differ between
    writers: by c_custkey % 3, writer 1 (schema id 1) has age as a whole number,
    writer 2 age as a fraction and a nickname, writer 3 age as a string."""
    s = _people_staged(spark, sf_dir, "people.typed")
    name, age = F.col("c_name").alias("name"), (F.col("c_custkey") % 90)
    whole = frame(1, _json(name, age.cast("int").alias("age")))
    fraction = frame(2, _json(name, (age + 0.5).cast("double").alias("age"), F.col("c_mktsegment").alias("nick")))
    text = frame(3, _json(name, age.cast("string").alias("age")))
    kind = F.col("c_custkey") % 3
    s = s.withColumn("value", F.when(kind == 0, whole).when(kind == 1, fraction).otherwise(text))
    return with_offsets(s, ["c_custkey"]).select(*LOG_COLUMNS)


_COMMITTED: dict[tuple[str, str], str] = {}
APPENDS = 4


def events_committed(spark: SparkSession, sf_dir: str) -> CommittedLog:
    """The events log as a committed log of four appends, each the next quarter
    of every partition's offsets; written once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _COMMITTED:
        log = events_log(spark, sf_dir)
        path = f"{checkpoint_dir(spark).rstrip('/')}/fixtures-{uuid.uuid4().hex}"
        ends = bounds(log).select(*TP, F.col("end_offset").alias("_end"))
        quarter = F.floor(F.col("offset") * APPENDS / F.col("_end"))
        dealt = log.join(F.broadcast(ends), TP).withColumn("_q", quarter)     # one row a partition
        for k in range(APPENDS):
            CommittedLog(spark, path).append(dealt.filter(F.col("_q") == k))
        _COMMITTED[key] = path
    return CommittedLog(spark, _COMMITTED[key])


def commits_at(log: DataFrame, group: str, tenths: int) -> DataFrame:
    """Commits of ``group`` at floor(tenths/10 * end) of every partition
    (integer arithmetic, so every engine agrees)."""
    b = bounds(log)
    return b.select(F.lit(group).alias("group"), *TP,
                    F.expr(f"(end_offset * {int(tenths)}) div 10").cast("long").alias("offset"))


def commits_g0(log: DataFrame) -> DataFrame:
    return commits_at(log, "g0", 6)
