"""Named queries: one per operator of the inventory, each over fixture logs
derived from the driver's tables (``tidelog.plans.fixtures``). The SQL
oracle of each is in ``tidelog.plans.oracle``; column names match."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import message_key, title_case
from ..log import TP, record_view, wall_clock
from ..operators import compaction as IC
from ..operators import ends as N
from ..operators import history as H
from ..operators import maintenance as M
from ..operators import positions as O
from ..operators import sequences as SQ
from ..operators import serde as C
from ..operators import state as A
from ..session import new_folder, stored
from ..sinks import writes as K
from ..sources import generators as G
from ..sources import topics as S
from . import fixtures as fx
from . import live_queries as live
from .fixtures import EVENT

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the queries (the oracle uses the same).
SINCE_MS = 1705000000000                    # 2024-01-11T19:06:40Z
SINCE_ISO = "2024-01-15T06:30:00Z"
STARTED_AT = "2024-01-20 00:00:00"
CONSUMED_BEFORE = "2024-01-10 00:00:00"
RETENTION_MS = 360000
RETENTION_NOW = "2024-01-15 00:00:00"

RESET_DATETIME = "2024-01-20T00:00:00Z"
REPUBLISH_EPOCH_S = live.REPUBLISH_EPOCH_S
RESETS = [("to-offset", 5, [0]), ("to-earliest", None, None), ("to-latest", None, None),
          ("to-timestamp", SINCE_MS, None), ("to-datetime", RESET_DATETIME, None)]
SENT_UPTO = 3000                            # arrivals of the first of two runs
FAILS_ABOVE = 230.0                         # errors whose processing fails
HISTORY_EVERY = 64
TABLE_VERSIONS = [1, 64, 65, 200, 300]
OFFSETS_SPEC = {"events": {0: 1000, 1: S.LATEST}, "greetings": {0: S.EARLIEST, 2: 100}}
GREETING_LINE = "Greeting is '%s' from '%s'"
RAW_GREETING_LINE = "Greeting is '%s'"
PERSON_LINE = "Consumed person %s %s (%s) with key '%s' from partition %d at offset %d"


def _events(spark, d):
    return fx.events_log(spark, d)


def _greeting_items(spark, d):
    return K.accepted(C.items(fx.greetings_log(spark, d), C.GREETING))


# --- flagship: count greetings per greeter (3.2 end to end) ------------------

def count_greetings(spark: SparkSession, d: str) -> DataFrame:
    """Decode the greetings log, re-key by greeter, count per greeter."""
    return A.count_by_key(_greeting_items(spark, d), "greeter")


# --- sources ----------------------------------------------------------------

def read_from_earliest(spark, d):
    """Every record of the events topic from the beginning."""
    return record_view(S.read_from_earliest(_events(spark, d), "events"))


def read_from_latest(spark, d):
    """Records that arrived after a reader started (end offsets at start)."""
    log = _events(spark, d)
    ends = M.topic_stats(log.filter(F.col("timestamp") < F.to_timestamp(F.lit(STARTED_AT))))
    return record_view(S.read_from_latest(log, "events", ends))


def _events_and_greetings(spark, d):
    return _events(spark, d).unionByName(fx.greetings_log(spark, d))


def read_from_offsets(spark, d):
    """S3: from given offsets per partition (-2 earliest, -1 latest)."""
    return record_view(S.read_from_offsets(_events_and_greetings(spark, d), OFFSETS_SPEC))


def read_from_timestamp(spark, d):
    """From the first offset at or after an epoch-ms instant."""
    return record_view(S.read_from_timestamp(_events(spark, d), SINCE_MS, "events"))


def read_from_datetime(spark, d):
    """S4 with an ISO-8601 instant."""
    return record_view(S.read_from_datetime(_events(spark, d), SINCE_ISO, "events"))


def read_topics(spark, d):
    """Subscribe to a list of topics."""
    log = _events_and_greetings(spark, d).unionByName(fx.people_log(spark, d))
    return record_view(S.read_topics(log, ["events", "people"]))


def _event_lines(spark, d):
    ev = fx.table(spark, d, "events")
    line = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type", "props"))
    return ev.select(line.alias("line"))


def read_keyed_lines(spark, d):
    """key|value lines split at the first separator; others rejected."""
    return S.read_keyed_lines(_event_lines(spark, d)).select("line", "key", "value", C.ERROR)


def read_raw_strings(spark, d):
    """Values as plain strings, no parsing."""
    raw = S.read_raw_strings(fx.raw_greetings_log(spark, d))
    return raw.select("partition", "offset", "text", C.ERROR)


def generate_records(spark, d):
    """One technologist record per event id, key = last name."""
    return G.generate_records(fx.table(spark, d, "events"), id_col="event_id")


def generate_people(spark, d):
    """One generated person per customer (title case, message key)."""
    return G.generate_people(fx.table(spark, d, "customer"), id_col="c_custkey")


def generate_greetings(spark, d):
    """One greeting record per event id, 5 s apart."""
    out = G.generate_greetings(fx.table(spark, d, "events"), fx.EPOCH_S, id_col="event_id")
    return out.withColumn("timestamp", wall_clock("timestamp"))


def generate_greeting_words(spark, d):
    """The fourteen-word greeting form."""
    out = G.generate_greetings(fx.table(spark, d, "events"), fx.EPOCH_S, form="word",
                               id_col="event_id")
    return out.withColumn("timestamp", wall_clock("timestamp"))


def ticks(spark, d):
    """The startup row and the interval ticks over the events' time
    span, each with the events that arrived in its interval."""
    out = G.tick_report(fx.table(spark, d, "events"), "ts")
    return out.withColumn("at", wall_clock("at"))


# --- sinks ------------------------------------------------------------------

def _published_people(spark, d, existing=None, ends=None):
    """3.1: generate people, key, encode, place by md5, continue the people
    topic's offsets (or those of ``existing`` and its kept ``ends``)."""
    existing = fx.people_log(spark, d) if existing is None else existing
    people = G.generate_people(fx.table(spark, d, "customer"), id_col="c_custkey")
    people = C.encode_json(people, ["id", "name", "title"])
    at = F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S) + F.col("seq"))
    return K.write_topic(people, "people", F.encode("key", "UTF-8"), "value", ["seq"],
                         existing=existing, method="md5", timestamp=at,
                         keep=["id", "name", "title"], ends=ends)


def write_topic(spark, d):
    """K1: publish generated people after the people topic's end."""
    return record_view(_published_people(spark, d), "id")


def delivery_receipts(spark, d):
    """K2: what each published record is and where it landed."""
    return K.delivery_receipts(_published_people(spark, d), ["id", "name", "title"])


def items_rejects(spark, d):
    """P4 (C2, C3): pairs of a log with malformed JSON, bytes that aren't UTF-8
    in values and keys, deletion markers and null keys; bad records carry
    their reason."""
    return C.items(fx.people_dirty_log(spark, d), C.PERSON_JSON).drop("timestamp")


def dead_letters_rejects(spark, d):
    """K3 (C4): the records of that log that decoding or validation rejects."""
    log = fx.people_dirty_log(spark, d).filter(F.col("value").isNotNull())
    checked = C.validate_record(C.items(log, C.PERSON_JSON), C.PERSON_JSON)
    return K.dead_letters(checked).select("partition", "offset", C.ERROR)


def keyed_lines_rejects(spark, d):
    """K4: printed lines of that log, what isn't UTF-8 printed as null."""
    return K.keyed_lines(fx.people_dirty_log(spark, d))


def compact_tombstones(spark, d):
    """M2: that log compacted: a last null value removes its key, records without
    a key are left out."""
    return M.compact(fx.people_dirty_log(spark, d)).select(
        "partition", "offset", F.hex("key").alias("key_hex"))


def _people_mixed_resolved(spark, d, reader):
    log = C.unframe(fx.people_mixed_log(spark, d))
    return C.read_with_schema(log, "schema_id", {1: C.PERSON_V1, 2: C.PERSON_V2}, reader)


def dead_letters(spark, d):
    """K3: records a reader schema cannot take, with the reason."""
    bad = K.dead_letters(_people_mixed_resolved(spark, d, C.PERSON_V1))
    return bad.select("partition", "offset", C.ERROR)


def keyed_lines(spark, d):
    """K4: key<TAB>value lines, null keys printed as null."""
    log = fx.people_log(spark, d).unionByName(fx.raw_greetings_log(spark, d))
    return K.keyed_lines(log)


def message_lines(spark, d):
    """K5: one formatted line per greeting."""
    return K.message_lines(_greeting_items(spark, d), GREETING_LINE, "message", "key")


def raw_greeting_lines(spark, d):
    """K5: one formatted line per raw greeting string."""
    raw = K.accepted(S.read_raw_strings(fx.raw_greetings_log(spark, d)))
    return K.message_lines(raw, RAW_GREETING_LINE, "text")


def table_snapshot(spark, d):
    """K6: the whole current count table."""
    return K.table_snapshot(_greeting_items(spark, d), "greeter")


# --- serde, schemas ------------------------------------------------------------

def encode_json(spark, d):
    """Records as JSON text."""
    cu = fx.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"))
    enc = C.encode_json(cu, ["id", "name", "title"])
    return enc.select("id", F.decode("value", "UTF-8").alias("json"))


def decode_json(spark, d):
    """JSON values decoded to fields, bad records flagged."""
    dec = C.decode_json(_events(spark, d), EVENT)
    return dec.select("topic", "partition", "offset", "event_type", "value", "props", C.ERROR)


def decode_utf8(spark, d):
    """Strict UTF-8 decode of keys and values."""
    dec = C.decode_utf8(fx.people_log(spark, d))
    return dec.select("partition", "offset", "key_text", "value_text", C.ERROR)


def validate_record(spark, d):
    """C4: required fields present, else rejected."""
    log = C.unframe(fx.people_mixed_log(spark, d))
    dec = C.decode_json(log, C.PERSON_V1, col="payload")
    out = C.validate_record(dec, C.PERSON_V1)
    return out.select("partition", "offset", "name", "title", C.ERROR)


def read_with_schema(spark, d):
    """A mixed-version topic resolved to the v2 reader schema."""
    out = _people_mixed_resolved(spark, d, C.PERSON_V2)
    return out.select("partition", "offset", "schema_id", "first_name", "last_name",
                      "title", C.ERROR)


def compat_audit(spark, d):
    """Which stored record shapes each candidate schema can read."""
    log = C.unframe(fx.people_mixed_log(spark, d))
    return C.compat_audit(log, [C.FULLNAME_REQUIRED, C.FULLNAME_OPTIONAL, C.PERSON_V2])


# --- projections and scalars ---------------------------------------------------

def message_key_q(spark, d):
    """Message keys (lower case, literal 's+' -> '-')."""
    cu = fx.table(spark, d, "customer")
    return cu.select("c_custkey", message_key("c_mktsegment").alias("segment_key"),
                     message_key("c_name").alias("name_key"))


def title_case_q(spark, d):
    """Title case of whole conversation texts."""
    cv = fx.table(spark, d, "conversations")
    return cv.select("conv_id", "turn", title_case("text").alias("title"))


def with_id(spark, d):
    """Repeatable UUID-shaped ids (md5 form)."""
    cu = fx.table(spark, d, "customer").select("c_custkey")
    return C.with_id(cu, "id", "md5", "person", "c_custkey")


def with_uuid(spark, d):
    """P3 production form: random ids (no SQL oracle: not repeatable)."""
    cu = fx.table(spark, d, "customer").select("c_custkey")
    return C.with_id(cu, "id", "uuid")


def items(spark, d):
    """(key, decoded fields) pairs."""
    return C.items(fx.greetings_log(spark, d), C.GREETING).select(
        "partition", "offset", "key", "message", "greeter", C.ERROR)


# --- keyed state -------------------------------------------------------------

def rekey(spark, d):
    """A1: greetings re-keyed by greeter onto the re-keyed topic's partitions."""
    it = _greeting_items(spark, d).select(
        F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
        "message", "greeter")
    out = A.rekey(it, "greeter", 3, "md5")
    return out.select("source_partition", "source_offset",
                      F.decode("key", "UTF-8").alias("key"), "partition")


def count_by_key(spark, d):
    """A2: events counted per type."""
    dec = K.accepted(C.decode_json(_events(spark, d), EVENT))
    return A.count_by_key(dec, "event_type")


def running_count(spark, d):
    """A3: per greeting, the greeter's count after it."""
    out = A.running_count(_greeting_items(spark, d), "greeter",
                          ["timestamp", "partition", "offset"])
    return out.select("partition", "offset", "greeter", "count")


def lookup_count(spark, d):
    """A4: counts per user over the whole log, read for every customer id:
    customers without events read 0."""
    counts = A.count_by_key(_events(spark, d).select(F.decode("key", "UTF-8").alias("key")), "key")
    keys = fx.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return A.lookup_count(counts, keys, "key")


# --- maintenance ---------------------------------------------------------------

def apply_retention(spark, d):
    """M1: records within the retention window at a given now."""
    return record_view(M.apply_retention(_events(spark, d), RETENTION_MS, RETENTION_NOW))


def compact(spark, d):
    """M2: latest record per key and partition."""
    out = C.decode_json(M.compact(_events(spark, d)), EVENT)
    return out.select("partition", F.decode("key", "UTF-8").alias("key"), "offset",
                      "event_type")


def assign_partition(spark, d):
    """M3: md5 placement of customer keys (portable form)."""
    cu = fx.table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("key"))
    return M.assign_partition(cu, "key", 3, "md5")


def _all_logs(spark, d):
    return (_events_and_greetings(spark, d).unionByName(fx.people_log(spark, d))
            .unionByName(fx.people_mixed_log(spark, d)))


def assign_partition_producer(spark, d):
    """M3 with the producer's placement (murmur2; the SQL oracle computes the
    same hash in DuckDB, the tests also check a plain-Python port)."""
    cu = fx.table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("key"))
    return M.assign_partition(cu, "key", 3, "murmur2")


def topic_stats(spark, d):
    """M4: records, offset bounds and time span per topic partition."""
    return M.topic_stats(_all_logs(spark, d))


def list_topics(spark, d):
    """M4: topics with partition and record counts."""
    return M.list_topics(_all_logs(spark, d))


def dedupe(spark, d):
    """M5: a log with its replay, one row per position."""
    log = _events(spark, d)
    replay = O.resume(log, fx.commits_g0(log), "g0", "earliest")
    return record_view(M.dedupe(log.unionByName(replay)))


def dedupe_by_id(spark, d):
    """M5: a topic with retried copies, first written copy per id."""
    first = fx.people_log(spark, d)
    it = C.items(first, C.PERSON_JSON)
    again = C.encode_json(K.accepted(it), ["id", "name", "title"])
    again = again.withColumn("c_custkey", F.col("id").cast("long"))
    retried = K.write_topic(again, "people", F.encode("key", "UTF-8"), "value", ["c_custkey"],
                            existing=first, method="md5",
                            timestamp=F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S)))
    both = K.accepted(C.items(first.unionByName(retried), C.PERSON_JSON))
    out = M.dedupe(both.select("id", "topic", "partition", "offset", "timestamp"), ["id"])
    return out.drop("timestamp")


# --- positions -----------------------------------------------------------------

def commit(spark, d):
    """O1: next positions after consuming records before an instant."""
    log = _events(spark, d)
    consumed = log.filter(F.col("timestamp") < F.to_timestamp(F.lit(CONSUMED_BEFORE)))
    return O.commit(consumed, "g0")


def resume(spark, d):
    """O2: records after the committed positions; no commit -> earliest."""
    log = _events(spark, d)
    commits = fx.commits_g0(log).filter(F.col("partition") != 2)
    return record_view(O.resume(log, commits, "g0", "earliest"))


def _groups(spark, d):
    log = _events_and_greetings(spark, d)
    ev = log.filter(F.col("topic") == "events")
    gr = log.filter(F.col("topic") == "greetings")
    commits = (fx.commits_at(ev, "g0", 6).unionByName(fx.commits_at(ev, "g1", 3))
               .unionByName(fx.commits_at(gr, "g2", 5)))
    return log, commits


def group_lag(spark, d):
    """O3: committed position, log end and lag per group and partition."""
    log, commits = _groups(spark, d)
    return O.group_lag(log, commits)


def group_lag_uncommitted(spark, d):
    """O3: every partition of a group's topics, also one it never committed in,
    and partitions that retention has emptied (their end is kept)."""
    log, commits = _groups(spark, d)
    ends = N.log_ends(log)
    kept = log.filter((F.col("topic") != "events") | (F.col("partition") != 0))
    return O.group_lag(kept, commits.filter(F.col("partition") != 1), N.after_retention(ends, kept),
                       uncommitted=True)


def publish_after_retention(spark, d):
    """M1, K1, then O2: retention removes every record of the people topic, the
    generated people are published after its kept ends, and a group that had
    read everything reads exactly them."""
    log = fx.people_log(spark, d)
    ends = N.log_ends(log)
    commits = O.commit(log, "people.grp")
    left = M.apply_retention(log, 0, F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S)))
    ends = N.after_retention(ends, left)
    written = _published_people(spark, d, left, ends)
    return record_view(O.resume(left.unionByName(written.select(log.columns)), commits,
                                "people.grp", "earliest"))


def list_groups(spark, d):
    """O3: groups with their partition counts."""
    return O.list_groups(_groups(spark, d)[1])


def _plans(spark, d):
    log, commits = _groups(spark, d)
    out = None
    for mode, arg, parts in RESETS:
        p = O.plan_reset(log, commits, "g0", mode, arg, "events", parts).withColumn(
            "mode", F.lit(mode))
        out = p if out is None else out.unionByName(p)
    return log, commits, out


def plan_reset(spark, d):
    """Dry-run reset targets for all five modes."""
    return _plans(spark, d)[2]


def apply_reset(spark, d):
    """Commits after executing a to-datetime reset."""
    log, commits = _groups(spark, d)
    plan = O.plan_reset(log, commits, "g0", "to-datetime", RESET_DATETIME, "events")
    return O.apply_reset(commits, plan)


def replay_after_reset(spark, d):
    """O5 then O2 then M5: g0 has consumed 60 %; its positions are reset to a
    datetime, the replay is read, and the union with what was consumed is
    de-duplicated: the whole log again, each record once."""
    log = _events(spark, d)
    commits = fx.commits_g0(log)
    plan = O.plan_reset(log, commits, "g0", "to-datetime", RESET_DATETIME, "events")
    replay = O.resume(log, O.apply_reset(commits, plan), "g0", "earliest")
    seen = O.consumed(log, commits, "g0")
    rest = O.resume(log, commits, "g0", "earliest")
    return record_view(M.dedupe(seen.unionByName(replay).unionByName(rest)))


def incremental_run(spark, d):
    """An enabled run reads only records after the bookmark."""
    log, commits = _groups(spark, d)
    rows, _ = O.run_incremental(log, commits, "g1", "enabled")
    return record_view(rows)


def incremental_bookmarks(spark, d):
    """Bookmarks after a run in each mode."""
    log, commits = _groups(spark, d)
    out = None
    for mode in O.BOOKMARK_MODES:
        _, marks = O.run_incremental(log, commits, "g1", mode)
        marks = marks.withColumn("mode", F.lit(mode))
        out = marks if out is None else out.unionByName(marks)
    return out


def consume_people(spark, d):
    """3.3: resume, unframe, resolve to v2, validate, print, commit."""
    log = fx.people_mixed_log(spark, d)
    commits = fx.commits_at(log, "people.grp", 5)
    rows = C.unframe(O.resume(log, commits, "people.grp", "earliest"))
    people = K.accepted(C.read_with_schema(rows, "schema_id",
                                           {1: C.PERSON_V1, 2: C.PERSON_V2}, C.PERSON_V2))
    people = people.withColumn("key_text", F.decode("key", "UTF-8"))
    return K.message_lines(people, PERSON_LINE, "first_name", "last_name", "title",
                           "key_text", "partition", "offset")


def consume_commits(spark, d):
    """O1 in the consume flow: positions after processing."""
    log = fx.people_mixed_log(spark, d)
    commits = fx.commits_at(log, "people.grp", 5)
    rows = O.resume(log, commits, "people.grp", "earliest")
    return O.advance(commits, rows, "people.grp")


# --- committed logs, sequences, prefixes, histories ------------------------------

def read_from_timestamp_indexed(spark, d):
    """S4 by the index of a committed log: starts without a scan of records, and
    only the files that hold what is read."""
    return record_view(fx.events_committed(spark, d).read_from_timestamp(SINCE_MS, "events"))


def plan_reset_indexed(spark, d):
    """O4 by the kept ends and the index, in all five modes."""
    log, commits = _groups(spark, d)
    committed = fx.events_committed(spark, d)
    out = None
    for mode, arg, parts in RESETS:
        p = committed.plan_reset(commits, "g0", mode, arg, "events", parts).withColumn("mode", F.lit(mode))
        out = p if out is None else out.unionByName(p)
    return out


def compact_incremental(spark, d):
    """M2 step by step: a head cleaned up to 40 %, then 70 %, then all of a
    committed log's events, rewriting the buckets that each tail touches."""
    log = fx.events_committed(spark, d)
    path = new_folder(spark, "compacted")
    for tenths in (4, 7, 10):
        upto = fx.commits_at(log.records(), "upto", tenths).select(*TP, F.col("offset").alias("_upto"))
        IC.compact_step(spark, path, log.records().join(F.broadcast(upto), TP).filter(    # one row a partition
            F.col("offset") < F.col("_upto")).drop("_upto"))
    out = C.decode_json(IC.compacted(spark, path), EVENT)
    return out.select("partition", F.decode("key", "UTF-8").alias("key"), "offset", "event_type")


def _sends_seen(spark, d):
    sends = stored(fx.sequenced_records(spark, d))
    first = sends.filter(F.col("arrival") < SENT_UPTO)
    return sends, first, SQ.received(first)


def dedupe_by_sequence(spark, d):
    """M5 by producer sequence in two runs: the second is de-duplicated against
    the ranges that the first received."""
    sends, first, seen = _sends_seen(spark, d)
    rest = sends.filter(F.col("arrival") >= SENT_UPTO)
    both = SQ.accepted(first).withColumn("run", F.lit(1)).unionByName(
        SQ.accepted(rest, seen).withColumn("run", F.lit(2)))
    return both.select("producer", "partition", "sequence", "offset", "event_id", "late", "run")


def sequence_gaps(spark, d):
    """M5: the sequence numbers that no producer's partition received, from the
    ranges of two runs put together."""
    sends, _, seen = _sends_seen(spark, d)
    rest = SQ.received(sends.filter(F.col("arrival") >= SENT_UPTO))
    return SQ.missing(SQ.merged(seen, rest)).select("producer", "partition", "first_missing", "last_missing")


def commit_prefix(spark, d):
    """O1 with failures: processing failed on some errors; the group commits the
    gap-free prefix after its positions."""
    log = _events(spark, d)
    starts = fx.commits_at(log, "g0", 3).select("topic", "partition", F.col("offset").alias("start_offset"))
    processed = K.accepted(C.decode_json(log, EVENT)).filter(
        ~((F.col("event_type") == "error") & (F.col("value") > FAILS_ABOVE)))
    return O.commit_prefix(processed, starts, "g0")


def commit_prefix_compacted(spark, d):
    """O1 over a compacted log: offsets that compaction removed are no gaps."""
    log = M.compact(_events(spark, d))
    starts = fx.commits_at(_events(spark, d), "g0", 3).select(
        "topic", "partition", F.col("offset").alias("start_offset"))
    processed = log.filter(F.col("offset") % 50 != 49)
    return O.commit_prefix(processed, starts, "g0", log)


def _typed_people(spark, d):
    return C.unframe(fx.people_typed_log(spark, d))


def read_with_defaults(spark, d):
    """C5 with types and defaults: ages written as int, double or string are read
    as double (a string can't be), a nickname that a writer lacks is "zz"."""
    out = C.read_with_schema(_typed_people(spark, d), "schema_id", C.TYPED_WRITERS, C.TYPED_READER)
    return out.select("partition", "offset", "schema_id", "name", "age", "nick", C.ERROR)


def compat_audit_types(spark, d):
    """C6 with field types: candidates that read age as int, double or string."""
    return C.typed_audit(_typed_people(spark, d), [C.TYPED_READER, C.TYPED_INT, C.TYPED_STRING])


def with_uuid_checked(spark, d):
    """P3 production form: how many random ids there are, how many are distinct,
    and how many are well-formed version 4 ids."""
    ids = with_uuid(spark, d)
    form = F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return ids.agg(F.count("id").alias("ids"), F.countDistinct("id").alias("distinct_ids"),
                   F.count_if(form).alias("well_formed"))


def write_topic_keyless(spark, d):
    """K1 without keys and with the default placement: greetings published as
    plain strings. Placement follows the value; its offsets are dense in
    (conv_id, turn) order in every partition."""
    cv = fx.table(spark, d, "conversations")
    out = K.write_topic(cv, "greetings.plain", F.lit(None), F.encode("text", "UTF-8"), ["conv_id", "turn"],
                        timestamp=F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S)), keep=["conv_id", "turn"])
    ordered = Window.partitionBy("value").orderBy("conv_id", "turn")
    by_value = out.withColumn("_before", F.lag(F.struct("partition", "offset")).over(ordered))
    # What doesn't depend on the hash: sizes, and equal values in one place, in order.
    return by_value.agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("partition").alias("partitions"),
        F.count_distinct("partition", "offset").alias("positions"),
        F.count_if(F.col("partition").isin(0, 1, 2)).alias("placed"), F.count("key").alias("keys"),
        F.count_if((F.col("_before.partition") != F.col("partition"))
                   | (F.col("_before.offset") >= F.col("offset"))).alias("misplaced"))


def write_topic_string_order(spark, d):
    """K1 in the order of a string column with ties, nulls first: people by their
    segment, and within one by their id."""
    cu = fx.table(spark, d, "customer").withColumn("segment", F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")))
    out = K.write_topic(cu, "people.sorted", "c_name", "c_mktsegment", ["segment", "c_custkey"], method="md5",
                        timestamp=F.timestamp_seconds(F.lit(REPUBLISH_EPOCH_S)), keep=["c_custkey"])
    return out.select("c_custkey", "partition", "offset")


def running_count_null_time(spark, d):
    """A3 where some events have no time: they come first, in position order."""
    it = _greeting_items(spark, d).withColumn(
        "timestamp", F.when(F.col("offset") % 7 != 3, F.col("timestamp")))
    out = A.running_count(it, "greeter", ["timestamp", "partition", "offset"])
    return out.select("partition", "offset", "greeter", "count")


def table_changes(spark, d):
    """K6 after each update: the change log of the greetings table."""
    out = H.table_changes(_greeting_items(spark, d).select("greeter", "timestamp", "partition", "offset"),
                          "greeter", ["timestamp", "partition", "offset"])
    return out.select("version", "greeter", "count")


def table_versions(spark, d):
    """K6: the whole table after given updates, from the stored versions."""
    items = _greeting_items(spark, d).select("greeter", "timestamp", "partition", "offset")
    path = new_folder(spark, "history")
    H.save_history(items, "greeter", ["timestamp", "partition", "offset"], path, HISTORY_EVERY)
    out = None
    for v in TABLE_VERSIONS:
        t = H.table_at(spark, path, "greeter", v, HISTORY_EVERY).withColumn("version", F.lit(v).cast("long"))
        out = t if out is None else out.unionByName(t)
    return out


def table_snapshots(spark, d):
    """K6: the whole table at ten instants, from one scan of the greetings."""
    out = H.table_snapshots(_greeting_items(spark, d), "greeter", [
        datetime.fromtimestamp(fx.EPOCH_S + 300 * k, timezone.utc) for k in range(10)])
    return out.withColumn("at", wall_clock("at"))


QUERIES: dict[str, Query] = {
    "count_greetings": count_greetings,
    "read_from_earliest": read_from_earliest,
    "read_from_latest": read_from_latest,
    "read_from_offsets": read_from_offsets,
    "read_from_timestamp": read_from_timestamp,
    "read_from_datetime": read_from_datetime,
    "read_topics": read_topics,
    "read_keyed_lines": read_keyed_lines,
    "read_raw_strings": read_raw_strings,
    "generate_records": generate_records,
    "generate_people": generate_people,
    "generate_greetings": generate_greetings,
    "generate_greeting_words": generate_greeting_words,
    "ticks": ticks,
    "write_topic": write_topic,
    "delivery_receipts": delivery_receipts,
    "dead_letters": dead_letters,
    "items_rejects": items_rejects,
    "dead_letters_rejects": dead_letters_rejects,
    "keyed_lines_rejects": keyed_lines_rejects,
    "compact_tombstones": compact_tombstones,
    "keyed_lines": keyed_lines,
    "message_lines": message_lines,
    "raw_greeting_lines": raw_greeting_lines,
    "table_snapshot": table_snapshot,
    "encode_json": encode_json,
    "decode_json": decode_json,
    "decode_utf8": decode_utf8,
    "validate_record": validate_record,
    "read_with_schema": read_with_schema,
    "compat_audit": compat_audit,
    "message_key": message_key_q,
    "title_case": title_case_q,
    "with_id": with_id,
    "with_uuid": with_uuid,
    "items": items,
    "rekey": rekey,
    "count_by_key": count_by_key,
    "running_count": running_count,
    "lookup_count": lookup_count,
    "apply_retention": apply_retention,
    "compact": compact,
    "assign_partition": assign_partition,
    "assign_partition_producer": assign_partition_producer,
    "topic_stats": topic_stats,
    "list_topics": list_topics,
    "dedupe": dedupe,
    "dedupe_by_id": dedupe_by_id,
    "commit": commit,
    "resume": resume,
    "group_lag": group_lag,
    "group_lag_uncommitted": group_lag_uncommitted,
    "publish_after_retention": publish_after_retention,
    "list_groups": list_groups,
    "plan_reset": plan_reset,
    "apply_reset": apply_reset,
    "replay_after_reset": replay_after_reset,
    "incremental_run": incremental_run,
    "incremental_bookmarks": incremental_bookmarks,
    "consume_people": consume_people,
    "consume_commits": consume_commits,
    "read_from_timestamp_indexed": read_from_timestamp_indexed,
    "plan_reset_indexed": plan_reset_indexed,
    "compact_incremental": compact_incremental,
    "dedupe_by_sequence": dedupe_by_sequence,
    "sequence_gaps": sequence_gaps,
    "commit_prefix": commit_prefix,
    "commit_prefix_compacted": commit_prefix_compacted,
    "read_with_defaults": read_with_defaults,
    "compat_audit_types": compat_audit_types,
    "with_uuid_checked": with_uuid_checked,
    "write_topic_keyless": write_topic_keyless,
    "write_topic_string_order": write_topic_string_order,
    "running_count_null_time": running_count_null_time,
    "table_changes": table_changes,
    "table_versions": table_versions,
    "table_snapshots": table_snapshots,
}


def _live() -> dict[str, Query]:
    return {f.__name__: f for f in (
        live.live_count_greetings, live.live_running_count, live.live_running_count_split,
        live.live_read_from_latest, live.live_incremental_paused, live.live_publish_after_retention)}


QUERIES.update(_live())

# Queries whose result is not repeatable (random ids): rows-only check.
ROWS_ONLY = {"with_uuid"}
