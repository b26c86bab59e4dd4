"""Positions, consumer groups and incremental runs.

Commits are a small DataFrame ``group, topic, partition, offset`` (offset =
next record to read). Start positions are one row per topic partition, so
they are bounded by the partition count, never by the data
(``from_positions``).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..log import TP, pin_small
from ..scan import dense_position
from .ends import known_bounds

POLICIES = ("earliest", "latest")
STARTS_SCHEMA = "topic string, partition int, start_offset long"


def from_positions(log: DataFrame, starts: DataFrame,
                   default: str = "earliest") -> DataFrame:
    """Records at or after ``starts.start_offset`` of their partition.

    Partitions without a start follow ``default``: ``earliest`` keeps all
    their records, ``latest`` keeps none of the current ones.

    The start table has one row per topic partition. Up to ``LOCAL_ROWS``
    rows (checked with a bounded ``limit``) it is collected once and
    broadcast-joined as a local table, so an expensive start computation (a
    time lookup over the log) runs once; beyond that it is checkpointed and
    shuffle-joined. With ``latest`` only listed partitions are read, so a
    coarse bound (listed topics, smallest start) is applied too, which the
    Parquet scan pushes down. (A per-partition literal predicate would push
    down more but costs every row one comparison per partition, and past a
    few dozen partitions defeats code generation.)"""
    if default not in POLICIES:
        raise ValueError(f"unknown start policy: {default}")
    spec, rows = pin_small(starts.select(*TP, F.col("start_offset").cast("long")),
                           STARTS_SCHEMA)
    if rows is not None:
        lo = min((r["start_offset"] for r in rows), default=None)
        topics = sorted({r["topic"] for r in rows})
    else:
        agg = spec.agg(F.min("start_offset").alias("lo"),
                       F.collect_set("topic").alias("topics")).first()
        lo, topics = agg["lo"], list(agg["topics"])
    src = log
    if default == "latest":
        if lo is None:
            return log.limit(0)
        src = log.filter(F.col("topic").isin(topics) & (F.col("offset") >= F.lit(lo)))
    j = src.join(spec, TP, "left")
    cond = F.col("offset") >= F.col("start_offset")
    if default == "earliest":
        cond = cond | F.col("start_offset").isNull()
    return j.filter(cond).drop("start_offset")


def first_at_or_after(log: DataFrame, epoch_ms: int) -> DataFrame:
    """Per partition, the first offset whose timestamp is >= the instant
    (the lookup a consumer does to start from a time). The time predicate is
    a constant, so it reaches the scan."""
    t = F.timestamp_millis(F.lit(int(epoch_ms)))
    return (log.filter(F.col("timestamp") >= t)
            .groupBy(*TP).agg(F.min("offset").alias("start_offset")))


def epoch_ms_of(iso: str) -> int:
    """ISO-8601 instant to epoch milliseconds; no zone means UTC."""
    dt = datetime.fromisoformat(iso.replace("Z", "+00:00"))
    if dt.tzinfo is None:
        dt = dt.replace(tzinfo=timezone.utc)
    return int(round(dt.timestamp() * 1000))


# --- O1 ---------------------------------------------------------------------

def commit(consumed: DataFrame, group: str) -> DataFrame:
    """Next position per partition = last consumed offset + 1."""
    return consumed.groupBy(*TP).agg((F.max("offset") + 1).alias("offset")).select(
        F.lit(group).alias("group"), *TP, "offset")


def commit_prefix(processed: DataFrame, starts: DataFrame, group: str,
                  log: DataFrame | None = None) -> DataFrame:
    """Next position per partition after processing with failures: the end of the
    longest gap-free run of processed records from ``start_offset`` on, so a
    commit never passes a record that wasn't processed. With ``log`` only its
    records count, so offsets that compaction removed are no gaps.

    Without the log, an offset less its rank among those processed is the start
    offset exactly in that run; ranks come from range partitions, so a topic
    partition is no single task."""
    known, _ = pin_small(starts.select(*TP, F.col("start_offset").cast("long")), STARTS_SCHEMA)
    done = processed.select(*TP, "offset").join(known, TP).filter(F.col("offset") >= F.col("start_offset"))
    if log is None:
        ranked = dense_position(done.distinct(), TP, ["offset"], "_pos", few_groups=True)
        upto = ranked.filter(F.col("offset") - F.col("_pos") == F.col("start_offset")).groupBy(*TP).agg(
            (F.max("offset") + 1).alias("_upto"))
    else:
        # The first record of the log that wasn't processed, or the end of all.
        asked = log.select(*TP, "offset").join(known, TP).filter(F.col("offset") >= F.col("start_offset"))
        failed = asked.join(done.select(*TP, "offset"), [*TP, "offset"], "left_anti").groupBy(*TP).agg(
            F.min("offset").alias("_first"))
        ends = done.groupBy(*TP).agg((F.max("offset") + 1).alias("_end"))
        upto = ends.join(failed, TP, "left").select(*TP, F.least("_end", "_first").alias("_upto"))
    return known.join(upto, TP, "left").select(
        F.lit(group).alias("group"), *TP, F.coalesce("_upto", "start_offset").alias("offset"))


def advance(commits: DataFrame, consumed: DataFrame, group: str) -> DataFrame:
    """Commits after ``group`` processed ``consumed``: partitions with new
    records move on, the rest keep their position."""
    new = commit(consumed, group)
    keys = ["group", *TP]
    return (commits.alias("o").join(new.alias("n"), keys, "full")
            .select(*keys, F.coalesce(F.col("n.offset"), F.col("o.offset")).alias("offset")))


# --- O2 ---------------------------------------------------------------------

def resume(log: DataFrame, commits: DataFrame, group: str,
           policy: str = "latest") -> DataFrame:
    """Records at or after the group's committed positions. A partition
    without a commit starts per ``policy`` (the consumer client's default
    reset policy is ``latest``)."""
    starts = commits.filter(F.col("group") == group).select(
        *TP, F.col("offset").alias("start_offset"))
    return from_positions(log, starts, policy)


def consumed(log: DataFrame, commits: DataFrame, group: str) -> DataFrame:
    """Records before the group's committed positions (what it has read).
    Commits are one row per partition, pinned like start positions
    (``from_positions``)."""
    c, _ = pin_small(commits.filter(F.col("group") == group)
                     .select(*TP, F.col("offset").cast("long").alias("_upto")),
                     "topic string, partition int, _upto long")
    return log.join(c, TP).filter(F.col("offset") < F.col("_upto")).drop("_upto")


# --- O3 ---------------------------------------------------------------------

def group_lag(log: DataFrame, commits: DataFrame, ends: DataFrame | None = None,
              uncommitted: bool = False) -> DataFrame:
    """Per group and partition: committed position, log end and lag.

    With ``ends`` (``operators.ends``) partitions without records keep their
    end. With ``uncommitted`` every partition of the topics that a group has
    commits in is listed; one without a commit has no position and no lag."""
    b = known_bounds(log, ends).select(*TP, F.col("end_offset").alias("log_end_offset"))
    rows = commits.join(b, TP, "left")
    if uncommitted:
        listed = commits.select("group", "topic").distinct().join(b, "topic")
        rows = listed.join(commits, ["group", *TP], "full")
    return rows.select("group", *TP, F.col("offset").alias("current_offset"), "log_end_offset",
                       (F.col("log_end_offset") - F.col("offset")).alias("lag"))


def list_groups(commits: DataFrame) -> DataFrame:
    return commits.groupBy("group").agg(F.count(F.lit(1)).alias("partitions"))


# --- O4 ---------------------------------------------------------------------

# The names of the reset modes.
RESET_MODES = ("to-offset", "to-earliest", "to-latest", "to-timestamp", "to-datetime")


def reset_instant(mode: str, arg: int | str | None) -> int | None:
    """The instant of a reset by time, in epoch milliseconds."""
    if mode not in RESET_MODES:
        raise ValueError(f"unknown reset mode: {mode}")
    if mode == "to-timestamp":
        return int(arg)
    return epoch_ms_of(str(arg)) if mode == "to-datetime" else None


def planned(ends: DataFrame, firsts: DataFrame | None, commits: DataFrame, group: str, mode: str,
            arg: int | str | None = None, topic: str | None = None,
            partitions: list[int] | None = None) -> DataFrame:
    """Current and target position per partition of ``ends`` (start_offset,
    end_offset); a reset by time takes ``firsts``, the first offset at or after it."""
    if topic is not None:
        ends = ends.filter(F.col("topic") == topic)
    if partitions is not None:
        ends = ends.filter(F.col("partition").isin(list(partitions)))
    cur = commits.filter(F.col("group") == group).select(*TP, F.col("offset").alias("current_offset"))
    plan = ends.join(cur, TP, "left")
    start, end = F.col("start_offset"), F.col("end_offset")
    if mode == "to-offset":
        target = F.least(F.greatest(F.lit(int(arg)), start), end)
    elif mode == "to-earliest":
        target = start
    elif mode == "to-latest":
        target = end
    else:
        plan = plan.join(firsts.select(*TP, F.col("start_offset").alias("_first")), TP, "left")
        target = F.coalesce(F.col("_first"), end)
    return plan.select(F.lit(group).alias("group"), *TP, "current_offset",
                       target.cast("long").alias("target_offset"))


def plan_reset(log: DataFrame, commits: DataFrame, group: str, mode: str,
               arg: int | str | None = None, topic: str | None = None,
               partitions: list[int] | None = None,
               ends: DataFrame | None = None) -> DataFrame:
    """Dry run of a position reset: current and target per partition.

    The target is clamped to the partition's [start, end]; a time beyond the
    last record targets the end. With ``ends`` (``operators.ends``) partitions
    that retention emptied are planned too. The log's bounds, and for a time
    its first offsets, come from a scan; a committed log
    (``tidelog.committed``) has both in its index."""
    at = reset_instant(mode, arg)

    def scope(df: DataFrame) -> DataFrame:
        if topic is not None:
            df = df.filter(F.col("topic") == topic)
        if partitions is not None:
            df = df.filter(F.col("partition").isin(list(partitions)))
        return df
    scoped = scope(log)
    b = known_bounds(scoped, None if ends is None else scope(ends))
    firsts = None if at is None else first_at_or_after(scoped, at)
    return planned(b, firsts, commits, group, mode, arg)


# --- O5 ---------------------------------------------------------------------

def apply_reset(commits: DataFrame, plan: DataFrame) -> DataFrame:
    """Execute a plan: its partitions take the target position, all other
    commits stay."""
    keys = ["group", *TP]
    p = plan.select(*keys, "target_offset")
    return (commits.join(p, keys, "full")
            .select(*keys, F.coalesce("target_offset", "offset").cast("long").alias("offset")))


# --- J1 ---------------------------------------------------------------------

BOOKMARK_MODES = ("enabled", "paused", "disabled")
# The job option each bookmark mode maps to.
BOOKMARK_OPTIONS = {
    "enabled": "job-bookmark-enable",
    "disabled": "job-bookmark-disable",
    "paused": "job-bookmark-pause",
}


def bookmark_mode(mode: str) -> str:
    """A mode name (``enabled``) or its job option (``job-bookmark-enable``),
    in any case, as the mode name; anything else is an error."""
    m = mode.strip().lower()
    by_option = {v: k for k, v in BOOKMARK_OPTIONS.items()}
    if m in BOOKMARK_OPTIONS:
        return m
    if m in by_option:
        return by_option[m]
    raise ValueError(f"unknown bookmark mode: {mode}")


def run_incremental(log: DataFrame, commits: DataFrame, job: str, mode: str = "disabled",
                    ends: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One run of an incremental job with a bookmark.

    ``enabled``: only records after the bookmark, and the bookmark advances;
    ``paused``: only records after the bookmark, bookmark unchanged;
    ``disabled``: every record, no tracking. Returns (records, bookmarks).
    A partition never seen before is read from its start.

    An enabled run pins the log's ends first (one row per partition); both the
    records and the new bookmark stop there, so records that arrive between
    the two actions are left to the next run, never skipped."""
    mode = bookmark_mode(mode)
    if mode == "disabled":
        return log, commits
    if mode == "paused":
        return resume(log, commits, job, policy="earliest"), commits
    last, _ = pin_small(known_bounds(log, ends).select(
        *TP, F.col("end_offset").alias("_end")), "topic string, partition int, _end long")
    rows = resume(log, commits, job, policy="earliest")
    rows = rows.join(last, TP).filter(F.col("offset") < F.col("_end")).select(log.columns)
    keys = ["group", *TP]
    marks = (commits.join(last.withColumn("group", F.lit(job)), keys, "full")
             .select(*keys, F.greatest("offset", "_end").alias("offset")))
    return rows, marks


def save_bookmarks(commits: DataFrame, path: str, run_id: int) -> None:
    """Persist a run's bookmarks as version ``run=<id>`` (rewritten if the
    run is repeated). Write them after the run's output: a crash in between
    replays the run, never skips records (at-least-once)."""
    commits.select("group", *TP, F.col("offset").cast("long")).write.mode(
        "overwrite").parquet(f"{path.rstrip('/')}/run={int(run_id)}")


def load_bookmarks(spark, path: str) -> DataFrame:
    """The latest saved bookmarks (empty when none were saved yet)."""
    from ..log import COMMITS_SCHEMA
    from ..session import path_exists
    if not path_exists(spark, path):          # nothing saved yet; a failed read raises
        return spark.createDataFrame([], COMMITS_SCHEMA)
    all_runs = spark.read.parquet(path)
    last = all_runs.agg(F.max("run")).first()[0]
    if last is None:
        return spark.createDataFrame([], COMMITS_SCHEMA)
    return all_runs.filter(F.col("run") == last).select("group", *TP, "offset")
