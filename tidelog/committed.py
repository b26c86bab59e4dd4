"""Committed logs: a Parquet log whose appends are seen whole or not at all.

    data/append=<id>/topic=<t>/partition=<p>/*.parquet   the records of one append
    index/<id>/                                          one row for each of its files
    ends/<id>/                                           the log's ends after it
    commits/<version>.json                               one small file: the commit

An append writes its records, their index and the new ends into folders of its
own and then one commit file, which names the index folders and the ends that
hold from then on, and the last batch of each named publisher. The file is made
under another name and renamed to its version, which fails if that version is
there. Readers follow the latest commit: what a lost writer left behind is in no
commit, and a batch that was committed isn't committed again.

The index has per file the smallest and largest offset and time, so bounds,
starts and time lookups are found without a scan of records, and files that a
read can't need are not opened. Retention (M1) is a commit that leaves files
out and rewrites those that hold its limit; it moves starts, never ends.

The driver handles names and one commit file; indexes and ends are DataFrames.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits
from .log import LOG_COLUMNS, LOG_SCHEMA, TP, pin_small, to_log
from .operators.ends import ENDS_COLUMNS, ENDS_SCHEMA
from .operators.positions import from_positions, planned, reset_instant
from .session import path_exists

INDEX_SCHEMA = ("file string, topic string, partition int, min_offset long, max_offset long, "
                "min_time timestamp, max_time timestamp, records long")
#: Index folders that a commit names at most; then they are put together.
FOLD = 50


@dataclass
class State:
    """What a commit names: its own append (none for retention), and all that
    holds from then on."""

    version: int = -1
    appended: str | None = None
    index: list[str] = field(default_factory=list)
    ends: str | None = None
    batches: dict[str, int] = field(default_factory=dict)


def is_committed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/commits")


class CommittedLog:
    """A committed log at ``path``; every method looks at its latest commit."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def state(self) -> State:
        found = commits.latest(self.spark, f"{self.path}/commits")
        return State(**found) if found else State()

    def _commit(self, state: State) -> None:
        commits.commit(self.spark, f"{self.path}/commits", state.version, vars(state))

    # --- what is known without reading records -------------------------------------

    def index(self, state: State | None = None) -> DataFrame:
        """One row per file of the log."""
        state = state or self.state()
        if not state.index:
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        return self.spark.read.schema(INDEX_SCHEMA).parquet(*[f"{self.path}/index/{i}" for i in state.index])

    def ends(self, state: State | None = None) -> DataFrame:
        """topic, partition, start_offset, end_offset: kept when records go."""
        state = state or self.state()
        if state.ends is None:
            return self.spark.createDataFrame([], ENDS_SCHEMA)
        return self.spark.read.schema(ENDS_SCHEMA).parquet(f"{self.path}/ends/{state.ends}")

    # --- reading ----------------------------------------------------------------------

    def records(self, files: DataFrame | None = None) -> DataFrame:
        """The records of the given files of the index (None: all of them)."""
        files = self.index() if files is None else files
        # Names of files only; Spark lists them in parallel.
        names = [r.file for r in files.select("file").toLocalIterator()]
        if not names:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return to_log(self.spark.read.schema(LOG_SCHEMA).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/{n}" for n in names]))

    def appended(self, names: list[str]) -> DataFrame:
        """The records of the appends that commits name (those that retention
        has left out since then too, as long as their files are there)."""
        if not names:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.records(self.spark.read.schema(INDEX_SCHEMA).parquet(
            *[f"{self.path}/index/{n}" for n in names]))

    def read_from(self, starts: DataFrame, default: str = "latest",
                  topics: list[str] | None = None) -> DataFrame:
        """Records (of the given topics) at or after ``start_offset`` of their
        partition, from the files that hold any; partitions without a start follow
        ``default``."""
        known, _ = pin_small(starts.select(*TP, F.col("start_offset").cast("long")),
                             "topic string, partition int, start_offset long")
        files = self.index().join(known, TP, "left")
        needed = F.col("max_offset") >= F.col("start_offset")
        if default == "earliest":
            needed = needed | F.col("start_offset").isNull()
        if topics is not None:
            needed = needed & F.col("topic").isin(list(topics))
        return from_positions(self.records(files.filter(needed)), known, default)

    def read_from_offsets(self, spec: dict[str, dict[int, int]]) -> DataFrame:
        """S3 by the index (``{topic: {partition: offset}}``, -2 earliest, -1 the
        kept end); unlisted partitions of a listed topic from their start."""
        asked = self.spark.createDataFrame(
            [(t, int(p), int(o)) for t, parts in spec.items() for p, o in parts.items()],
            "topic string, partition int, start_offset long")
        start = F.when(F.col("start_offset") == -1, F.coalesce("end_offset", F.lit(0))).otherwise(
            F.greatest(F.col("start_offset"), F.lit(0)))
        starts = asked.join(self.ends().select(*TP, "end_offset"), TP, "left").select(
            *TP, start.alias("start_offset"))
        return self.read_from(starts, "earliest", list(spec))

    def resume(self, committed: DataFrame, group: str, policy: str = "latest") -> DataFrame:
        """O2 by the index: records at or after the group's committed positions."""
        starts = committed.filter(F.col("group") == group).select(*TP, F.col("offset").alias("start_offset"))
        return self.read_from(starts, policy)

    def first_at_or_after(self, epoch_ms: int, topic: str | None = None) -> DataFrame:
        """topic, partition, start_offset: the first offset whose time is at or
        after the instant. Offsets of a partition ascend from file to file, so
        its first file that reaches the instant holds it: one file a partition
        is read (more where files overlap)."""
        at = F.timestamp_millis(F.lit(int(epoch_ms)))
        reach = self.index().filter(F.col("max_time") >= at)
        if topic is not None:
            reach = reach.filter(F.col("topic") == topic)
        first = reach.groupBy(*TP).agg(F.min_by("max_offset", F.struct("min_offset", "max_offset")).alias("_upto"))
        near = reach.join(first, TP).filter(F.col("min_offset") <= F.col("_upto"))
        return (self.records(near).filter(F.col("timestamp") >= at)
                .groupBy(*TP).agg(F.min("offset").alias("start_offset")))

    def read_from_timestamp(self, epoch_ms: int, topic: str | None = None) -> DataFrame:
        """S4 by the index: a partition with no such record yields nothing."""
        return self.read_from(self.first_at_or_after(epoch_ms, topic), "latest")

    def plan_reset(self, committed: DataFrame, group: str, mode: str, arg: int | str | None = None,
                   topic: str | None = None, partitions: list[int] | None = None) -> DataFrame:
        """O4 by the ends and the index: no scan of records."""
        at = reset_instant(mode, arg)
        firsts = None if at is None else self.first_at_or_after(at, topic)
        return planned(self.ends(), firsts, committed, group, mode, arg, topic, partitions)

    # --- writing ----------------------------------------------------------------------

    def _stage(self, records: DataFrame) -> tuple[str, DataFrame]:
        """Write records and their index into folders of their own, unseen."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/append={name}"
        (records.select(*LOG_COLUMNS).sortWithinPartitions(*TP, "offset")
         .write.partitionBy(*TP).parquet(folder))
        if not self._any_file(folder):
            own = self.spark.createDataFrame([], INDEX_SCHEMA)
        else:
            staged = self.spark.read.schema(LOG_SCHEMA).option("basePath", f"{self.path}/data").parquet(folder)
            # Offsets and times only are read back.
            # The path is that of a URI, in which a plus sign is one.
            path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
            own = staged.groupBy(F.substring_index(path, "/data/", -1).alias("file"), *TP).agg(
                F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"),
                F.min("timestamp").alias("min_time"), F.max("timestamp").alias("max_time"),
                F.count(F.lit(1)).alias("records"))
        own.write.parquet(f"{self.path}/index/{name}")
        return name, self.spark.read.schema(INDEX_SCHEMA).parquet(f"{self.path}/index/{name}")

    def _any_file(self, folder: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return any(f.isDirectory() for f in fs.listStatus(at))

    def _write(self, kind: str, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/{kind}/{name}")
        return name

    def append(self, records: DataFrame, publisher: str | None = None, batch_id: int | None = None) -> bool:
        """Append log records (offsets given) in one commit. A named publisher's
        batch that was committed before is left out, and False returned."""
        state = self.state()
        if publisher is not None and state.batches.get(publisher, -1) >= batch_id:
            return False
        name, own = self._stage(records)
        moved = own.groupBy(*TP).agg(F.min("min_offset").alias("start_offset"),
                                     (F.max("max_offset") + 1).alias("end_offset"))
        ends = self.ends(state).unionByName(moved).groupBy(*TP).agg(
            F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"))
        new = State(state.version + 1, name, [*state.index, name], self._write("ends", ends.select(*ENDS_COLUMNS)),
                    state.batches | ({publisher: batch_id} if publisher is not None else {}))
        if len(new.index) > FOLD:
            new.index = [self._write("index", self.index(new))]
        self._commit(new)
        return True

    def retain(self, retention_ms: int, now: Column) -> None:
        """M1 in one commit: records older than ``retention_ms`` at ``now`` go.
        Files wholly older are left out, files wholly newer stay as they are,
        and only those that hold the limit are rewritten."""
        state = self.state()
        limit = self.spark.range(1).select(F.timestamp_micros(
            F.unix_micros(now.cast("timestamp")) - F.lit(int(retention_ms) * 1000)).alias("t")).first()["t"]
        files = self.index(state)
        split = files.filter((F.col("min_time") < F.lit(limit)) & (F.col("max_time") >= F.lit(limit)))
        _, rewritten = self._stage(self.records(split).filter(F.col("timestamp") >= F.lit(limit)))
        left = files.filter(F.col("min_time") >= F.lit(limit)).unionByName(rewritten)
        index = self._write("index", left)
        first = self.spark.read.schema(INDEX_SCHEMA).parquet(f"{self.path}/index/{index}").groupBy(*TP).agg(
            F.min("min_offset").alias("_first"))
        ends = self.ends(state).join(first, TP, "left").withColumn(
            "start_offset", F.coalesce("_first", "end_offset")).select(*ENDS_COLUMNS)
        self._commit(State(state.version + 1, None, [index], self._write("ends", ends), state.batches))
