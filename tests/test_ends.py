"""Log ends that outlive the records, and runs that stop at pinned ends."""

from pyspark.sql import functions as F

from conftest import log_rows

from tidelog.log import TP
from tidelog.operators import ends as N
from tidelog.operators import maintenance as M
from tidelog.operators import positions as O
from tidelog.sinks.writes import append_log, write_topic
from tidelog.sources.topics import open_log


def _log(spark):
    return log_rows(spark, [("a", "1", "t", 0, 0, "2024-01-01T00:00:00"),
                            ("a", "2", "t", 0, 1, "2024-01-02T00:00:00"),
                            ("b", "3", "t", 1, 0, "2024-01-03T00:00:00")])


def _rows(df):
    return {(r.topic, r.partition): (r.start_offset, r.end_offset) for r in df.collect()}


def test_retention_moves_the_start_only(spark):
    log = _log(spark)
    ends = N.log_ends(log)
    some = log.filter("offset = 1 OR partition = 1")
    assert _rows(N.after_retention(ends, some)) == {("t", 0): (1, 2), ("t", 1): (0, 1)}
    none = N.after_retention(ends, log.limit(0))
    assert _rows(none) == {("t", 0): (2, 2), ("t", 1): (1, 1)}
    assert _rows(N.known_bounds(log.limit(0), none)) == _rows(none)


def test_publish_after_everything_expired_gives_new_offsets(spark):
    log = _log(spark)
    commits = O.commit(log, "g")
    left = M.apply_retention(log, 0, "2030-01-01 00:00:00")
    ends = N.after_retention(N.log_ends(log), left)
    more = spark.createDataFrame([(i, f"k{i}", f"v{i}") for i in range(4)], "i int, k string, v string")
    written = write_topic(more, "t", "k", "v", ["i"], existing=left, partitions=2, ends=ends)
    assert O.resume(written, commits, "g", "earliest").count() == 4
    moved = _rows(N.with_written(ends, written))
    assert sum(e for _, e in moved.values()) == 3 + 4
    assert {k: s for k, (s, _) in moved.items()} == {("t", 0): 2, ("t", 1): 1}


def test_kept_ends_round_trip(spark, scratch):
    path = f"{scratch}/ends"
    assert N.load_ends(spark, path).count() == 0
    ends = N.log_ends(_log(spark))
    N.save_ends(ends, path, 1)
    N.save_ends(ends.withColumn("end_offset", F.col("end_offset") + 5), path, 2)
    assert _rows(N.load_ends(spark, path)) == {("t", 0): (0, 7), ("t", 1): (0, 6)}


def test_lag_lists_uncommitted_and_emptied_partitions(spark):
    log = _log(spark)
    commits = O.commit(log.filter("partition = 0 AND offset = 0"), "g")
    kept = log.filter("partition = 1")
    lag = O.group_lag(kept, commits, N.after_retention(N.log_ends(log), kept), uncommitted=True)
    assert sorted((r.partition, r.current_offset, r.log_end_offset, r.lag) for r in lag.collect()) == [
        (0, 1, 2, 1), (1, None, 1, None)]


def test_reset_plans_an_emptied_partition(spark):
    log = _log(spark)
    kept = log.filter("partition = 1")
    ends = N.after_retention(N.log_ends(log), kept)
    plan = O.plan_reset(kept, O.commit(log, "g"), "g", "to-earliest", topic="t", ends=ends)
    assert {r.partition: r.target_offset for r in plan.collect()} == {0: 2, 1: 0}


def test_records_that_arrive_during_a_run_are_left_to_the_next(spark, scratch):
    path = f"{scratch}/log"
    append_log(_log(spark), path)
    commits = spark.createDataFrame([], "group string, topic string, partition int, offset long")
    first = open_log(spark, path)
    rows, marks = O.run_incremental(first, commits, "job", "enabled")
    append_log(log_rows(spark, [("a", "9", "t", 0, 2, "2024-01-04T00:00:00"),
                                ("c", "9", "t", 2, 0, "2024-01-04T00:00:00")]), path)
    spark.catalog.refreshByPath(path)
    assert rows.count() == 3
    saved = [tuple(r) for r in marks.select("group", *TP, "offset").collect()]
    assert sorted(saved) == [("job", "t", 0, 2), ("job", "t", 1, 1)]
    again, _ = O.run_incremental(open_log(spark, path), spark.createDataFrame(
        saved, "group string, topic string, partition int, offset long"), "job", "enabled")
    assert sorted((r.partition, r.offset) for r in again.collect()) == [(0, 2), (2, 0)]
