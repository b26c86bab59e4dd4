import pytest
from pyspark.sql import functions as F

from tidelog.operators import maintenance as M
from tidelog.operators import positions as O

from conftest import log_rows


def _log(spark):
    rows = [(f"k{o}", f"v{o}", "t", p, o + 5 * p, f"2024-01-01 00:00:{o:02d}")
            for p in range(2) for o in range(6)]
    return log_rows(spark, rows)


def _commits(spark, rows):
    return spark.createDataFrame(rows, O.COMMITS_SCHEMA if hasattr(O, "COMMITS_SCHEMA")
                                 else "group string, topic string, partition int, offset long")


def test_commit_is_last_plus_one(spark):
    log = _log(spark)
    c = {r.partition: r.offset for r in O.commit(log.filter(F.col("offset") < 8), "g").collect()}
    assert c == {0: 6, 1: 8}


def test_resume_policies(spark):
    log = _log(spark)
    commits = _commits(spark, [("g", "t", 0, 4)])
    got = sorted((r.partition, r.offset) for r in O.resume(log, commits, "g", "earliest").collect())
    assert got == [(0, 4), (0, 5)] + [(1, o) for o in range(5, 11)]
    latest = sorted((r.partition, r.offset) for r in O.resume(log, commits, "g").collect())
    assert latest == [(0, 4), (0, 5)]
    with pytest.raises(ValueError):
        O.resume(log, commits, "g", "none")


def test_group_lag(spark):
    log = _log(spark)
    commits = _commits(spark, [("g", "t", 0, 4), ("h", "t", 1, 11)])
    out = {(r.group, r.partition): (r.current_offset, r.log_end_offset, r.lag)
           for r in O.group_lag(log, commits).collect()}
    assert out == {("g", 0): (4, 6, 2), ("h", 1): (11, 11, 0)}


def test_plan_reset_clamps_and_times(spark):
    log = _log(spark)
    commits = _commits(spark, [("g", "t", 0, 4)])

    def plan(mode, arg=None, parts=None):
        return {r.partition: (r.current_offset, r.target_offset)
                for r in O.plan_reset(log, commits, "g", mode, arg, "t", parts).collect()}
    assert plan("to-offset", 2) == {0: (4, 2), 1: (None, 5)}          # below start -> start
    assert plan("to-offset", 99) == {0: (4, 6), 1: (None, 11)}        # beyond end -> end
    assert plan("to-offset", 5, [0]) == {0: (4, 5)}
    assert plan("to-earliest") == {0: (4, 0), 1: (None, 5)}
    assert plan("to-latest") == {0: (4, 6), 1: (None, 11)}
    assert plan("to-datetime", "2024-01-01T00:00:03Z") == {0: (4, 3), 1: (None, 8)}
    assert plan("to-timestamp", O.epoch_ms_of("2030-01-01T00:00:00Z")) == {0: (4, 6), 1: (None, 11)}
    with pytest.raises(ValueError):
        O.plan_reset(log, commits, "g", "shift-by")


def test_apply_reset_then_replay(spark):
    log = _log(spark)
    commits = _commits(spark, [("g", "t", 0, 4), ("other", "t", 0, 1)])
    plan = O.plan_reset(log, commits, "g", "to-earliest", topic="t")
    new = {(r.group, r.partition): r.offset for r in O.apply_reset(commits, plan).collect()}
    assert new == {("g", 0): 0, ("g", 1): 5, ("other", 0): 1}
    replay = O.resume(log, O.apply_reset(commits, plan), "g")
    both = log.unionByName(replay)
    assert M.dedupe(both).count() == log.count() == replay.count()


def test_run_incremental_modes(spark):
    log = _log(spark)
    commits = _commits(spark, [("job", "t", 0, 4)])
    rows, marks = O.run_incremental(log, commits, "job", "enabled")
    assert rows.count() == 2 + 6
    assert {r.partition: r.offset for r in marks.collect()} == {0: 6, 1: 11}
    rows2, marks2 = O.run_incremental(log, marks, "job", "enabled")
    assert rows2.count() == 0 and {r.partition: r.offset for r in marks2.collect()} == {0: 6, 1: 11}
    rows, same = O.run_incremental(log, commits, "job", "paused")
    assert rows.count() == 8 and same.collect() == commits.collect()
    rows, same = O.run_incremental(log, commits, "job", "Disabled")
    assert rows.count() == 12 and same.collect() == commits.collect()
    with pytest.raises(ValueError):
        O.run_incremental(log, commits, "job", "sometimes")


def test_bookmark_option_names():
    assert O.bookmark_mode("job-bookmark-pause") == "paused"
    assert O.bookmark_mode(" Enabled ") == "enabled"
    with pytest.raises(ValueError):
        O.bookmark_mode("job-bookmark-sometimes")


def test_reset_creates_commits_for_a_new_group(spark):
    log = _log(spark)
    commits = _commits(spark, [("other", "t", 0, 3)])
    plan = O.plan_reset(log, commits, "fresh", "to-latest", topic="t")
    assert {r.partition: r.current_offset for r in plan.collect()} == {0: None, 1: None}
    new = {(r.group, r.partition): r.offset for r in O.apply_reset(commits, plan).collect()}
    assert new == {("other", 0): 3, ("fresh", 0): 6, ("fresh", 1): 11}


def test_commit_beyond_the_end_reads_nothing(spark):
    log = _log(spark)
    commits = _commits(spark, [("g", "t", 0, 99), ("g", "t", 1, 11)])
    assert O.resume(log, commits, "g", "earliest").count() == 0
    lag = {r.partition: r.lag for r in O.group_lag(log, commits).collect()}
    assert lag == {0: 6 - 99, 1: 0}


def test_bookmarks_persist_between_runs(spark):
    import tempfile
    from pyspark.sql import functions as F
    path = tempfile.mkdtemp(prefix="tidelog-bm-", dir="/tmp") + "/bookmarks"
    log = _log(spark)
    # the first three records of each partition (offsets 0-5 and 5-10)
    part1 = log.filter(((F.col("partition") == 0) & (F.col("offset") < 3))
                       | ((F.col("partition") == 1) & (F.col("offset") < 8)))
    assert O.load_bookmarks(spark, path).count() == 0
    rows, marks = O.run_incremental(part1, O.load_bookmarks(spark, path), "job", "enabled")
    assert rows.count() == part1.count()
    O.save_bookmarks(marks, path, 1)
    rows, marks = O.run_incremental(log, O.load_bookmarks(spark, path), "job", "paused")
    assert rows.count() == log.count() - part1.count()
    O.save_bookmarks(marks, path, 2)                       # paused: unchanged
    rows, marks = O.run_incremental(log, O.load_bookmarks(spark, path), "job", "enabled")
    assert rows.count() == log.count() - part1.count()
    O.save_bookmarks(marks, path, 3)
    rows, _ = O.run_incremental(log, O.load_bookmarks(spark, path), "job", "enabled")
    assert rows.count() == 0
    rows, _ = O.run_incremental(log, O.load_bookmarks(spark, path), "job", "disabled")
    assert rows.count() == log.count()
