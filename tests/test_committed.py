"""Committed logs: nothing is seen twice or lost, whatever step a writer dies
at, and starts are found without reading records."""

import pytest
from pyspark.sql import functions as F

from tidelog import commits
from tidelog.committed import CommittedLog
from tidelog.commits import VersionTaken
from tidelog.log import bounds
from tidelog.operators import ends as N
from tidelog.operators import positions as O
from tidelog.plans import fixtures as fx
from tidelog.sinks import writes as K
from tidelog.sources import topics as S
from tidelog.streaming import live as L

from conftest import SF_CHECK, log_rows


class Killed(Exception):
    pass


def _batch(spark, lo, hi):
    return spark.range(lo, hi).select(
        "id", F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("k"), F.col("id").cast("string").alias("v"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("at"))


def _publish(spark, path, batch_id, lo, hi):
    return L.publish_batch(_batch(spark, lo, hi), batch_id, "t", "k", "v", ["id"], path, method="md5",
                           publisher="p", timestamp="at")


def _values(spark, path):
    return sorted(int(r.v) for r in S.open_log(spark, path).select(F.decode("value", "UTF-8").alias("v")).collect())


def _dense(spark, path):
    rows = S.open_log(spark, path).groupBy("partition").agg(
        F.min("offset").alias("a"), F.max("offset").alias("z"), F.count("*").alias("n"),
        F.countDistinct("offset").alias("d")).collect()
    return all(r.z - r.a + 1 == r.n == r.d for r in rows)


STEPS = ["receipts", "data", "index", "ends", "draft", "after"]


@pytest.mark.parametrize("step", STEPS)
def test_killed_publishing_gives_no_copy_and_no_gap(spark, scratch, monkeypatch, step):
    """The writer dies at a step of batch 1, then the batch is replayed; retention
    removes every record before batch 2 dies at the same step."""
    path = f"{scratch}/log"
    assert _publish(spark, path, 0, 0, 50)

    def dying(batch_id, lo, hi):
        with monkeypatch.context() as m:
            def die(*a, **k):
                raise Killed
            if step == "receipts":
                m.setattr(K, "write_topic", die)
            elif step == "data":
                m.setattr(CommittedLog, "_stage", die)
            elif step == "index":
                stage = CommittedLog._stage
                m.setattr(CommittedLog, "_stage", lambda self, r: (stage(self, r), die())[0])
            elif step == "ends":
                m.setattr(CommittedLog, "_write", die)
            elif step == "draft":
                m.setattr(CommittedLog, "_commit", die)
            else:
                commit = CommittedLog._commit
                m.setattr(CommittedLog, "_commit", lambda self, s: (commit(self, s), die())[0])
            with pytest.raises(Killed):
                _publish(spark, path, batch_id, lo, hi)
        seen = _values(spark, path)
        replayed = _publish(spark, path, batch_id, lo, hi)
        assert replayed == (step != "after")
        assert seen == (_values(spark, path) if step == "after" else [v for v in _values(spark, path) if v < lo])

    dying(1, 50, 90)
    assert _values(spark, path) == list(range(90)) and _dense(spark, path)
    before = {r.partition: r.end_offset for r in CommittedLog(spark, path).ends().collect()}
    CommittedLog(spark, path).retain(0, F.timestamp_seconds(F.lit(1700000090)))
    assert _values(spark, path) == []
    dying(2, 90, 140)
    assert _values(spark, path) == list(range(90, 140)) and _dense(spark, path)
    first = {r.partition: r.a for r in S.open_log(spark, path).groupBy("partition").agg(F.min("offset").alias("a")).collect()}
    assert all(first[p] == before[p] for p in first)


def test_a_version_is_committed_once(spark, scratch):
    commits.commit(spark, f"{scratch}/commits", 0, {"version": 0})
    with pytest.raises(VersionTaken):
        commits.commit(spark, f"{scratch}/commits", 0, {"version": 0, "other": True})
    assert commits.latest(spark, f"{scratch}/commits") == {"version": 0}
    assert commits.latest(spark, f"{scratch}/nothing") is None


def test_index_folders_are_put_together(spark, scratch, monkeypatch):
    import tidelog.committed as module
    monkeypatch.setattr(module, "FOLD", 3)
    path = f"{scratch}/log"
    for k in range(8):
        assert _publish(spark, path, k, 10 * k, 10 * k + 10)
    log = CommittedLog(spark, path)
    assert len(log.state().index) <= 3 and _values(spark, path) == list(range(80)) and _dense(spark, path)
    assert log.state().batches == {"p": 7}


def test_odd_topic_names_and_empty_batches(spark, scratch):
    log = CommittedLog(spark, f"{scratch}/log")
    rows = log_rows(spark, [("a", "1", "a+b c%d=é", 0, 0, "2024-01-01"), ("b", None, "x/y", 1, 0, "2024-01-02")])
    assert log.append(rows) and log.append(rows.filter("false"))
    assert sorted(r.topic for r in log.records().collect()) == ["a+b c%d=é", "x/y"]
    assert log.records().filter("value IS NULL").count() == 1
    assert CommittedLog(spark, f"{scratch}/none").records().count() == 0
    log.retain(0, F.lit("2030-01-01"))
    assert log.records().count() == 0 and {r.end_offset for r in log.ends().collect()} == {1}


def test_retention_by_files_equals_retention_by_records(spark, scratch):
    log = fx.events_log(spark, SF_CHECK)
    committed = CommittedLog(spark, f"{scratch}/log")
    for k in range(3):
        committed.append(log.filter(F.col("offset") % 3 == k))       # files that overlap
    limit = F.lit("2024-01-15").cast("timestamp")
    committed.retain(360000, limit)
    from tidelog.operators import maintenance as M
    want = M.apply_retention(log, 360000, "2024-01-15 00:00:00")
    cols = ["partition", "offset"]
    assert sorted(map(tuple, committed.records().select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    ends = {r.partition: (r.start_offset, r.end_offset) for r in committed.ends().collect()}
    assert ends == {r.partition: (r.start_offset, r.end_offset)
                    for r in N.after_retention(N.log_ends(log), want).collect()}


def test_starts_by_the_index(spark, monkeypatch):
    log, committed = fx.events_log(spark, SF_CHECK), fx.events_committed(spark, SF_CHECK)
    ms = 1705000000000
    want = sorted(map(tuple, O.first_at_or_after(log, ms).collect()))
    opened = []
    records = CommittedLog.records
    monkeypatch.setattr(CommittedLog, "records", lambda self, files=None: (
        opened.append(None if files is None else files.count()), records(self, files))[1])
    assert sorted(map(tuple, committed.first_at_or_after(ms, "events").collect())) == want
    files = committed.index().count()
    assert opened == [3] and files >= 12                    # one file a partition
    opened.clear()
    # A start in the last quarter opens the last quarter's files only.
    starts = bounds(log).select("topic", "partition", (F.col("end_offset") - 5).alias("start_offset"))
    assert committed.read_from(starts).count() == 15 and opened[-1] <= files // 4
    commits_ = fx.commits_g0(log)
    at = lambda df: sorted(map(tuple, df.select("topic", "partition", "offset").collect()))
    for policy in ("earliest", "latest"):
        some = commits_.filter("partition <> 2")
        assert at(committed.resume(some, "g0", policy)) == at(O.resume(log, some, "g0", policy))
    assert opened[-1] <= files // 2                         # 60 % is behind
    spec = {"events": {0: 3000, 1: S.LATEST}, "other": {0: 5}}
    want3 = [r for r in at(log) if r[2] >= {0: 3000, 1: 1 << 40, 2: 0}[r[1]]]
    assert at(committed.read_from_offsets(spec)) == want3
    opened.clear()
    for mode, arg in (("to-earliest", None), ("to-latest", None), ("to-offset", 7)):
        got = sorted(map(tuple, committed.plan_reset(commits_, "g0", mode, arg).collect()))
        assert got == sorted(map(tuple, O.plan_reset(log, commits_, "g0", mode, arg).collect()))
    assert opened == []                                     # no record was read


def test_followers_see_each_commit_once(spark, scratch):
    path, got = f"{scratch}/log", []
    name = scratch.rsplit("/", 1)[-1].replace("-", "_") + "_follow"
    for k in range(3):
        _publish(spark, path, k, 10 * k, 10 * k + 10)
        if k == 1:
            CommittedLog(spark, path).retain(0, F.timestamp_seconds(F.lit(1700000005)))
        L.follow(spark, path, name, lambda df, _: got.extend(
            int(r.v) for r in df.select(F.decode("value", "UTF-8").alias("v")).collect()), True).awaitTermination()
    assert sorted(got) == list(range(30))


def test_a_plain_log_is_not_taken_for_a_committed_one(spark, scratch):
    K.append_log(log_rows(spark, [("a", "1", "t", 0, 0, "2024-01-01")]), f"{scratch}/log")
    with pytest.raises(ValueError, match="plain files"):
        _publish(spark, f"{scratch}/log", 0, 0, 5)
