"""Plan properties behind the scale claims, read from executed plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidelog import scan
from tidelog.log import dense_position
from tidelog.operators import maintenance as M
from tidelog.operators import positions as O
from tidelog.operators import state as A
from tidelog.plans import fixtures as fx
from tidelog.sinks import writes as K
from tidelog.sources import topics as S

from conftest import SF_CHECK, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written_log(spark):
    import tempfile
    path = tempfile.mkdtemp(prefix="tidelog-plan-", dir="/tmp") + "/log"
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    staged = ev.select("event_id", F.col("user_id").cast("string").alias("k"),
                       F.col("event_type").alias("v"), "ts")
    K.write_topic(staged, "events", F.encode("k", "UTF-8"), F.encode("v", "UTF-8"),
                  ["event_id"], timestamp="ts", path=path)
    return S.open_log(spark, path)


def test_start_positions_reach_the_scan(spark, written_log):
    q = S.read_from_timestamp(written_log, 1705000000000, "events")
    plan = _plan(q)
    assert re.search(r"PartitionFilters: \[[^\]]*topic", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(offset", plan)
    commits = fx.commits_g0(written_log)
    plan = _plan(O.resume(written_log, commits, "g0", "latest"))
    assert re.search(r"PushedFilters: \[[^\]]*offset", plan)


def test_retention_reaches_the_scan(spark, written_log):
    plan = _plan(M.apply_retention(written_log, 360000, "2024-01-15 00:00:00"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp", plan)


def test_projection_is_pruned(spark, written_log):
    plan = _plan(written_log.select("offset"))
    assert "ReadSchema: struct<offset:bigint>" in plan


def test_ranking_moves_rows_once_and_never_into_one_task(spark, monkeypatch):
    """Rows of hot groups are moved by range into the stored files, and joined
    with a broadcast there; other rows are moved once, by their group's hash."""
    monkeypatch.setattr(scan, "TASK_ROWS", 1500)      # users by event type: one hot type
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").withColumn(
        "p", F.when(F.col("event_type") == "error", F.col("user_id").cast("string")).otherwise(F.col("event_type")))
    for by in ([], ["p"]):
        out = dense_position(ev, by, ["event_id"], "pos")
        out.write.format("noop").mode("overwrite").save()
        plan = _plan(out)
        assert "SinglePartition" not in plan
        assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range)", plan)) == len(by), plan
        assert "row_index" in plan and "SortMergeJoin" not in plan


def test_published_values_move_once(spark):
    staged = spark.read.parquet(f"{SF_CHECK}/events.parquet").select("event_id", "user_id", "props", "ts")
    out = K.write_topic(staged, "events", F.col("user_id").cast("string"), "props", ["event_id"], timestamp="ts")
    plan = _plan(out)
    assert not re.search(r"(?<!Broadcast)Exchange (?:hash|range)", plan), plan


def test_counting_and_compaction_aggregate_before_the_shuffle(spark):
    log = fx.events_log(spark, SF_SMALL)
    assert "partial_max(" in _plan(M.compact(log))
    assert "partial_count" in _plan(A.count_by_key(log, "partition"))
    assert "partial_min_by" in _plan(M.dedupe(log.withColumn("id", F.col("offset") % 7), ["id"]))


# Arrow-batched Python only where declared (the producer's murmur2 placement)
ARROW_PYTHON = {"assign_partition_producer"}


def test_no_query_pairs_rows_or_runs_python_per_row(spark):
    bad = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
    for name, fn in E.queries().items():
        plan = _plan(fn(spark, SF_SMALL))
        assert not [b for b in bad if b in plan], name
        assert ("ArrowEvalPython" in plan) == (name in ARROW_PYTHON), name
