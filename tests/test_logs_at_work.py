"""Incremental compaction, sequences, prefixes, typed schemas and histories
against plain Python."""

import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import commits, scan
from tidelog.committed import CommittedLog
from tidelog.operators import compaction as IC
from tidelog.operators import history as H
from tidelog.operators import maintenance as M
from tidelog.operators import positions as O
from tidelog.operators import sequences as SQ
from tidelog.operators import serde as C
from tidelog.plans import fixtures as fx
from tidelog.session import sweep

from conftest import SF_CHECK, log_rows


def _rows(df):
    return sorted((r.topic, r.partition, r.offset, bytes(r.key), bytes(r.value)) for r in df.collect())


def _random_log(spark, seed, n=400):
    rnd = random.Random(seed)
    ends, rows = {}, []
    for k in range(n):
        tp = (rnd.choice("ab"), rnd.randrange(2))
        key = None if rnd.random() < .05 else rnd.choice(["hot"] * 20 + [f"k{i}" for i in range(40)])
        value = None if rnd.random() < .15 else f"v{k}"
        rows.append((key, value, *tp, ends.get(tp, 0), f"2024-01-01 00:{k // 60:02d}:{k % 60:02d}"))
        ends[tp] = ends.get(tp, 0) + 1
    return rows


@pytest.mark.parametrize("bucket_rows", [4_000_000, 5])
def test_incremental_compaction_equals_compact(spark, scratch, monkeypatch, bucket_rows):
    rows = _random_log(spark, 4)
    log = CommittedLog(spark, f"{scratch}/log")
    path, read = f"{scratch}/head", []
    records = CommittedLog.records
    monkeypatch.setattr(CommittedLog, "records", lambda self, files=None: (
        read.append(files), records(self, files))[1])
    for k, (lo, hi) in enumerate(((0, 150), (150, 300), (300, 310), (310, 310), (310, 400))):
        if hi > lo:
            log.append(log_rows(spark, rows[lo:hi]))
        before = commits.latest(spark, f"{path}/versions")
        if k == 4:
            monkeypatch.setattr(IC, "BROADCAST_ROWS", 0)
        touched = IC.compact_step(spark, path, log, buckets=4, bucket_rows=bucket_rows)
        whole = log_rows(spark, rows[:hi])
        assert _rows(IC.compacted(spark, path)) == _rows(M.compact(whole))
        after = commits.latest(spark, f"{path}/versions")
        if before and before["buckets"] == after["buckets"]:
            for b, head in before["heads"].items():
                assert int(b) in touched or after["heads"][b] == head
    if bucket_rows == 5:
        assert commits.latest(spark, f"{path}/versions")["buckets"] > 4


def test_a_second_step_reads_the_tail_and_its_buckets_only(spark, scratch, monkeypatch):
    log = CommittedLog(spark, f"{scratch}/log")
    first = [(f"k{i}", "v", "t", 0, i, "2024-01-01") for i in range(300)]
    log.append(log_rows(spark, first))
    IC.compact_step(spark, f"{scratch}/head", log, buckets=16)
    log.append(log_rows(spark, [("k5", "new", "t", 0, 300, "2024-01-02"), ("k6", None, "t", 0, 301, "2024-01-02")]))
    opened, heads = [], []
    records, head = CommittedLog.records, IC._heads
    monkeypatch.setattr(CommittedLog, "records", lambda self, files=None: (
        opened.append(files.agg(F.sum("records")).first()[0]), records(self, files))[1])
    monkeypatch.setattr(IC, "_heads", lambda s, p, state, buckets: (heads.append(buckets), head(s, p, state, buckets))[1])
    touched = IC.compact_step(spark, f"{scratch}/head", log, buckets=16)
    assert opened == [2] and heads == [touched] and 1 <= len(touched) <= 2
    assert IC.compacted(spark, f"{scratch}/head").count() == 299


def _sends(rnd, n):
    """Records of two producers with retries, gaps and reordering: (producer,
    topic, partition, sequence, offset)."""
    out, offset = [], {}
    queue = []
    for seq in range(n):
        for who in ("p", "q"):
            for part in (0, 1):
                if rnd.random() < .1:
                    continue
                for copy in range(1 + (rnd.random() < .3)):
                    queue.append((seq + rnd.randrange(5) + copy * rnd.randrange(30), rnd.random(), who, part, seq))
    for _, _, who, part, seq in sorted(queue):
        out.append((who, "t", part, seq, offset.get(part, 0)))
        offset[part] = offset.get(part, 0) + 1
    return out


@pytest.mark.parametrize("task_rows", [0, 1 << 16])
def test_sequences(spark, monkeypatch, task_rows):
    monkeypatch.setattr(scan, "TASK_ROWS", task_rows)
    rows = _sends(random.Random(8), 60)
    half = {(w, p): [r for r in rows if (r[0], r[2]) == (w, p)] for w in "pq" for p in (0, 1)}
    cut = {k: len(v) // 2 for k, v in half.items()}
    schema = "producer string, topic string, partition int, sequence long, offset long"
    runs = [spark.createDataFrame([r for k, v in half.items() for r in (v[:cut[k]] if t == 0 else v[cut[k]:])], schema)
            for t in (0, 1)]
    seen = SQ.received(runs[0])
    got = [sorted((r.producer, r.partition, r.sequence, r.offset, r.late) for r in df.collect())
           for df in (SQ.accepted(runs[0]), SQ.accepted(runs[1], seen))]
    want, known = [], {}
    for t in (0, 1):
        mine, most = [], {}
        for k, v in half.items():
            for r in (v[:cut[k]] if t == 0 else v[cut[k]:]):
                if (k, r[3]) in known:
                    continue
                known[k, r[3]] = r[4]
                mine.append((r[0], r[2], r[3], r[4], r[3] < most.get(k, -1)))
                most[k] = max(most.get(k, -1), r[3])
        want.append(sorted(mine))
    assert got == want
    ranges = SQ.merged(seen, SQ.received(runs[1]))
    whole = SQ.received(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, ranges.collect())) == sorted(map(tuple, whole.collect()))
    gaps = {(r.producer, r.partition, s) for r in SQ.missing(ranges).collect()
            for s in range(r.first_missing, r.last_missing + 1)}
    for k in half:
        there = {s for (who, s) in known if who == k}
        assert {s for w, p, s in gaps if (w, p) == k} == set(range(min(there), max(there))) - there


def test_commit_prefix(spark):
    rnd = random.Random(3)
    done, want, starts = [], [], []
    for p in range(4):
        start = rnd.randrange(20)
        offsets = {o for o in range(120) if rnd.random() < (1 if p == 0 else .97 if p < 3 else 0)}
        done += [("t", p, o) for o in offsets] * 2
        starts.append(("t", p, start))
        at = start
        while at in offsets:
            at += 1
        want.append(("g", "t", p, at))
    df = spark.createDataFrame(done, "topic string, partition int, offset long")
    st = spark.createDataFrame(starts, "topic string, partition int, start_offset long")
    assert sorted(map(tuple, O.commit_prefix(df, st, "g").collect())) == want
    # The log lacks the odd offsets: only even ones can be gaps.
    log = spark.range(120).select(F.lit("t").alias("topic"), F.explode(F.array(*map(F.lit, range(4)))).alias("partition"),
                                  F.col("id").alias("offset")).filter("offset % 2 = 0")
    even = df.filter("offset % 2 = 0")
    got = {r.partition: r.offset for r in O.commit_prefix(even, st, "g", log).collect()}
    have = {(p, o) for _, p, o in done}
    for _, p, start in starts:
        asked = [o for o in range(start, 120) if o % 2 == 0]
        failed = [o for o in asked if (p, o) not in have]
        ok = [o for o in asked if (p, o) in have]
        assert got[p] == (min(max(ok) + 1, failed[0] if failed else 1 << 40) if ok else start)


def test_defaults_and_promotions(spark):
    reader = C.schema_from_avro(
        '{"type": "record", "name": "R", "fields": [{"name": "a", "type": "double"}, '
        '{"name": "b", "type": "string", "default": "zz"}, {"name": "c", "type": ["null", "long"], "default": null}, '
        '{"name": "d", "type": "bytes", "default": "\\u00ff"}]}')
    assert dict(reader.defaults) == {"b": "zz", "d": b"\xff"} and reader.required == ("a",)
    w = {1: C.RecordSchema("w", (("a", T.IntegerType()),), ("a",)),
         2: C.RecordSchema("w", (("a", T.StringType()), ("c", T.IntegerType())), ("a",)),
         3: C.RecordSchema("w", (("a", T.LongType()), ("b", T.BinaryType()), ("c", T.IntegerType()), ("d", T.StringType())),
                           ("a",))}
    df = spark.createDataFrame(
        [(1, '{"a": 4}'), (2, '{"a": "x", "c": 1}'), (3, '{"a": 5, "b": "hey", "c": 7, "d": "é"}'), (1, '{"a": "no"}'),
         (3, '{"a": 6, "b": null, "c": null, "d": null}')], "v int, j string").withColumn("payload", F.encode("j", "UTF-8"))
    got = [(r.a, r.b, r.c, None if r.d is None else bytes(r.d), r.error)
           for r in C.read_with_schema(df, "v", w, reader).collect()]
    assert got[0] == (4.0, "zz", None, b"\xff", None)
    assert got[1][0] is None and got[1][2] == 1 and got[1][4] == "cannot read string as double: a"
    assert got[2] == (5.0, "hey", 7, "é".encode(), None)
    assert got[3][4] == "not a int: a"
    assert got[4] == (6.0, None, None, None, None)
    assert C.readable_as(T.IntegerType(), T.DoubleType()) and not C.readable_as(T.IntegerType(), T.StringType())
    assert not C.readable_as(T.DoubleType(), T.LongType()) and C.readable_as(T.StringType(), T.BinaryType())


def test_typed_audit(spark):
    df = spark.createDataFrame([(j,) for j in (
        '{"name": "a", "age": 1}', '{"age": 2, "name": "b"}', '{"name": "a", "age": "1"}', '{"name": null, "age": 1.5}',
        '{"name": "a"}', '{"a:b": true, "name": "x", "age": 9e2}', "[1]", "{oops")], "j string").withColumn(
            "payload", F.encode("j", "UTF-8"))
    out = {(r.candidate, r.shape): (r.records, r.missing_required, r.unreadable, r.compatible)
           for r in C.typed_audit(df, [C.TYPED_INT, C.TYPED_STRING, C.TYPED_READER]).collect()}
    assert out["PersonInt", "age:integer,name:string"] == (2, "", "", True)
    assert out["PersonString", "age:integer,name:string"] == (2, "", "age", False)
    assert out["PersonString", "age:string,name:string"] == (1, "", "", True)
    assert out["PersonDouble", "age:number,name:null"] == (1, "", "name", False)
    assert out["PersonDouble", "name:string"] == (1, "age", "", False)
    assert out["PersonDouble", "a:b:boolean,age:number,name:string"] == (1, "", "", True)
    assert out["PersonInt", "<unparseable>"] == (2, "", "", False)


def test_tables_after_each_update(spark, scratch):
    items = C.items(fx.greetings_log(spark, SF_CHECK), C.GREETING).select("greeter", "timestamp", "partition", "offset")
    order = ["timestamp", "partition", "offset"]
    H.save_history(items, "greeter", order, f"{scratch}/history", every=50)
    events = [r.greeter for r in items.orderBy(*order).collect()]
    for v in (1, 49, 50, 51, 100, 333, len(events), len(events) + 500):
        want = {g: events[:v].count(g) for g in set(events[:v])}
        assert {r.greeter: r["count"] for r in H.table_at(spark, f"{scratch}/history", "greeter", v, 50).collect()} == want
    at = [datetime.fromtimestamp(fx.EPOCH_S + s, timezone.utc) for s in (1000, 0, 77)]
    got = {}
    for r in H.table_snapshots(items, "greeter", at).collect():
        got.setdefault(r["at"].replace(tzinfo=None), {})[r.greeter] = r["count"]
    for t in at:
        upto = events[:int((t.timestamp() - fx.EPOCH_S) // 5) + 1]
        assert got[t.replace(tzinfo=None)] == {g: upto.count(g) for g in set(upto)}


def test_sweep_deletes_old_intermediate_tables(spark, scratch):
    import os
    for name in ("session/stored-1", "session/ranged-1", "session/fixtures-1", "session/mine", "pipeline-2"):
        spark.range(2).coalesce(1).write.parquet(f"{scratch}/{name}")
    assert sweep(spark, 3600, scratch) == []
    time.sleep(1.1)
    gone = sweep(spark, 0.5, scratch)
    assert sorted(p.rsplit("/", 1)[1] for p in gone) == ["pipeline-2", "ranged-1", "stored-1"]
    assert sorted(os.listdir(f"{scratch}/session")) == ["fixtures-1", "mine"]
