"""Live forms: batch/stream parity, restart on one checkpoint, state across
micro-batches. Logs are written to a fresh scratch folder per test."""

import os
import time

from pyspark.sql import functions as F

from tidelog import scan
from tidelog.log import LOG_COLUMNS
from tidelog.operators import serde as C
from tidelog.operators import state as A
from tidelog.plans import fixtures as fx
from tidelog.sinks.writes import accepted
from tidelog.streaming import live as L

from conftest import SF_CHECK


def _write_parts(log, path, cuts, order="offset"):
    """Append the log in parts (by ``order`` ranges), one file per part, so a
    file source sees them in that order."""
    lo = None
    for hi in cuts + [None]:
        part = log
        if lo is not None:
            part = part.filter(F.col(order) >= lo)
        if hi is not None:
            part = part.filter(F.col(order) < hi)
        part.select(*LOG_COLUMNS).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
        lo = hi


def _name(scratch, what):
    return f"{what}_{os.path.basename(scratch).replace('-', '_')}"


def test_counts_stream_equals_batch(spark, scratch):
    log = fx.events_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    _write_parts(log, path, [3000, 6000])
    events = accepted(C.decode_json(L.log_stream(spark, path, 1), fx.EVENT))
    name = _name(scratch, "counts")
    q = L.start(L.live_counts(events, "event_type"), name, mode="complete", available_now=True)
    q.awaitTermination()
    live = {r.event_type: r["count"] for r in spark.table(name).collect()}
    batch = {r.event_type: r["count"] for r in A.count_by_key(
        accepted(C.decode_json(log, fx.EVENT)), "event_type").collect()}
    assert live == batch


def test_restart_processes_each_record_once(spark, scratch):
    log = fx.events_log(spark, SF_CHECK)
    path, out = f"{scratch}/log", f"{scratch}/out"
    log.filter(F.col("offset") < 2000).coalesce(1).write.parquet(path)
    job = _name(scratch, "job")
    L.run_incremental_live(spark, path, out, job, "enabled")
    first = spark.read.parquet(out).count()
    log.filter(F.col("offset") >= 2000).coalesce(1).write.mode("append").parquet(path)
    L.run_incremental_live(spark, path, out, job, "enabled")
    L.run_incremental_live(spark, path, out, job, "enabled")          # nothing new
    got = spark.read.parquet(out)
    assert first == log.filter(F.col("offset") < 2000).count()
    assert got.count() == log.count()
    assert got.dropDuplicates(["topic", "partition", "offset"]).count() == log.count()


def test_running_count_state_across_batches(spark, scratch):
    log = fx.greetings_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    seq = log.withColumn("_t", F.unix_seconds("timestamp"))
    cuts = [fx.EPOCH_S + 5 * 150, fx.EPOCH_S + 5 * 400]
    _write_parts(seq, path, cuts, order="_t")
    items = accepted(C.items(L.log_stream(spark, path, 1), C.GREETING))
    name = _name(scratch, "running")
    live = L.running_count_stream(items.select("partition", "offset", "timestamp", "greeter"),
                                  "greeter", ["timestamp", "partition", "offset"])
    q = L.start(live, name, mode="append", available_now=True)
    q.awaitTermination()
    got = {(r.partition, r.offset): r["count"] for r in spark.table(name).collect()}
    batch = A.running_count(accepted(C.items(log, C.GREETING)), "greeter",
                            ["timestamp", "partition", "offset"])
    want = {(r.partition, r.offset): r["count"] for r in batch.collect()}
    assert got == want and len(got) == log.count()


def _restarts(spark, scratch, log, source, name):
    """Offsets read by a query that starts on the first third of a log, and is
    restarted after each later third was written while it was down."""
    out = f"{scratch}/out-{name}"
    path = f"{scratch}/log-{name}"
    for lo, hi in ((0, 1000), (1000, 2000), (2000, 1 << 40)):
        log.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).coalesce(1).write.mode("append").parquet(path)
        L.start(source(path), _name(scratch, name), sink="parquet", path=out, available_now=True,
                transform=lambda df: df.select("partition", "offset")).awaitTermination()
    return sorted(map(tuple, spark.read.schema("partition int, offset long").parquet(out).collect()))


def test_live_starts_outlive_restarts(spark, scratch):
    from tidelog.sources import topics as S
    log = fx.events_log(spark, SF_CHECK)
    rows = [tuple(r) for r in log.select("partition", "offset").collect()]
    late = sorted(r for r in rows if r[1] >= 1000)
    assert _restarts(spark, scratch, log, lambda p: L.stream_from_latest(spark, p, "events"), "latest") == late
    spec = {"events": {0: 500, 1: S.LATEST}}
    got = _restarts(spark, scratch, log, lambda p: L.stream_from_offsets(spark, p, spec), "offsets")
    assert got == sorted(r for r in rows if r[1] >= {0: 500, 1: 1000, 2: 0}[r[0]])
    # An instant after all that is there when the query first starts.
    got = _restarts(spark, scratch, log, lambda p: L.stream_from_timestamp(spark, p, "events", 4102444800000), "time")
    assert got == late


def test_greetings_stream_is_repeatable(spark, scratch):
    name = _name(scratch, "greet")
    q = L.start(L.greetings_stream(spark, fx.EPOCH_S, per_batch=4), name, every="0 seconds")
    deadline = time.time() + 60
    while time.time() < deadline and spark.table(name).count() < 12:
        time.sleep(0.5)
    q.stop()
    rows = spark.table(name).orderBy("id").limit(12).collect()
    assert len(rows) == 12
    from tidelog.sources import generators as G
    batch = {r.id: (r.message, r.greeter) for r in
             G.generate_greetings(12, fx.EPOCH_S, spark=spark).collect()}
    assert all(batch[r.id] == (r.message, r.greeter) for r in rows)
    assert [r.timestamp for r in rows][:4] == [rows[0].timestamp] * 4


def test_update_mode_counts_end_at_batch_counts(spark, scratch):
    log = fx.events_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    _write_parts(log, path, [5000])
    events = accepted(C.decode_json(L.log_stream(spark, path, 1), fx.EVENT))
    name = _name(scratch, "upd")
    q = L.start(L.live_counts(events, "event_type"), name, mode="update", available_now=True)
    q.awaitTermination()
    last = {r.event_type: r["m"] for r in
            spark.table(name).groupBy("event_type").agg(F.max("count").alias("m")).collect()}
    batch = {r.event_type: r["count"] for r in A.count_by_key(
        accepted(C.decode_json(log, fx.EVENT)), "event_type").collect()}
    assert last == batch


def test_route_stream_keeps_rejects_apart(spark, scratch):
    log = fx.people_mixed_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    _write_parts(log, path, [500])
    resolved = C.read_with_schema(C.unframe(L.log_stream(spark, path, 1)), "schema_id",
                                  {1: C.PERSON_V1, 2: C.PERSON_V2}, C.PERSON_V1)
    q = L.route_stream(resolved.select("partition", "offset", "name", "title", "error"),
                       _name(scratch, "route"), f"{scratch}/good", f"{scratch}/bad",
                       available_now=True)
    q.awaitTermination()
    good, bad = spark.read.parquet(f"{scratch}/good"), spark.read.parquet(f"{scratch}/bad")
    assert good.count() + bad.count() == log.count()
    assert bad.filter(F.col("error").isNull()).count() == 0
    assert "error" not in good.columns


def test_publish_stream_continues_offsets(spark, scratch):
    src = f"{scratch}/src"
    gen = spark.read.parquet(f"{SF_CHECK}/customer.parquet").select(
        "c_custkey", F.col("c_name").alias("k"), F.col("c_mktsegment").alias("v"))
    gen.filter("c_custkey < 700").coalesce(1).write.parquet(src)
    time.sleep(0.05)
    gen.filter("c_custkey >= 700").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(gen.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = f"{scratch}/log"
    q = L.publish_stream(stream, _name(scratch, "pub"), "people", "k", "v", ["c_custkey"],
                         out, method="md5", available_now=True,
                         receipts_path=f"{scratch}/receipts", receipt_cols=["c_custkey"])
    q.awaitTermination()
    from tidelog.sources.topics import open_log
    got = open_log(spark, out)
    b = got.groupBy("partition").agg(F.min("offset").alias("a"), F.max("offset").alias("z"),
                                     F.count("*").alias("n")).collect()
    assert sum(r.n for r in b) == gen.count()
    assert all(r.a == 0 and r.z == r.n - 1 for r in b)
    receipts = spark.read.parquet(f"{scratch}/receipts")
    landed = receipts.join(got.select("partition", "offset"), ["partition", "offset"])
    assert receipts.count() == landed.count() == gen.count()
    assert receipts.select("c_custkey").distinct().count() == gen.count()


def test_dedupe_stream_drops_replays(spark, scratch):
    log = fx.events_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    log.filter(F.col("offset") < 500).coalesce(1).write.parquet(path)
    time.sleep(0.05)
    log.filter(F.col("offset") < 500).coalesce(1).write.mode("append").parquet(path)   # replay
    live = L.dedupe_stream(L.log_stream(spark, path, 1), ["topic", "partition", "offset"],
                           delay="1 day")
    name = _name(scratch, "dd")
    q = L.start(live.select("partition", "offset"), name, available_now=True)
    q.awaitTermination()
    assert spark.table(name).count() == log.filter(F.col("offset") < 500).count()


def test_records_stream_matches_batch_generator(spark, scratch):
    from tidelog.sources import generators as G
    name = _name(scratch, "recs")
    q = L.start(L.records_stream(spark, per_batch=5), name, every="0 seconds")
    deadline = time.time() + 60
    while time.time() < deadline and spark.table(name).count() < 15:
        time.sleep(0.5)
    q.stop()
    live = {r.id: (r.firstName, r.lastName, r.title, r.key) for r in spark.table(name).collect()}
    batch = {r.id: (r.firstName, r.lastName, r.title, r.key)
             for r in G.generate_records(max(live) + 1, spark=spark).collect()}
    assert len(live) >= 15 and all(batch[i] == v for i, v in live.items())


def test_start_ticks_runs_startup_once_then_intervals(spark, scratch):
    out = f"{scratch}/ticks"
    q = L.start_ticks(spark, _name(scratch, "ticks"), fx.EPOCH_S, out, every_s=1)
    deadline = time.time() + 60
    while time.time() < deadline:
        try:
            if spark.read.text(f"{out}/interval").count() >= 2:
                break
        except Exception:          # noqa: BLE001 - folder not written yet
            pass
        time.sleep(0.5)
    q.stop()
    assert [r.value for r in spark.read.text(f"{out}/startup").collect()] == [
        "A task executing on startup"]
    lines = [r.value for r in spark.read.text(f"{out}/interval").collect()]
    assert len(lines) >= 2 and all(x.startswith("A task executing on interval at 2024-01-01 ")
                                   for x in lines)


def test_running_count_batches_splits_hot_keys(spark, scratch, monkeypatch):
    log = fx.greetings_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    seq = log.withColumn("_t", F.unix_seconds("timestamp"))
    _write_parts(seq, path, [fx.EPOCH_S + 5 * 150, fx.EPOCH_S + 5 * 400], order="_t")
    monkeypatch.setattr(scan, "TASK_ROWS", 40)     # 'user' is a hot key
    items = accepted(C.items(L.log_stream(spark, path, 1), C.GREETING)).select(
        "partition", "offset", "timestamp", "greeter")
    q = L.running_count_batches(items, _name(scratch, "rcb"), "greeter",
                                ["timestamp", "partition", "offset"],
                                f"{scratch}/out", f"{scratch}/totals", available_now=True, fold_every=2)
    q.awaitTermination()
    got = {(r.partition, r.offset): r["count"] for r in spark.read.parquet(f"{scratch}/out").collect()}
    batch = A.running_count(accepted(C.items(log, C.GREETING)), "greeter",
                            ["timestamp", "partition", "offset"])
    want = {(r.partition, r.offset): r["count"] for r in batch.collect()}
    assert got == want and len(got) == log.count()


def test_replayed_publish_batch_is_skipped(spark, scratch):
    from tidelog.sources.topics import open_log
    batch = spark.read.parquet(f"{SF_CHECK}/customer.parquet").select(
        "c_custkey", F.col("c_name").alias("k"), F.col("c_mktsegment").alias("v"))
    out, receipts = f"{scratch}/log", f"{scratch}/receipts"
    assert L.publish_batch(batch, 0, "people", "k", "v", ["c_custkey"], out, method="md5",
                           receipts_path=receipts, receipt_cols=["c_custkey"])
    first = sorted(map(tuple, spark.read.parquet(receipts).collect()))
    assert not L.publish_batch(batch, 0, "people", "k", "v", ["c_custkey"], out, method="md5",
                               receipts_path=receipts, receipt_cols=["c_custkey"])
    assert open_log(spark, out).count() == batch.count()
    assert sorted(map(tuple, spark.read.parquet(receipts).collect())) == first
    assert L.publish_batch(batch, 1, "people", "k", "v", ["c_custkey"], out, method="md5")
    log = open_log(spark, out)
    assert log.count() == 2 * batch.count()
    assert log.groupBy("partition").agg(F.countDistinct("offset").alias("d"),
                                        F.count("*").alias("n")).filter("d != n").count() == 0


def test_live_reads_from_offsets_and_time(spark, scratch):
    from tidelog.operators.positions import epoch_ms_of
    from tidelog.sources import topics as S
    log = fx.events_log(spark, SF_CHECK)
    path = f"{scratch}/log"
    log.filter(F.col("offset") < 2000).coalesce(1).write.parquet(path)
    since = epoch_ms_of("2024-01-15T06:30:00Z")
    reads = {"s3": L.stream_from_offsets(spark, path, {"events": {0: 500, 1: S.LATEST}}),
             "s4": L.stream_from_timestamp(spark, path, "events", since)}
    rows = [tuple(r) for r in log.select("partition", "offset").collect()]
    for turn in (1, 2):
        for name, stream in reads.items():
            L.start(stream, _name(scratch, name), sink="parquet", path=f"{scratch}/{name}", available_now=True,
                    transform=lambda df: df.select("partition", "offset")).awaitTermination()
        if turn == 1:
            log.filter(F.col("offset") >= 2000).coalesce(1).write.mode("append").parquet(path)
    got = {n: sorted(map(tuple, spark.read.schema("partition int, offset long").parquet(f"{scratch}/{n}").collect()))
           for n in reads}
    ends1 = log.filter("partition = 1 AND offset < 2000").count()
    assert got["s3"] == sorted(r for r in rows if r[1] >= {0: 500, 1: ends1, 2: 0}[r[0]])
    first = log.filter("offset < 2000").filter(F.col("timestamp") >= F.timestamp_millis(F.lit(since)))
    starts = {r.partition: r.s for r in first.groupBy("partition").agg(F.min("offset").alias("s")).collect()}
    assert got["s4"] == sorted(r for r in rows if r[1] >= starts.get(r[0], 2000))


class _State:
    """A key's state, as the processor sees it."""

    def __init__(self):
        self.value, self.exists = None, False

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value, self.exists = value, True


def test_a_hot_key_is_counted_in_chunks_over_many_batches():
    import random

    import pandas as pd
    rnd = random.Random(5)
    state, want, got = _State(), 0, []
    for k in range(6):
        rows = [(None if rnd.random() < .1 else pd.Timestamp(2024, 1, 1) + pd.Timedelta(rnd.randrange(50), "s"), i, f"x{i}")
                for i in range(rnd.randrange(1, 400))]
        rnd.shuffle(rows)
        frame = pd.DataFrame(rows, columns=["at", "id", "text"])
        chunks = [frame[i:i + 37] for i in range(0, len(frame), 37)]
        out = pd.concat(list(L._running(iter(chunks), state, ["at", "id"], "count")))
        assert list(out.columns) == ["at", "id", "text", "count"] and len(out) == len(rows)
        order = sorted(rows, key=lambda r: (not pd.isna(r[0]), r[0] if not pd.isna(r[0]) else 0, r[1]))
        assert dict(zip(out["id"], out["count"])) == {r[1]: want + n + 1 for n, r in enumerate(order)}
        assert all(out["text"] == "x" + out["id"].astype(str))
        want += len(rows)
        got.append(state.get[0])
    assert got[-1] == want


def test_paused_runs_leave_the_bookmark(spark, scratch):
    log = fx.events_log(spark, SF_CHECK).select("key", "value", "topic", "partition", "offset", "timestamp")
    path, out, job = f"{scratch}/log", f"{scratch}/out", _name(scratch, "job")
    seen = set()
    for lo, hi in ((0, 1000), (1000, 2000), (2000, 1 << 40)):
        log.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).coalesce(2).write.mode("append").parquet(path)
        runs = [sorted((r.partition, r.offset) for r in L.run_incremental_live(
            spark, path, out, job, "job-bookmark-pause").collect()) for _ in range(2)]
        L.run_incremental_live(spark, path, out, job, "enabled")
        now = {(r.partition, r.offset) for r in spark.read.parquet(out).collect()}
        assert runs[0] == runs[1] == sorted(now - seen) and len(runs[0]) > 0
        seen = now
    assert L.run_incremental_live(spark, path, out, job, "paused").count() == 0
    assert len(seen) == log.count()


def test_totals_fold_and_stay_linear_in_keys(spark, scratch):
    import os
    totals = L._Totals(spark, f"{scratch}/totals", fold_every=3)
    want = {}
    for k in range(11):
        rows = [(("hot",), 100 + k), ((f"k{k % 4}",), 1)]
        for turn in (1, 2):                       # every batch is replayed once
            prev = totals.before(k)
            got = {} if prev is None else {r[0][0]: r[1] for r in prev.groupBy("_rc_grp").sum("_rc_total").collect()}
            assert got == want
            totals.add(k, spark.createDataFrame(rows, "_rc_grp struct<f: string>, _rc_total long"))
        for (key,), n in rows:
            want[key] = want.get(key, 0) + n
    kept = sorted(os.listdir(f"{scratch}/totals"))
    assert len(kept) <= 2 + 3 + 3 and "added=0" not in kept and "base=2" not in kept


