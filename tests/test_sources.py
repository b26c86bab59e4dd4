from pyspark.sql import functions as F

from tidelog.log import record_view
from tidelog.operators import positions as O
from tidelog.plans import fixtures as fx
from tidelog.sources import generators as G
from tidelog.sources import topics as S

from conftest import SF_CHECK, SF_SMALL, log_rows


def _log(spark):
    rows = []
    for p in range(3):
        for o in range(10):
            rows.append((f"k{o % 4}", f"v{p}-{o}", "t", p, o, f"2024-01-01 00:{o:02d}:{p:02d}"))
    rows.append(("x", "y", "u", 0, 0, "2024-01-01 00:00:00"))
    return log_rows(spark, rows)


def _offsets(df):
    return sorted((r.topic, r.partition, r.offset) for r in df.select("topic", "partition", "offset").collect())


def test_keyed_lines_split_at_first_separator(spark):
    df = spark.createDataFrame([("a|b",), ("a|b|c",), ("nosep",), ("|v",), ("k|",)], "line string")
    out = {r.line: (r.key, r.value, r.error) for r in S.read_keyed_lines(df).collect()}
    assert out["a|b"] == ("a", "b", None)
    assert out["a|b|c"] == ("a", "b|c", None)
    assert out["nosep"] == (None, None, "no key separator")
    assert out["|v"] == ("", "v", None)
    assert out["k|"] == ("k", "", None)


def test_raw_strings(spark):
    log = log_rows(spark, [(None, "Hello", "g", 0, 0, "2024-01-01 00:00:00"),
                           (None, b"\xff", "g", 0, 1, "2024-01-01 00:00:00")])
    out = {r.offset: (r.text, r.error) for r in S.read_raw_strings(log).collect()}
    assert out == {0: ("Hello", None), 1: (None, "invalid utf-8")}


def test_offsets_spec_earliest_latest_unlisted(spark):
    log = _log(spark)
    got = _offsets(S.read_from_offsets(log, {"t": {0: 7, 1: S.LATEST}}))
    assert got == [("t", 0, 7), ("t", 0, 8), ("t", 0, 9)] + [("t", 2, o) for o in range(10)]
    assert len(_offsets(S.read_from_offsets(log, {"t": {0: S.EARLIEST}}))) == 30


def test_start_positions_match_brute_force(spark):
    log = _log(spark)
    starts = spark.createDataFrame([("t", 0, 3), ("t", 2, 11)], "topic string, partition int, start_offset long")
    rows = [(r.topic, r.partition, r.offset) for r in log.collect()]
    st = {("t", 0): 3, ("t", 2): 11}
    for policy in ("earliest", "latest"):
        want = sorted(r for r in rows if ((r[0], r[1]) in st and r[2] >= st[(r[0], r[1])])
                      or ((r[0], r[1]) not in st and policy == "earliest"))
        assert _offsets(O.from_positions(log, starts, policy)) == want
    none = spark.createDataFrame([], "topic string, partition int, start_offset long")
    assert O.from_positions(log, none, "latest").count() == 0
    assert O.from_positions(log, none, "earliest").count() == log.count()


def test_from_timestamp_bounds(spark):
    log = _log(spark)
    after_last = O.epoch_ms_of("2024-01-02T00:00:00Z")
    assert S.read_from_timestamp(log, after_last, "t").count() == 0
    before = O.epoch_ms_of("2023-12-31T00:00:00Z")
    assert S.read_from_timestamp(log, before, "t").count() == 30
    mid = S.read_from_datetime(log, "2024-01-01T00:05:01Z", "t")
    assert _offsets(mid)[0] == ("t", 0, 6) and ("t", 2, 5) in _offsets(mid)


def test_latest_without_snapshot_is_empty(spark):
    assert S.read_from_latest(_log(spark), "t").count() == 0


def test_read_topics(spark):
    assert S.read_topics(_log(spark), ["u"]).count() == 1


def test_generators_are_repeatable(spark):
    a = G.generate_records(100, spark=spark).collect()
    b = G.generate_records(spark.range(100).repartition(7), spark=spark).orderBy("id").collect()
    assert a == b
    opts = G.TECHNOLOGIST_OPTIONS
    assert all(r.firstName in opts["firstName"] and r.key == r.lastName for r in a)
    people = G.generate_people(50, spark=spark).collect()
    assert all(r.key == r.title.lower().replace("s+", "-") for r in people)
    assert all(r.title == (r.title.lower()).title() for r in people)
    words = G.generate_greetings(30, 0, form="word", spark=spark).collect()
    assert {r.greeting for r in words} <= set(G.GREETING_WORDS)
    t = G.ticks(spark, 0, 3).collect()
    assert [r.kind for r in t] == ["startup", "interval", "interval", "interval"]


def test_fixture_logs_have_dense_offsets(spark):
    for build in (fx.events_log, fx.greetings_log, fx.people_log, fx.people_mixed_log):
        log = build(spark, SF_SMALL)
        b = log.groupBy("partition").agg(F.min("offset").alias("a"), F.max("offset").alias("b"),
                                         F.count("*").alias("n"), F.countDistinct("offset").alias("d"))
        for r in b.collect():
            assert r.a == 0 and r.b == r.n - 1 and r.d == r.n
    assert record_view(fx.events_log(spark, SF_CHECK)).count() == 10000


def test_kafka_option_mapping():
    import json
    opts = S.kafka_options("b:9092", ["people", "greetings"], starting="earliest",
                           security={"security.protocol": "SASL_SSL",
                                     "kafka.sasl.mechanism": "SCRAM-SHA-512"})
    assert opts == {"kafka.bootstrap.servers": "b:9092", "subscribe": "people,greetings",
                    "startingOffsets": "earliest", "kafka.security.protocol": "SASL_SSL",
                    "kafka.sasl.mechanism": "SCRAM-SHA-512"}
    spec = {"people": {0: 5, 1: S.EARLIEST}}
    assert json.loads(S.starting_offsets_json(spec)) == {"people": {"0": 5, "1": -2}}
    assert S.kafka_options("b", starting_ms=1713158400000)["startingTimestamp"] == "1713158400000"


def test_large_start_tables_take_the_checkpoint_path(spark, monkeypatch):
    import tidelog.log as Lg
    log = _log(spark)
    starts = spark.createDataFrame([("t", 0, 3), ("t", 2, 11)], "topic string, partition int, start_offset long")
    want = {p: _offsets(O.from_positions(log, starts, p)) for p in ("earliest", "latest")}
    monkeypatch.setattr(Lg, "LOCAL_ROWS", 1)           # two rows exceed it
    for policy, rows in want.items():
        assert _offsets(O.from_positions(log, starts, policy)) == rows
