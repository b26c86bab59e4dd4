from pyspark.sql import functions as F

from tidelog.operators import maintenance as M
from tidelog.operators import state as A

from conftest import log_rows

TS = "2024-01-01 00:00:{:02d}"


def test_compact_latest_and_deletes(spark):
    log = log_rows(spark, [
        ("a", "1", "t", 0, 0, TS.format(0)), ("b", "2", "t", 0, 1, TS.format(1)),
        ("a", "3", "t", 0, 2, TS.format(2)), ("b", None, "t", 0, 3, TS.format(3)),
        (None, "x", "t", 0, 4, TS.format(4)), ("c", None, "t", 0, 5, TS.format(5)),
        ("c", "5", "t", 0, 6, TS.format(6)),
    ])
    out = {r.key.decode(): (r.value.decode(), r.offset) for r in M.compact(log).collect()}
    assert out == {"a": ("3", 2), "c": ("5", 6)}


def test_retention_boundary(spark):
    log = log_rows(spark, [("a", "v", "t", 0, i, TS.format(i)) for i in range(10)])
    kept = M.apply_retention(log, 3000, "2024-01-01 00:00:08")
    assert sorted(r.offset for r in kept.collect()) == [5, 6, 7, 8, 9]


def test_assign_partition_stable_and_spread(spark):
    df = spark.createDataFrame([("k1", "a"), ("k1", "b"), (None, "c"), (None, "d"), ("k2", "e")],
                               "key string, value string")
    for method in ("murmur3", "md5"):
        out = M.assign_partition(df, "key", 3, method, spread="value").collect()
        parts = {}
        for r in out:
            assert 0 <= r.partition < 3
            if r.key:
                parts.setdefault(r.key, set()).add(r.partition)
        assert all(len(v) == 1 for v in parts.values())


def test_dedupe_by_id_keeps_first_written(spark):
    df = spark.createDataFrame([
        ("x", "t", 2, 10, "2024-01-02 00:00:00"), ("x", "t", 0, 3, "2024-01-01 00:00:00"),
        ("y", "t", 1, 4, "2024-01-01 00:00:00"),
    ], "id string, topic string, partition int, offset long, timestamp string")
    df = df.withColumn("timestamp", F.to_timestamp("timestamp"))
    out = {r.id: (r.partition, r.offset) for r in M.dedupe(df, ["id"]).collect()}
    assert out == {"x": (0, 3), "y": (1, 4)}


def test_topic_stats(spark):
    log = log_rows(spark, [("a", "v", "t", p, i, TS.format(i)) for p in range(2) for i in range(3, 7)])
    out = {r.partition: (r.records, r.start_offset, r.end_offset) for r in M.topic_stats(log).collect()}
    assert out == {0: (4, 3, 7), 1: (4, 3, 7)}
    assert M.list_topics(log).first().partitions == 2


def test_counts_running_and_lookup(spark):
    df = spark.createDataFrame([("Bill", 3), ("Sue", 1), ("Bill", 1), ("Bill", 2)], "g string, o long")
    rc = {r.o if r.g == "Bill" else -r.o: r["count"]
          for r in A.running_count(df, "g", ["o"]).collect()}
    assert rc == {1: 1, 2: 2, 3: 3, -1: 1}
    counts = A.count_by_key(df, "g")
    keys = spark.createDataFrame([("Bill",), ("Jo",)], "g string")
    assert {r.g: r["count"] for r in A.lookup_count(counts, keys, "g").collect()} == {"Bill": 3, "Jo": 0}
