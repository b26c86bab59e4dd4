import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog import scan
from tidelog.log import bounds, dense_position, with_offsets
from tidelog.plans import fixtures as fx

from conftest import SF_CHECK


@pytest.fixture(params=[0, 1 << 16], autouse=True)
def task_rows(request, monkeypatch):
    """Both ways of numbering: every large group by range, and none."""
    monkeypatch.setattr(scan, "TASK_ROWS", request.param)


def _plain(df, by, order, name):
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w) - 1)


def _same(a, b, cols):
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def test_bucketed_positions_equal_plain_window(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    ev = ev.withColumn("p", F.col("user_id") % 3)
    got = dense_position(ev, ["p"], ["event_id"], "pos")
    want = _plain(ev, ["p"], ["event_id"], "pos")
    _same(got, want, ["event_id", "pos"])


def test_bucketed_positions_hot_key_and_ties(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    # one key holds about a third of the rows; order on a timestamp plus id
    ev = ev.withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                       .otherwise(F.col("user_id").cast("string")))
    ev = ev.withColumn("minute", F.date_trunc("hour", "ts"))
    got = dense_position(ev, ["k"], ["minute", "event_id"], "pos")
    want = _plain(ev, ["k"], ["minute", "event_id"], "pos")
    _same(got, want, ["event_id", "pos"])
    hot = got.filter(F.col("k") == "hot").agg(F.min("pos"), F.max("pos"), F.count("*")).first()
    assert hot[0] == 0 and hot[1] == hot[2] - 1


def test_global_positions(spark):
    cv = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    got = dense_position(cv, [], ["conv_id", "turn"], "seq")
    want = _plain(cv, [], ["conv_id", "turn"], "seq")
    _same(got, want, ["conv_id", "turn", "seq"])


def test_offsets_continue_existing_end(spark):
    log = fx.events_log(spark, SF_CHECK)
    more = log.select("key", "value", "topic", "partition", "timestamp",
                      (F.col("offset") * 10).alias("o"))
    cont = with_offsets(more, ["o"], bounds(log))
    b = {(r.topic, r.partition): r.end_offset for r in bounds(log).collect()}
    c = bounds(cont).collect()
    for r in c:
        assert r.start_offset == b[(r.topic, r.partition)]
        assert r.end_offset - r.start_offset == r.records


def test_ties_on_the_leading_column_are_split_and_exact(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").withColumn("p", F.col("user_id") % 3)
    # every leading value heavily tied: one value per day (about 333 rows each)
    daily = ev.withColumn("day", F.date_trunc("day", "ts"))
    got = dense_position(daily, ["p"], ["day", "event_id"], "pos")
    _same(got, _plain(daily, ["p"], ["day", "event_id"], "pos"), ["event_id", "pos"])
    # one leading value held by a third of all rows
    third = ev.withColumn("lead", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                          .otherwise(F.col("event_id")))
    got = dense_position(third, [], ["lead", "event_id"], "pos")
    _same(got, _plain(third, [], ["lead", "event_id"], "pos"), ["event_id", "pos"])


def test_ties_on_two_order_columns_are_split(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    # a third of the rows share both the first and the second order value
    df = (ev.withColumn("a", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("event_id")))
            .withColumn("b", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.lit(0))))
    got = dense_position(df, [], ["a", "b", "event_id"], "pos")
    _same(got, _plain(df, [], ["a", "b", "event_id"], "pos"), ["event_id", "pos"])


def test_positions_with_any_order_type(spark):
    """Strings, nulls, ties and doubles lead the order as Spark sorts them."""
    from datetime import date
    rows = [(i, None if i % 5 == 0 else f"s{i % 7}", None if i % 4 == 0 else -i / 3,
             date(2024, 1, 1 + i % 9), None if i % 3 == 0 else "hot") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s string, x double, d date, g string")
    for lead in ("s", "x", "d"):
        for by in ([], ["g"]):
            got = dense_position(df, by, [lead, "id"], "pos")
            _same(got, _plain(df, by, [lead, "id"], "pos"), ["id", "pos"])
    assert dense_position(df.filter("id < 0"), ["g"], ["s", "id"], "pos").count() == 0
