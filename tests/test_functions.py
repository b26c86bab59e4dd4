import duckdb

from tidelog.functions import md5_pick, md5_uuid, message_key, title_case, utf8_or_null

TITLES = ["engineer, (civil) they're o-b", "sales+ boss", "ßen straße", "ﬁne ﬂow",
          "3rd floor_x", "éCOLE ÉLÈVE", "ǆungla", "hello wORLD", "ΟΔΟΣ ΟΔΟΣ",
          "ⅰⅱ roman ⓐbc", "ªbc", "çà et là", "ИВАН иванович", "", "a1b2 c_d",
          "o'neill's   café-au-lait", "東京 tokyo", "x\ty\nz"]


def test_message_key_is_a_literal_replace(spark):
    df = spark.createDataFrame([("Sales+ Boss",), ("Accounts Manager",), ("Bss+S+",)], "t string")
    got = [r[0] for r in df.select(message_key("t")).collect()]
    assert got == [t.lower().replace("s+", "-") for t in ("Sales+ Boss", "Accounts Manager", "Bss+S+")]
    assert got[0] == "sale- boss"


def test_title_case_matches_python(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "s string")
    for s, t in df.select("s", title_case("s")).collect():
        assert t == s.title(), (s, t, s.title())


def test_title_case_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(title_case("s")).first()[0] is None


def test_md5_pick_and_uuid_repeat_in_duckdb(spark):
    df = spark.range(0, 50).select("id", md5_pick("seed.x", "id", 7).alias("p"),
                                   md5_uuid("people", "id").alias("u"))
    got = {r.id: (r.p, r.u) for r in df.collect()}
    want = duckdb.sql(
        "SELECT i, CAST(('0x' || substr(md5('seed.x:' || CAST(i AS VARCHAR)), 1, 8)) AS BIGINT) % 7,"
        " md5('people:' || CAST(i AS VARCHAR)) FROM range(50) t(i)").fetchall()
    for i, p, h in want:
        assert got[i][0] == p
        assert got[i][1].replace("-", "") == h
        assert [len(x) for x in got[i][1].split("-")] == [8, 4, 4, 4, 12]


def test_utf8_or_null(spark):
    df = spark.createDataFrame([(b"ok \xc3\xa9",), (b"\xff\xfe",), (None,)], "b binary")
    assert [r[0] for r in df.select(utf8_or_null("b")).collect()] == ["ok é", None, None]
