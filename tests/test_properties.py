"""Property checks of the scalar functions against the producer's Python
semantics (letters limited to scripts whose case tables agree between the
JVM's and Python's Unicode versions)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidelog.functions import message_key, title_case

ALPHABET = st.sampled_from(list(
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "àáâäçèéêëìíîïñòóôöùúûüÿßæœÀÉÎÖÜÇÆŒ"
    "абвгдежзийклмнопрстуфхцчшщъыьэюяАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"
    "αβγδεζηθικλμνξοπρστυφχψωςΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"
    "ﬁﬂǆǅǄ0123456789 _-'’,.()+/&\t"))
TEXT = st.lists(ALPHABET, max_size=40).map("".join)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=200, max_size=200))
def test_title_case_and_key_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = df.select("s", title_case("s").alias("t"), message_key("s").alias("k")).collect()
    for r in out:
        assert r.t == r.s.title(), (r.s, r.t, r.s.title())
        assert r.k == r.s.lower().replace("s+", "-"), (r.s, r.k)


from tidelog import scan  # noqa: E402
from tidelog.log import dense_position  # noqa: E402

ROW = st.tuples(st.sampled_from([None, "a", "b", "c"]),      # group, nullable
                st.integers(0, 6),                            # leading order value, many ties
                st.integers(0, 3))                            # second order value, ties too


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=400))
def test_dense_position_matches_brute_force(spark, rows):
    # make (lead, second, id) a total order inside each group
    data = [(g, lead, sec, i) for i, (g, lead, sec) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, lead long, sec long, id long")
    want = {}
    for g in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == g), key=lambda d: (d[1], d[2], d[3]))
        want.update({d[3]: k for k, d in enumerate(mine)})
    for task_rows in (0, 1 << 16):       # groups by range, and by hash
        before, scan.TASK_ROWS = scan.TASK_ROWS, task_rows
        try:
            got = {r.id: r.pos for r in dense_position(df, ["g"], ["lead", "sec", "id"], "pos").collect()}
        finally:
            scan.TASK_ROWS = before
        assert got == want
    glob = {r.id: r.pos for r in dense_position(df, [], ["lead", "sec", "id"], "pos").collect()}
    order = sorted(data, key=lambda d: (d[1], d[2], d[3]))
    assert glob == {d[3]: k for k, d in enumerate(order)}
