import json

from pyspark.sql import functions as F

from tidelog.operators import serde as C
from tidelog.sinks.writes import accepted, dead_letters

from conftest import log_rows

TS = "2024-01-01 00:00:00"


def test_decode_json_routes_bad_records(spark):
    log = log_rows(spark, [
        ("a", '{"message": "hi", "greeter": "Bill"}', "g", 0, 0, TS),
        ("b", b"\xff\xfe{", "g", 0, 1, TS),
        ("c", "{not json", "g", 0, 2, TS),
        ("d", None, "g", 0, 3, TS),
        ("e", '{"message": "only"}', "g", 0, 4, TS),
    ])
    out = {r.offset: r for r in C.decode_json(log, C.GREETING).collect()}
    assert (out[0].message, out[0].greeter, out[0].error) == ("hi", "Bill", None)
    assert out[1].error == "invalid utf-8"
    assert out[2].error == "invalid json" and out[2].message is None
    assert out[3].error is None and out[3].message is None        # deletion marker
    assert out[4].error is None and out[4].greeter is None
    checked = C.validate_record(C.decode_json(log, C.GREETING), C.GREETING)
    bad = {r.offset: r.error for r in dead_letters(checked).collect()}
    assert bad == {1: "invalid utf-8", 2: "invalid json", 3: "missing required field: message",
                   4: "missing required field: greeter"}
    assert [r.offset for r in accepted(checked).collect()] == [0]


def test_encode_json_keeps_null_fields(spark):
    df = spark.createDataFrame([("A", None, "T")], "first_name string, last_name string, title string")
    enc = C.encode_json(df, ["first_name", "last_name", "title"]).select(F.decode("value", "UTF-8"))
    assert json.loads(enc.first()[0]) == {"first_name": "A", "last_name": None, "title": "T"}


def test_frame_unframe_roundtrip(spark):
    df = spark.createDataFrame([("x",)], "p string").select(
        C.frame(7, F.encode("p", "UTF-8")).alias("value"))
    r = C.unframe(df).select("schema_id", F.decode("payload", "UTF-8").alias("p")).first()
    assert (r.schema_id, r.p) == (7, "x")
    bad = spark.createDataFrame([(b"\x01abcdef",), (b"\x00a",)], "value binary")
    assert [r.schema_id for r in C.unframe(bad).collect()] == [None, None]


def _framed(spark, rows):
    df = spark.createDataFrame(rows, "o long, v int, j string")
    return df.select("o", F.when(F.col("v") == 1, C.frame(1, F.encode("j", "UTF-8")))
                     .when(F.col("v") == 2, C.frame(2, F.encode("j", "UTF-8")))
                     .otherwise(C.frame(9, F.encode("j", "UTF-8"))).alias("value"))


def test_read_with_schema_resolves_versions(spark):
    df = C.unframe(_framed(spark, [
        (0, 1, '{"name": "Ann Lee", "title": "Dev"}'),
        (1, 2, '{"first_name": "Bo", "last_name": null, "title": "Ops"}'),
        (2, 2, '{"first_name": "Cy", "last_name": "Do"}'),
        (3, 9, '{"title": "x"}'),
    ]))
    w = {1: C.PERSON_V1, 2: C.PERSON_V2}
    v2 = {r.o: r for r in C.read_with_schema(df, "schema_id", w, C.PERSON_V2).collect()}
    assert (v2[0].first_name, v2[0].last_name, v2[0].title, v2[0].error) == (None, None, "Dev", None)
    assert "name" not in v2[0].asDict()
    assert (v2[1].first_name, v2[1].title, v2[1].error) == ("Bo", "Ops", None)
    assert v2[2].error == "missing required field: title"
    assert v2[3].error == "unknown writer schema"
    v1 = {r.o: r.error for r in C.read_with_schema(df, "schema_id", w, C.PERSON_V1).collect()}
    assert v1[0] is None and v1[1] == "writer schema lacks required field: name"


def test_compat_audit(spark):
    df = C.unframe(_framed(spark, [
        (0, 1, '{"name": "A", "title": "t"}'), (1, 1, '{"title": "t", "name": "B"}'),
        (2, 2, '{"first_name": "C", "last_name": "D", "title": "t"}'), (3, 2, "{oops"),
    ]))
    out = {(r.candidate, r.shape): r for r in C.compat_audit(
        df, [C.FULLNAME_REQUIRED, C.FULLNAME_OPTIONAL]).collect()}
    assert out[("PersonFullNameRequired", "name,title")].records == 2
    assert out[("PersonFullNameRequired", "name,title")].compatible is False
    assert out[("PersonFullNameRequired", "name,title")].missing_required == "fullName"
    assert out[("PersonFullNameOptional", "name,title")].compatible is True
    assert out[("PersonFullNameOptional", "first_name,last_name,title")].compatible is True
    assert out[("PersonFullNameOptional", "<unparseable>")].compatible is False


def test_decode_utf8(spark):
    log = log_rows(spark, [(b"\xc3", "ok", "t", 0, 0, TS), (None, "v", "t", 0, 1, TS)])
    out = {r.offset: r for r in C.decode_utf8(log).collect()}
    assert out[0].error == "invalid utf-8 in key" and out[0].value_text == "ok"
    assert out[1].error is None and out[1].key_text is None


# The record definitions the producers register and the two
# compatibility candidates (one must fail, one must pass).
PERSON_V1_TEXT = ('{"name": "Person", "type": "record", "fields": [{"name": "name", "type": "string"}, '
                  '{"name": "title", "type": "string"}]}')
PERSON_V2_TEXT = ('{"name": "Person", "type": "record", "fields": ['
                  '{"name": "first_name", "type": ["null", "string"], "default": null}, '
                  '{"name": "last_name", "type": ["null", "string"], "default": null}, '
                  '{"name": "title", "type": "string"}]}')
CANDIDATE_FAIL = ('{"type":"record","name":"Person",'
                  '"fields":[{"name":"fullName","type":"string"},{"name":"title","type":"string"}]}')
CANDIDATE_PASS = ('{"type":"record","name":"Person",'
                  '"fields":[{"name":"fullName","type":["null","string"],"default":null},'
                  '{"name":"title","type":"string"}]}')
TECHNOLOGIST_TEXT = ('{"type": "record","name": "technologist","fields":[{"name": "firstName",'
                     '"type":{"type": "string","arg.properties":{"options":["Bill","Sue","Pat","Jo"]}}},'
                     '{"name":"lastName","type":{"type":"string","arg.properties":{"options":'
                     '["Smitch","Adams","Murphy","Patel","Brown"]}}},{"name":"title","type":{"type":'
                     '"string","arg.properties":{"options":["Jr Engineer","Sr Engineer","Prin Engineer"]}}}]}')


def test_schema_from_avro_matches_builtin_records():
    v1, v2 = C.schema_from_avro(PERSON_V1_TEXT), C.schema_from_avro(PERSON_V2_TEXT)
    assert (v1.fields, v1.required) == (C.PERSON_V1.fields, C.PERSON_V1.required)
    assert (v2.fields, v2.required) == (C.PERSON_V2.fields, C.PERSON_V2.required)
    tech = C.schema_from_avro(TECHNOLOGIST_TEXT)
    assert tech.names == ["firstName", "lastName", "title"] and tech.required == tuple(tech.names)


def test_compat_audit_with_registered_candidates(spark):
    df = C.unframe(_framed(spark, [(0, 2, '{"first_name": "A", "last_name": "B", "title": "t"}'),
                                   (1, 1, '{"name": "A B", "title": "t"}')]))
    cands = [C.schema_from_avro(CANDIDATE_FAIL, "fail"), C.schema_from_avro(CANDIDATE_PASS, "pass")]
    out = {(r.candidate, r.shape): r.compatible for r in C.compat_audit(df, cands).collect()}
    assert out[("fail", "first_name,last_name,title")] is False
    assert out[("fail", "name,title")] is False
    assert out[("pass", "first_name,last_name,title")] is True
    assert out[("pass", "name,title")] is True
