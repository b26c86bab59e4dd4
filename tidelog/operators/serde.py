"""Serde and schemas as column jobs.

Decoding never raises on a bad record: each decoder adds an ``error`` column
(null when the record is fine) so one pass routes good rows on and bad rows
to the dead-letter sink (``tidelog.sinks.dead_letters``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import record_id, utf8_or_null

ERROR = "error"


@dataclass(frozen=True)
class RecordSchema:
    """A named record type. ``required`` fields have no default; the others have
    the one in ``defaults``, or null (the ``["null", "string"]`` union with
    ``default: null``)."""

    name: str
    fields: tuple[tuple[str, T.DataType], ...]
    required: tuple[str, ...]
    defaults: tuple[tuple[str, object], ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, n not in self.required)
                             for n, t in self.fields])

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]


def _str(*names: str, required: tuple[str, ...] | None = None,
         name: str = "record") -> RecordSchema:
    req = tuple(names) if required is None else required
    return RecordSchema(name, tuple((n, T.StringType()) for n in names), req)


# Record types of the reference's producers (fixed values).
GREETING = _str("message", "greeter", name="Greeting")
PERSON_JSON = _str("id", "name", "title", name="Person")
PERSON_V1 = _str("name", "title", name="PersonV1")
PERSON_V2 = _str("first_name", "last_name", "title", required=("title",),
                 name="PersonV2")
TECHNOLOGIST = _str("firstName", "lastName", "title", name="Technologist")
# Compatibility candidates: a new required field (must fail) and the same
# field with a null default (must pass).
FULLNAME_REQUIRED = _str("fullName", "title", name="PersonFullNameRequired")
FULLNAME_OPTIONAL = _str("fullName", "title", required=("title",),
                         name="PersonFullNameOptional")


# Records whose fields have other types and defaults in other versions.
_AGE = lambda t, *more: (("name", T.StringType()), ("age", t), *more)
TYPED_WRITERS = {
    1: RecordSchema("Person", _AGE(T.IntegerType()), ("name", "age")),
    2: RecordSchema("Person", _AGE(T.DoubleType(), ("nick", T.StringType())), ("name", "age", "nick")),
    3: RecordSchema("Person", _AGE(T.StringType()), ("name", "age"))}
TYPED_READER = RecordSchema("PersonDouble", _AGE(T.DoubleType(), ("nick", T.StringType())), ("name", "age"),
                            (("nick", "zz"),))
TYPED_INT = RecordSchema("PersonInt", _AGE(T.IntegerType()), ("name", "age"))
TYPED_STRING = RecordSchema("PersonString", _AGE(T.StringType()), ("name", "age"))

AVRO_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
              "float": T.FloatType(), "double": T.DoubleType(),
              "boolean": T.BooleanType(), "bytes": T.BinaryType()}


def schema_from_avro(text: str, name: str | None = None) -> RecordSchema:
    """A record schema from an Avro record definition (JSON text), as the
    schema registry stores it: a field without a ``default`` is required, and
    one with a default that isn't null keeps it; a ``["null", T]`` union is a
    nullable T. Only flat records of primitive fields (what the topics here
    carry) are accepted."""
    import json
    spec = json.loads(text)
    if spec.get("type") != "record":
        raise ValueError("not a record schema")
    fields, required, defaults = [], [], []
    for f in spec["fields"]:
        t = f["type"]
        if isinstance(t, dict):                      # annotated primitive
            t = t.get("type")
        if isinstance(t, list):
            rest = [x for x in t if x != "null"]
            if len(rest) != 1:
                raise ValueError(f"unsupported union for {f['name']}: {t}")
            t = rest[0]
        if t not in AVRO_TYPES:
            raise ValueError(f"unsupported type for {f['name']}: {t}")
        fields.append((f["name"], AVRO_TYPES[t]))
        if "default" not in f:
            required.append(f["name"])
        elif f["default"] is not None:
            # Bytes have their default as a string of code points up to 255.
            defaults.append((f["name"], f["default"].encode("latin-1") if t == "bytes" else f["default"]))
    return RecordSchema(name or spec.get("name", "record"), tuple(fields), tuple(required), tuple(defaults))


# Which types a reader's type can be read from, beside itself.
PROMOTIONS = {
    "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
    "string": ("bytes",), "bytes": ("string",),
}
_AVRO_NAMES = {t: n for n, t in AVRO_TYPES.items()}


def readable_as(writer: T.DataType, reader: T.DataType) -> bool:
    """Whether a field written as one type can be read as another: the same
    type, or a promotion to a wider number, or between strings and bytes."""
    w, r = _AVRO_NAMES.get(writer), _AVRO_NAMES.get(reader)
    return writer == reader or r in PROMOTIONS.get(w, ())


def _first_error(*checks: tuple[Column, str]) -> Column:
    """The message of the first failing check, else null."""
    out = F.lit(None).cast("string")
    for cond, msg in reversed(checks):
        out = F.when(cond, F.lit(msg)).otherwise(out)
    return out


def _merge_error(df: DataFrame, new: Column) -> DataFrame:
    if ERROR in df.columns:
        return df.withColumn(ERROR, F.coalesce(F.col(ERROR), new))
    return df.withColumn(ERROR, new)


# --- C1 ---------------------------------------------------------------------

def encode_json(df: DataFrame, cols: list[str], out: str = "value") -> DataFrame:
    """Record -> JSON text -> UTF-8 bytes. Null fields are written as
    ``null`` (Spark's default would drop them, losing optional fields)."""
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.withColumn(out, F.encode(text, "UTF-8"))


# --- C3 ---------------------------------------------------------------------

def decode_utf8(df: DataFrame, cols: tuple[str, ...] = ("key", "value"),
                suffix: str = "_text") -> DataFrame:
    """Strict UTF-8 decode of byte columns; invalid bytes give an error
    instead of an exception or replacement characters."""
    checks = []
    for c in cols:
        df = df.withColumn(c + suffix, utf8_or_null(c))
        checks.append((F.col(c).isNotNull() & F.col(c + suffix).isNull(),
                       f"invalid utf-8 in {c}"))
    return _merge_error(df, _first_error(*checks))


# --- C2 ---------------------------------------------------------------------

CORRUPT = "_corrupt_record"


def _parse(text: Column, schema: T.StructType) -> Column:
    """One strict parse. The text is wrapped as a member of an object whose last
    member must be reached, so text after the record (which the parser would
    leave unread) is an error like any other. Text made to close the wrapper
    itself (``{...},"e":1}``) is still read as its first record."""
    wrapped = T.StructType([T.StructField("w", schema), T.StructField("e", T.IntegerType()),
                            T.StructField(CORRUPT, T.StringType())])
    return F.from_json(F.concat(F.lit('{"w":'), text, F.lit(',"e":1}')), wrapped,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                        "allowSingleQuotes": "false"})


def decode_json(df: DataFrame, schema: RecordSchema | T.StructType,
                col: str = "value", prefix: str = "") -> DataFrame:
    """UTF-8 JSON bytes -> record fields (one parse per row).

    Bad bytes or bad JSON set ``error``; a null value (a deletion marker) is
    not an error and decodes to null fields."""
    struct = schema.struct if isinstance(schema, RecordSchema) else schema
    text = utf8_or_null(col)
    parsed = df.withColumn("_dec_text", text).withColumn(
        "_dec", _parse(F.col("_dec_text"), struct))
    good = F.coalesce(F.col(f"_dec.{CORRUPT}").isNull() & (F.col("_dec.e") == 1)
                      & F.col("_dec.w").isNotNull(), F.lit(False))
    err = _first_error(
        (F.col(col).isNotNull() & F.col("_dec_text").isNull(), "invalid utf-8"),
        (F.col(col).isNotNull() & ~good, "invalid json"),
    )
    decoded = {prefix + f.name for f in struct.fields}
    keep = [c for c in df.columns if c not in decoded]
    out = parsed.select(*keep,
                        *[F.when(good, F.col(f"_dec.w.{f.name}"))
                          .alias(prefix + f.name) for f in struct.fields],
                        err.alias("_dec_err"))
    out = _merge_error(out, F.col("_dec_err")).drop("_dec_err")
    return out


# --- P3 ---------------------------------------------------------------------

def with_id(df: DataFrame, out: str = "id", method: str = "uuid", seed: str = "id",
            id_col: str | None = None) -> DataFrame:
    """Add a unique string id per record (see ``functions.record_id``)."""
    return df.withColumn(out, record_id(method, seed, id_col))


# --- P4 ---------------------------------------------------------------------

def items(log: DataFrame, schema: RecordSchema | T.StructType) -> DataFrame:
    """(key, decoded value fields) pairs plus the record position and time.
    A decoded field named like a log column replaces it. A key that isn't UTF-8
    is null and sets ``error``."""
    dec = decode_json(log, schema)
    dec = _merge_error(dec, _first_error(
        (F.col("key").isNotNull() & utf8_or_null("key").isNull(), "invalid utf-8 in key")))
    struct = schema.struct if isinstance(schema, RecordSchema) else schema
    return dec.select("topic", "partition", "offset", "timestamp",
                      utf8_or_null("key").alias("key"),
                      *[f.name for f in struct.fields], ERROR)


# --- C4 ---------------------------------------------------------------------

def validate_record(df: DataFrame, schema: RecordSchema) -> DataFrame:
    """Reject a decoded record whose required fields are missing (null)."""
    checks = [(F.col(f).isNull(), f"missing required field: {f}")
              for f in schema.required]
    return _merge_error(df, _first_error(*checks))


# --- C5 ---------------------------------------------------------------------

def unframe(df: DataFrame, col: str = "value") -> DataFrame:
    """Split the schema-registry wire format: magic byte 0, 4-byte
    big-endian schema id, payload."""
    v = F.col(col)
    ok = (F.length(v) >= 5) & (F.hex(F.substring(v, 1, 1)) == F.lit("00"))
    return (df.withColumn("schema_id", F.when(ok, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10)
                                              .cast("int")))
              .withColumn("payload", F.when(ok, F.expr(f"substring({col}, 6)"))))


def frame(schema_id: int, payload: Column) -> Column:
    """Prefix a payload with the wire-format header for ``schema_id``."""
    header = bytes([0]) + int(schema_id).to_bytes(4, "big")
    return F.concat(F.unhex(F.lit(header.hex())), payload)


def read_with_schema(df: DataFrame, version_col: str,
                     writers: dict[int, RecordSchema], reader: RecordSchema,
                     payload: str = "payload") -> DataFrame:
    """Resolve a mixed-version topic to one reader schema in a single pass.

    Per record the writer schema is chosen by ``version_col``. A reader field
    the writer has is read, promoted to the reader's type; if that is no
    promotion (``readable_as``), the record is rejected. One the writer lacks
    has the reader's default, or the record is rejected if it has none; writer
    fields the reader does not know are dropped. JSON parsing does not depend on
    the writer, so the payload is parsed once against the union of all fields
    (as text where writers disagree on a field's type)."""
    kinds: dict[str, set[T.DataType]] = {}
    for w in writers.values():
        for n, t in w.fields:
            kinds.setdefault(n, set()).add(t)
    for n, t in reader.fields:
        kinds.setdefault(n, {t})
    # Bytes are written as text, like strings.
    text_like = {T.StringType(), T.BinaryType()}
    parsed = {n: next(iter(ts)) if len(ts) == 1 and not ts & text_like else T.StringType()
              for n, ts in kinds.items()}
    all_fields = T.StructType([T.StructField(n, t) for n, t in parsed.items()])
    dec = decode_json(df, all_fields, col=payload, prefix="_w_")
    ver = F.col(version_col)
    known = ver.isin(list(writers))
    defaults = dict(reader.defaults)
    cols, wrong = [], []
    for name, kind in reader.fields:
        value = F.lit(None).cast(kind)
        for v, w in writers.items():
            own = dict(w.fields).get(name)
            if own is None:
                read = F.lit(defaults.get(name)).cast(kind)
            elif readable_as(own, kind):
                # Read as the writer's type first, then as the reader's.
                read = F.col("_w_" + name).try_cast(own).cast(kind)
                if own not in text_like:
                    wrong.append(((ver == v) & F.col("_w_" + name).isNotNull()
                                  & F.col("_w_" + name).try_cast(own).isNull(),
                                  f"not a {_AVRO_NAMES.get(own, own.simpleString())}: {name}"))
            else:
                wrong.append((ver == v, f"cannot read {_AVRO_NAMES.get(own, own.simpleString())} as "
                                        f"{_AVRO_NAMES.get(kind, kind.simpleString())}: {name}"))
                continue
            value = F.when(ver == v, read).otherwise(value)
        cols.append(value.alias(name))
    lacking_required = [
        (ver.isin([v for v, w in writers.items() if f not in w.names]),
         f"writer schema lacks required field: {f}")
        for f in reader.required
        if any(f not in w.names for w in writers.values())
    ]
    err = _first_error((~known | ver.isNull(), "unknown writer schema"), *lacking_required, *wrong)
    keep = [c for c in df.columns if c not in reader.names]
    out = dec.select(*keep, *cols, F.col(ERROR).alias("_rs_prev"), err.alias("_rs_err"))
    out = out.withColumn(ERROR, F.coalesce("_rs_prev", "_rs_err")).drop("_rs_prev", "_rs_err")
    return validate_record(out, reader)


# --- C6 ---------------------------------------------------------------------

def compat_audit(df: DataFrame, candidates: list[RecordSchema],
                 col: str = "payload") -> DataFrame:
    """Could each stored record shape be read with a candidate schema?

    Shapes are the sorted key sets of the JSON objects (a partial aggregate
    per shape, so the shuffle carries one row per shape and task). A
    candidate reads a shape when every required candidate field is present;
    fields with a null default may be absent. Unparseable records are their
    own shape (null keys) and are never readable."""
    text = utf8_or_null(col)
    keys = F.array_sort(F.call_function("json_object_keys", text))
    shapes = (df.select(keys.alias("_keys"))
              .groupBy("_keys").agg(F.count(F.lit(1)).alias("records")))
    # Candidates ride along as a literal array exploded per shape row.
    cands = F.array(*[
        F.struct(F.lit(c.name).alias("name"),
                 F.array(*[F.lit(f) for f in c.required]).cast("array<string>")
                 .alias("required"))
        for c in candidates])
    per = shapes.select("_keys", "records", F.explode(cands).alias("_cand"))
    missing = F.when(F.col("_keys").isNotNull(),
                     F.array_except(F.col("_cand.required"), F.col("_keys")))
    return per.select(
        F.col("_cand.name").alias("candidate"),
        F.coalesce(F.array_join("_keys", ","), F.lit("<unparseable>")).alias("shape"),
        "records",
        F.coalesce(F.array_join(missing, ","), F.lit("")).alias("missing_required"),
        (F.col("_keys").isNotNull() & (F.size(missing) == 0)).alias("compatible"),
    )


# Which kinds of JSON values a field of a type can be read from.
_JSON_KINDS = {"string": ("string",), "bytes": ("string",), "int": ("integer",), "long": ("integer",),
               "float": ("integer", "number"), "double": ("integer", "number"), "boolean": ("boolean",)}


def json_kinds(text: Column) -> Column:
    """The kind of each member of a JSON object: string, integer, number,
    boolean, null, object or array (null: not a JSON object)."""
    def kind(_: Column, v: Column) -> Column:
        t = F.schema_of_variant(v)
        return (F.when(t == "STRING", "string").when(t == "BIGINT", "integer").when(t == "BOOLEAN", "boolean")
                .when(t == "VOID", "null").when(t.startswith("ARRAY"), "array")
                .when(t.startswith("OBJECT"), "object").otherwise("number"))
    return F.transform_values(F.from_json(text, "map<string,variant>"), kind)


def typed_audit(df: DataFrame, candidates: list[RecordSchema], col: str = "payload") -> DataFrame:
    """``compat_audit`` with field types: a shape is the members of the JSON
    objects with their kinds, and a candidate reads it if it finds every
    required field, and each of its fields that is there is of a kind it can be
    read from (null: only fields that aren't required)."""
    kinds = json_kinds(utf8_or_null(col))
    shape = F.array_sort(F.transform(F.map_entries(kinds), lambda e: F.concat(e["key"], F.lit(":"), e["value"])))
    shapes = df.select(shape.alias("_shape")).groupBy("_shape").agg(F.count(F.lit(1)).alias("records"))

    def wanted(c: RecordSchema) -> Column:
        return F.struct(F.lit(c.name).alias("name"), F.array(*[
            F.struct(F.lit(n).alias("n"), F.lit(n in c.required).alias("must"), F.array(*[
                F.lit(f"{n}:{k}") for k in (*_JSON_KINDS[_AVRO_NAMES[t]], *(() if n in c.required else ("null",)))
            ]).alias("fits")) for n, t in c.fields]).alias("fields"))
    per = shapes.select("_shape", "records", F.explode(F.array(*map(wanted, candidates))).alias("_c"))
    names = F.transform("_shape", lambda m: F.regexp_replace(m, ":[a-z]+$", ""))
    missing = F.transform(F.filter("_c.fields", lambda f: f["must"] & ~F.array_contains(names, f["n"])),
                          lambda f: f["n"])
    unreadable = F.transform(F.filter("_c.fields", lambda f: F.array_contains(names, f["n"])
                                      & ~F.arrays_overlap(f["fits"], F.col("_shape"))), lambda f: f["n"])
    return per.select(
        F.col("_c.name").alias("candidate"),
        F.coalesce(F.array_join("_shape", ","), F.lit("<unparseable>")).alias("shape"), "records",
        F.coalesce(F.array_join(missing, ","), F.lit("")).alias("missing_required"),
        F.coalesce(F.array_join(unreadable, ","), F.lit("")).alias("unreadable"),
        F.coalesce((F.size(missing) == 0) & (F.size(unreadable) == 0) & F.col("_shape").isNotNull(),
                   F.lit(False)).alias("compatible"))
