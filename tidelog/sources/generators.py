"""Repeatable record generators.

Rows come from an id column: either ``spark.range(n)`` or the ids of an
existing table, so the work is spread over the table's partitions. Every
field is picked from its option list by ``md5_pick`` (seed, field, id), so a
rerun, a recomputed task or another engine gets the same records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import md5_pick, md5_uuid, message_key, title_case

# Option lists of the reference's generators.
TECHNOLOGIST_OPTIONS = {
    "firstName": ["Bill", "Sue", "Pat", "Jo"],
    "lastName": ["Smitch", "Adams", "Murphy", "Patel", "Brown"],
    "title": ["Jr Engineer", "Sr Engineer", "Prin Engineer"],
}
TECHNOLOGIST_KEY = "lastName"
GREETING_PREFIXES = ["Hi", "Hello", "Howdy"]
GREETING_RECIPIENTS = ["Deepika", "Bob", "Jo"]
GREETERS = ["Bill", "Sue"]
GREETING_WORDS = ["Hello", "Bonjour", "Hola", "Zdravstvute", "Ciao", "Nǐ Hǎo",
                  "Konnichiwa", "Hallo", "Oi", "Anyoung", "Ahlan", "Namaste",
                  "Shalom", "Goedendag"]
GREETING_EVERY_S = 5
TICK_EVERY_S = 10

# Our own name and job pools for generated people (the reference draws them
# from a fake-data library).
FIRST_NAMES = ["Ada", "Bruno", "Chloé", "Dmitri", "Eun-ji", "Farah", "Gustavo",
               "Hana", "Ivan", "Jonas", "Keira", "Luis", "Mei", "Nora", "Omar",
               "Priya"]
LAST_NAMES = ["Abara", "Becker", "Castillo", "Dubois", "Eriksen", "Fujita",
              "García", "Haddad", "Ivanova", "Jansen", "Kowalski", "Lindqvist",
              "Moreau", "Nakamura", "O'Brien", "Petrov"]
JOBS = ["accountant, chartered", "engineer, civil (consulting)", "sales+ manager",
        "data scientist", "teacher, secondary school", "nurse, children's",
        "it trainer", "editor, film/video", "surveyor, mining",
        "chemist, analytical", "barista", "pilot, airline",
        "designer, x-ray equipment", "counsellor", "librarian, public",
        "web developer"]


def pick(options: list[str], seed: str, id_col: str | Column = "id") -> Column:
    """One of ``options``, chosen by md5(seed:id)."""
    arr = F.array(*[F.lit(o) for o in options])
    return F.element_at(arr, md5_pick(seed, id_col, len(options)) + 1)


def ids(source: int | DataFrame, id_col: str = "id",
        spark: SparkSession | None = None) -> DataFrame:
    """The id column generation is driven by."""
    if isinstance(source, int):
        if spark is None:
            raise ValueError("spark is needed to generate from a count")
        return spark.range(source)
    return source.select(F.col(id_col).cast("long").alias("id"))


# --- S9 ---------------------------------------------------------------------

def generate_records(source: int | DataFrame, fields: dict[str, list[str]] | None = None,
                     seed: str = "technologists", key_field: str = TECHNOLOGIST_KEY,
                     id_col: str = "id", spark: SparkSession | None = None) -> DataFrame:
    """n records, each field picked from its option list; key = one field."""
    base = ids(source, id_col, spark)
    return base.select("id", *record_columns(fields, seed)).withColumn("key", F.col(key_field))


def record_columns(fields: dict[str, list[str]] | None = None,
                   seed: str = "technologists") -> list[Column]:
    """One picked column per field (from the ``id`` column)."""
    fields = fields or TECHNOLOGIST_OPTIONS
    return [pick(opts, f"{seed}.{name}").alias(name) for name, opts in fields.items()]


# --- S10 --------------------------------------------------------------------

def generate_people(source: int | DataFrame, seed: str = "people", id_col: str = "id",
                    spark: SparkSession | None = None) -> DataFrame:
    """Person records: a UUID-shaped id, a name, a title-cased job title and
    the message key derived from it (v2 names kept as separate fields)."""
    base = ids(source, id_col, spark)
    first = pick(FIRST_NAMES, f"{seed}.first", "id")
    last = pick(LAST_NAMES, f"{seed}.last", "id")
    job = pick(JOBS, f"{seed}.job", "id")
    return (base.select(
        F.col("id").alias("seq"),
        md5_uuid(seed, "id").alias("id"),
        first.alias("first_name"), last.alias("last_name"),
        title_case(job).alias("title"))
        .withColumn("name", F.concat_ws(" ", "first_name", "last_name"))
        .withColumn("key", message_key("title")))


# --- S11 --------------------------------------------------------------------

def generate_greetings(source: int | DataFrame, start_epoch_s: int,
                       every_s: int = GREETING_EVERY_S, seed: str = "greetings",
                       form: str = "record", id_col: str = "id",
                       spark: SparkSession | None = None) -> DataFrame:
    """One greeting per id, ``every_s`` apart from ``start_epoch_s``.

    ``record``: Greeting(message="<prefix> <recipient>", greeter);
    ``word``: one of the fourteen greeting words as a plain string."""
    base = ids(source, id_col, spark)
    at = F.timestamp_seconds(F.lit(int(start_epoch_s)) + F.col("id") * every_s)
    if form == "record":
        message = F.concat_ws(" ", pick(GREETING_PREFIXES, f"{seed}.prefix"),
                              pick(GREETING_RECIPIENTS, f"{seed}.recipient"))
        return base.select("id", message.alias("message"),
                           pick(GREETERS, f"{seed}.greeter").alias("greeter"),
                           at.alias("timestamp"))
    if form == "word":
        return base.select("id", pick(GREETING_WORDS, f"{seed}.word").alias("greeting"),
                           at.alias("timestamp"))
    raise ValueError(f"unknown greeting form: {form}")


# --- S12 --------------------------------------------------------------------

def ticks(spark: SparkSession, start_epoch_s: int, n: int,
          every_s: int = TICK_EVERY_S) -> DataFrame:
    """A run-once startup row (tick 0) and ``n`` interval ticks, tick i at
    start + i * every_s. ``spark.range`` spreads the rows over tasks."""
    at = F.timestamp_seconds(F.lit(int(start_epoch_s)) + F.col("id") * every_s)
    return spark.range(n + 1).select(
        F.col("id").alias("tick"),
        F.when(F.col("id") == 0, F.lit("startup")).otherwise(F.lit("interval")).alias("kind"),
        at.alias("at"),
        F.when(F.col("id") == 0, F.lit("A task executing on startup"))
         .otherwise(F.concat(F.lit("A task executing on interval at "),
                             F.date_format(at, "yyyy-MM-dd HH:mm:ss"))).alias("line"))


def tick_report(df: DataFrame, time_col: str, every_s: int = TICK_EVERY_S) -> DataFrame:
    """The ticks over ``df``'s time span, each with the number of records of
    ``df`` that arrived in its interval [previous tick, tick) — what the
    periodic task reports. The last tick is the first after the last record, so
    every record is in one interval. The counts are a partial aggregate by tick number
    (one row per tick), joined to the ticks on that number."""
    span = df.agg(F.unix_seconds(F.date_trunc("minute", F.min(time_col).cast("timestamp")))
                  .alias("s"),
                  F.unix_seconds(F.max(time_col).cast("timestamp")).alias("e")).first()
    if span is None or span["s"] is None:
        return ticks(df.sparkSession, 0, -1, every_s).withColumn("events", F.lit(0).cast("long"))
    start, n = int(span["s"]), (int(span["e"]) - int(span["s"])) // every_s + 1
    at_us = F.unix_micros(F.col(time_col).cast("timestamp"))
    tick_no = F.floor((at_us - F.lit(start * 1_000_000)) / F.lit(every_s * 1_000_000)) + 1
    counts = (df.select(tick_no.cast("long").alias("tick"))
              .groupBy("tick").agg(F.count(F.lit(1)).alias("events")))
    return (ticks(df.sparkSession, start, n, every_s).join(counts, "tick", "left")
            .withColumn("events", F.coalesce("events", F.lit(0)).cast("long")))
