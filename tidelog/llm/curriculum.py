"""Mixing sources to target weights over a curriculum (operator 5).

Each source has a weight and a slope: its weight schedule over training time t
in [0, 1] is w(t) = weight * (1 + slope * (2t - 1)). Integrated, the schedule
gives the source's share of all tokens (its target, capped at ``max_repeats``
times its size, the excess reshared by weight) and its cumulative demand
D(t) = target * (t + slope * (t * t - t)). Documents supply tokens in a fixed
shuffled order; inverting D at the middle of a document's supply gives its
training position, and documents are range-sorted by position.

A source's supply is read as often as its target asks: whole passes over all
of its documents, then those whose middle lies within the rest. Nothing is
grouped by source in one task: the supply order is a range-partitioned running
total, and the reshared targets are found from sums alone.

The mix is ``training_order``: whole documents in the range sort, each as often
as it is taken. ``mixed_documents`` returns them; ``mixture`` tells per document
what the mix has of it (words, positions, places), counted in the sorted texts.

Defined cases: a null text has size 0; a null source is a source that comes
last; documents of size 0 supply nothing, and are taken with every whole pass;
repeated rows count as often as they occur; an empty table gives no rows. A
null id sorts first. Extra columns are carried along; working columns have a
``_cu_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.scan import dense_position, running_total

from .common import stored, two_hashes

WEIGHTS = (5.0, 2.0, 1.0)
#: Slopes of the schedules, repeating like the weights: early, level, late.
SLOPES = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
SEED = 20


def size_of(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _cycle(values: tuple[float, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            slopes: tuple[float, ...] = SLOPES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, weight, slope and target of each source, from the
    documents' (source, size). Sources above the cap are fixed at it, and what
    is over is reshared among the rest by weight, until none is above; each
    round moves one pair of sums to the driver."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    per = per.withColumns({"_cu_null": F.col("source").isNull(),
                           "_cu_cap": F.col("source_size") * F.lit(float(max_repeats))})
    ranked = dense_position(per, [], ["_cu_null", "source"], "_cu_i")
    table = stored(ranked.select(
        "source", "source_size", "_cu_cap", _cycle(weights, F.col("_cu_i")).alias("weight"),
        _cycle(slopes, F.col("_cu_i")).alias("slope")))
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0        # tokens for a weight of 1, for sources that are not capped
    while True:
        capped = F.col("_cu_cap") < F.lit(rate) * F.col("weight")
        fixed, free = table.agg(
            F.sum(F.when(capped, F.col("_cu_cap"))), F.sum(F.when(~capped, F.col("weight")))).first()
        new = (total - (fixed or 0.0)) / free if free else rate
        if new <= rate * (1 + 1e-15):
            break
        rate = new
    return table.select("source", "source_size", "weight", "slope", F.least(
        F.col("_cu_cap"), F.lit(rate) * F.col("weight")).alias("target"))


def supply(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
           text: str = "text", seed: int = SEED, **settings) -> DataFrame:
    """One row per document, without its text: doc_id, source, size, its place in
    the source's supply (``start``), the source's table row, ``passes`` (how
    often the mix takes the document) and ``taken`` words."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"), _row_key(doc_id, source, text),
        F.xxhash64(F.lit(seed), doc_id).alias("_cu_order"))
    placed = stored(running_total(
        sized, ["source"], ["_cu_order", "doc_id", "size", "_cu_key"], "size", "start"))
    t = targets(placed.select("source", "size"), **settings).withColumnRenamed("source", "_cu_source")
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - whole * F.col("source_size")
    inside = (F.col("start") + F.col("size") / 2.0 < rest).cast("long")
    # A source of no words at all is taken once.
    passes = F.when(F.col("source_size") > 0, whole + inside).otherwise(F.lit(1)).cast("long")
    return (placed.join(t, F.col("source").eqNullSafe(F.col("_cu_source"))).drop("_cu_source")
            .withColumn("passes", passes).withColumn("taken", F.col("size") * F.col("passes")))


def _row_key(doc_id: str, source: str, text: str) -> Column:
    return F.struct(F.col(doc_id).alias("i"), F.col(source).alias("s"),
                    *[h.alias(f"h{k}") for k, h in enumerate(two_hashes(F.coalesce(F.col(text), F.lit(""))))]
                    ).alias("_cu_key")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with equal keys (repeated documents) told apart by a number."""
    return rows.withColumn("_cu_k", F.row_number().over(
        Window.partitionBy("_cu_key").orderBy("_cu_key")))


def training_time(supply_row: Column, target: Column, slope: Column) -> Column:
    """t in [0, 1] at which the schedule's cumulative demand reaches the supply:
    the root of slope * t^2 + (1 - slope) * t = supply / target."""
    u = F.least(F.lit(1.0), F.coalesce(F.try_divide(supply_row, target), F.lit(0.0)))
    b = 1.0 - slope
    root = (2.0 * u) / (b + F.sqrt(b * b + 4.0 * slope * u))
    return F.when(u <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), root))


def copies(placed: DataFrame) -> DataFrame:
    """One row for each time the mix takes a document, with ``copy`` and its
    training ``position`` in [0, 1]; what a source gives beyond its target
    (less than a document) comes at the end."""
    each = placed.withColumn("copy", F.explode(F.sequence(
        F.lit(0), F.greatest(F.col("passes"), F.lit(1)) - 1))).filter("copy < passes")
    middle = F.col("copy") * F.col("source_size") + F.col("start") + F.col("size") / 2.0
    return each.withColumn("position", training_time(middle, F.col("target"), F.col("slope")))


def training_order(docs: DataFrame, numbered: DataFrame, doc_id: str = "doc_id",
                   source: str = "source", text: str = "text") -> DataFrame:
    """The mix: the columns of ``docs`` (``_cu_own_0``, ``_cu_own_1``, ...) once for
    each time a document is taken, range-sorted by training position, with the
    document's ``_cu_key`` and ``_cu_k``, and ``_cu_at`` (position, order, copy).
    ``numbered`` is their supply, numbered. Texts are moved twice: to meet the
    places of their document, which were found without them, and to be sorted.
    Rows and places are moved as one table by their key, so that numbering
    equal rows and giving each its places need no further move."""
    own = docs.select(_row_key(doc_id, source, text),
                      *[F.col(c).alias(f"_cu_own_{i}") for i, c in enumerate(docs.columns)])
    at = copies(numbered.filter("passes > 0")).groupBy("_cu_key", "_cu_k").agg(F.collect_list(
        F.struct("position", "_cu_order", "copy")).alias("_cu_at"))    # at most max_repeats
    both = own.unionByName(at, allowMissingColumns=True)
    # Rows come before places, which keep the number they have.
    row = F.row_number().over(Window.partitionBy("_cu_key").orderBy(F.col("_cu_at").isNotNull()))
    same = Window.partitionBy("_cu_key", "_cu_k")
    met = (both.withColumns({"_cu_is_row": F.col("_cu_at").isNull(), "_cu_n": row})
           .withColumn("_cu_k", F.coalesce("_cu_k", "_cu_n"))
           .withColumn("_cu_at", F.first("_cu_at", ignorenulls=True).over(same))
           .filter("_cu_is_row").drop("_cu_is_row", "_cu_n"))
    each = met.withColumn("_cu_at", F.explode("_cu_at"))
    return each.orderBy("_cu_at.position", "_cu_at._cu_order", "_cu_at.copy", "_cu_key", "_cu_k")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
                    text: str = "text", **settings) -> DataFrame:
    """The documents in training order (range-sorted by position), each as often
    as the mix takes it, with the columns they came with."""
    numbered = _numbered(supply(docs, doc_id, source, text, **settings))
    mix = training_order(docs, numbered, doc_id, source, text)
    return mix.select(*[F.col(f"_cu_own_{i}").alias(c) for i, c in enumerate(docs.columns)])


def mixture(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
            text: str = "text", **settings) -> DataFrame:
    """Per document: size, source_size, target, and what the mix itself, whole
    texts in training order, has of it: taken words, and of each copy its
    position and its place (0-based row of the mix)."""
    docs = docs.select(doc_id, source, text)
    numbered = stored(_numbered(supply(docs, doc_id, source, text, **settings)))
    mix = training_order(docs, numbered, doc_id, source, text)
    # Ids rise by one within a sorted partition; the partition is in bits 33 and up.
    seen = stored(mix.select("_cu_key", "_cu_k", F.col("_cu_at.position").alias("_cu_position"),
                             size_of(F.col("_cu_own_2")).alias("_cu_words"),
                             F.monotonically_increasing_id().alias("_cu_row"))
                  .withColumn("_cu_part", F.shiftright("_cu_row", 33)))
    # One row a partition.
    parts = seen.groupBy("_cu_part").agg(F.min("_cu_row").alias("_cu_first"), F.count(F.lit(1)).alias("_cu_n"))
    before = Window.orderBy("_cu_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("_cu_part", (F.coalesce(F.sum("_cu_n").over(before), F.lit(0))
                                      - F.col("_cu_first")).alias("_cu_base"))
    each = seen.join(F.broadcast(bases), "_cu_part").groupBy("_cu_key", "_cu_k").agg(
        F.sum("_cu_words").alias("_cu_taken"),
        F.sort_array(F.collect_list(F.struct(                          # at most max_repeats
            (F.col("_cu_base") + F.col("_cu_row")).alias("place"),
            F.col("_cu_position").alias("position")))).alias("_cu_at"))
    none = F.array().cast("array<struct<place:bigint,position:double>>")
    at = F.coalesce("_cu_at", none)
    return numbered.join(each, ["_cu_key", "_cu_k"], "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("_cu_taken", F.lit(0)).cast("long").alias("taken"),
        at["position"].alias("positions"), at["place"].alias("places"))
