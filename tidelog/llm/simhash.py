"""SimHash near-dedup by multi-index hashing (operator 10).

Texts become 64-bit fingerprints; equal fingerprints collapse into one. A
fingerprint is cut into segments. Two fingerprints within ``max_bits`` differ
by at most ``max_bits // segments`` bits in one of them, so each fingerprint is
indexed under its segment values and looked up under every value of the small
Hamming ball around them; the matches are verified over all 64 bits. Links
become groups by repeated star contraction, checkpointed each round.

No bucket is emitted as pairs: a task compares bucket rows in blocks of bounded
size and emits a spanning forest of the links it found, at most one row per
fingerprint. Buckets of more than BLOCK fingerprints are dealt to a grid of
blocks, all of which are compared, so no link is lost.

Defined cases: a null text is an empty text, whose fingerprint is zero; fewer
words than a shingle: all words as one shingle; a null doc_id takes no part in
the smallest id of a group (a group of null ids has a null id); repeated rows
repeat in the result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored, two_hashes

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = 3
#: Index fingerprints of one bucket that one task compares with as many others.
BLOCK = 4096
#: Pairs compared at once, and links held before they are reduced to a forest.
PAIRS = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of one text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    last = (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]) - 1
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(joined[a:b], seed) for a, b in zip(
        starts[:n].tolist(), last.tolist())], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):     # bounded memory for very long texts
        part = hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, fp long")


def segment_widths(segments: int) -> list[tuple[int, int]]:
    """(offset, width) of each segment of 64 bits, as equal as possible."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ball(width: int, radius: int) -> list[int]:
    """Masks of 1 to ``radius`` bits out of ``width``."""
    out, layer = [], [0]
    for _ in range(radius):
        layer = [m | 1 << b for m in layer for b in range(m.bit_length(), width)]
        out += layer
    return out


def probe_rows(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """Index rows (role 1) and ball rows (role 0) of each fingerprint, as
    (seg, val, fp, role). A pair that differs within a segment is found from
    the side whose lowest differing bit is clear, so each pair of segment
    values is looked up once."""
    def of(seg: int, at: int, width: int) -> list[Column]:
        val = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))
        row = lambda v, role: F.struct(
            F.lit(seg).alias("seg"), v.alias("val"), F.lit(role).alias("role"))
        masks = F.array(*[F.lit(m).cast("long") for m in ball(width, max_bits // segments)])
        near = F.transform(F.filter(masks, lambda m: val.bitwiseAND(m.bitwiseAND(-m)) == 0),
                           lambda m: row(val.bitwiseXOR(m), 0))
        return [F.array(row(val, 1)), *([near] if max_bits >= segments else [])]
    rows = [x for seg, (at, width) in enumerate(segment_widths(segments)) for x in of(seg, at, width)]
    return fps.select("fp", F.explode(F.concat(*rows)).alias("r")).select(
        "r.seg", "r.val", "r.role", "fp")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links reduced to stars: (node, smallest node of its component)."""
    if not len(a):
        return a, b
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:                    # pointer jumping
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def matches(start: np.ndarray, n_query: np.ndarray, right: np.ndarray, n_right: np.ndarray,
            fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links of many buckets. Bucket g's queries are the rows start[g]
    to start[g] + n_query[g], its indexed rows right[g] to right[g] + n_right[g];
    their pairs are compared at most PAIRS at a time."""
    total = np.cumsum(n_query * n_right)
    for lo in range(0, int(total[-1]) if len(total) else 0, PAIRS):
        k = np.arange(lo, min(lo + PAIRS, int(total[-1])))
        g = np.searchsorted(total, k, side="right")
        k -= np.where(g > 0, total[g - 1], 0)
        a, b = fp[start[g] + k // n_right[g]], fp[right[g] + k % n_right[g]]
        near = (np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits) & (a != b)
        yield a[near], b[near]


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          block: int = BLOCK) -> DataFrame:
    """(fp, root): forests of links between distinct fingerprints within
    ``max_bits``; every pair within ``max_bits`` is connected by them."""
    rows = probe_rows(fps, max_bits, segments)
    keys = ["seg", "val", "bi", "bj"]
    crowded = (probe_rows(fps, 0, segments).groupBy("seg", "val")
               .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
               .select("seg", "val", F.ceil(F.col("n") / block).cast("int").alias("c")))
    # Role 1 both looks up and is looked up. In a grid of c x c blocks the two
    # sides are dealt apart: queries (0) to a row of blocks, indexed (2) to a column.
    rows = rows.join(crowded, ["seg", "val"], "left")
    one = F.array(F.struct(F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.col("role").alias("role")))
    mine, every = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"), F.sequence(
        F.lit(0), F.col("c") - 1)
    asks = F.transform(every, lambda j: F.struct(
        mine.alias("bi"), j.alias("bj"), F.lit(0).alias("role")))
    held = F.transform(every, lambda i: F.struct(
        i.alias("bi"), mine.alias("bj"), F.lit(2).alias("role")))
    dealt = F.when(F.col("c").isNull(), one).when(F.col("role") == 1, F.concat(asks, held)).otherwise(asks)
    rows = rows.select("seg", "val", "fp", F.explode(dealt).alias("d")).select(
        "seg", "val", "d.bi", "d.bj", "d.role", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = np.empty((0, 6), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def compare(x: np.ndarray) -> None:
            nonlocal held, found
            cut = np.flatnonzero((x[1:, :4] != x[:-1, :4]).any(axis=1)) + 1
            start = np.concatenate(([0], cut)).astype(np.int64)
            size = np.diff(np.concatenate((start, [len(x)])))
            asks = np.add.reduceat((x[:, 4] <= 1).astype(np.int64), start)
            has = np.add.reduceat((x[:, 4] >= 1).astype(np.int64), start)
            use = (asks > 0) & (has > 0) & (size > 1)
            s, q, h, e = start[use], asks[use], has[use], (start + size)[use]
            for a, b in matches(s, q, e - h, h, np.ascontiguousarray(x[:, 5]), max_bits):
                found.append((a, b))
                held += len(a)
                if held > PAIRS:
                    found = [forest(*(np.concatenate(c) for c in zip(*found)))]
                    held = len(found[0][0])

        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
            x = np.concatenate([left, x])
            if not len(x):
                continue
            ends = np.flatnonzero((x[1:, :4] != x[:-1, :4]).any(axis=1))
            at = int(ends[-1]) + 1 if len(ends) else 0
            if at:
                compare(x[:at])
            left = x[at:]
        if len(left):
            compare(left)
        if found:
            a, b = forest(*(np.concatenate(c) for c in zip(*found)))
            for k in range(0, len(a), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[k:k + 100_000]), pa.array(b[k:k + 100_000])], names=["fp", "root"])

    n = partitions(fps.sparkSession)
    return rows.repartition(n, *keys).sortWithinPartitions(*keys, "role").mapInArrow(
        run, "fp long, root long")


def components(edges: DataFrame, a: str = "fp", b: str = "root") -> DataFrame:
    """(node, root): the smallest node reachable from each node of the links,
    by alternating large-star and small-star steps until nothing changes."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter("u != v").distinct().checkpoint())
    before = None
    while True:
        # Large star: each node's larger neighbours move to its smallest one.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").filter("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: each node's smaller neighbours and itself move to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").filter("u != v").distinct())
        e = small.checkpoint()
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                          F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _grouped(fps: DataFrame, low: Column, max_bits: int, segments: int) -> DataFrame:
    """(fp, lowest): each fingerprint, and the smallest ``low`` of its group."""
    distinct = fps.groupBy("fp").agg(F.min(low).alias("low"))
    roots = components(links(distinct.select("fp"), max_bits, segments))
    grouped = (distinct.join(roots, distinct.fp == roots.node, "left")
               .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("lowest"))
    return grouped.join(lowest, "root").select("fp", "lowest")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    fps = stored(fingerprints(docs, doc_id, text, shingle))
    named = _grouped(fps, F.col("doc_id"), max_bits, segments)
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("lowest").alias("component_id"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                 segments: int = SEGMENTS) -> DataFrame:
    """One document of each group, that of the smallest id; all columns stay.
    An id may repeat: texts are told apart by two hashes beside it, so that each
    stays or goes with its own group, and of equal rows (id and text) one stays.
    Rows of a null id always stay."""
    a, b = two_hashes(F.coalesce(F.col(text), F.lit("")))
    own = F.struct(F.col(doc_id).alias("id"), a.alias("a"), b.alias("b"))
    fps = stored(fingerprints(docs.select(own.alias("_sh_own"), F.col(text).alias("_sh_text")),
                              "_sh_own", "_sh_text", shingle))
    known = F.col("doc_id.id").isNotNull()
    named = _grouped(fps, F.when(known, F.col("doc_id")), max_bits, segments)
    rows = fps.filter(known).join(named, "fp")
    key = [F.col(f"doc_id.{c}").alias(f"_sh_{c}") for c in ("id", "a", "b")]
    names = ["_sh_id", "_sh_a", "_sh_b"]
    gone = rows.filter("doc_id != lowest").select(*key)
    again = stored(rows.filter("doc_id = lowest").select(*key).groupBy(*names).count()
                   .filter("count > 1").select(*names))
    keyed = docs.withColumns({"_sh_id": F.col(doc_id), "_sh_a": a, "_sh_b": b})
    stay = keyed.join(gone, names, "left_anti")
    if not again.isEmpty():            # only repeated rows are moved to be one
        stay = stay.join(again, names, "left_anti").unionByName(
            stay.join(again, names, "left_semi").dropDuplicates(names))
    return stay.select(*docs.columns)
