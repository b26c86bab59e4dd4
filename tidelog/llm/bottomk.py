"""Document fingerprints as bottom-k sketches of shingle hashes (operator 6).

A sketch is the sorted k smallest of the distinct 64-bit hashes of a text's
word shingles. Sketches of parts merge into the sketch of the whole (the k
smallest of both), and estimate resemblance, containment and the number of
distinct shingles.

Shingles are five words (fewer words: all of them as one shingle; none: an
empty sketch). A word's hash sums its bytes' random values times powers of an
odd base modulo 2^64, so that all words of a batch are hashed in a few array
operations; a shingle's hash mixes its words' hashes in order.

``sketch_pairs`` walks the documents in ascending doc_id: they are dealt by
cuts of the ids, taken from a sample of them, sorted in each part, and the first
document of a part is also dealt to the part before it, so each document meets
the next one without a second copy of the texts being moved. Ids can be of any
type that has an order and is written in JSON. A much repeated id is cut by its
texts' hashes, too.

``merged`` puts sketches of parts together by key: tasks merge their own, so a
key's sketches meet as one row a task; ``compared`` adds resemblance,
containment and distinct counts to pairs of sketches.

Defined cases: a null text is an empty text; null ids come first; rows that
repeat an id follow each other by the hash of their text; the single row of a
table is its own next document; an empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

K = 128
SHINGLE = 5
_SEED = 6
#: Parts of the ids for each shuffle partition, so that partitions come out even.
PARTS = 8
#: Sampled ids a part, from which the cuts are taken.
SAMPLE = 16
#: Sketches that a merging task holds before they are sent on.
HELD = 1 << 15
#: Bytes hashed in one go; texts are gathered up to this (a longer one is alone).
BLOCK_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(_SEED).integers(0, 1 << 64, 256, dtype=np.uint64)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finaliser of splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes of the words of many texts at once; powers are kept."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts in order, and where each text's begin."""
        joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        n = len(joined)
        if n >= len(self.up):
            self.up, self.down = _powers(n + 1, _BASE), _powers(n + 1, _INVERSE)
        white = _IS_WHITE[joined]
        inside = ~white
        start = np.flatnonzero(inside & np.concatenate(([True], white[:-1])))
        end = np.flatnonzero(white & np.concatenate(([False], inside[:-1])))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
            _BYTE[joined] * self.up[:n], dtype=np.uint64)))
        hashes = mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))
        text_at = np.cumsum([0] + [len(t) + 1 for t in texts])
        return hashes, np.searchsorted(start, text_at)


def shingle_hashes(words: np.ndarray, at: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order of the texts, and where each text's begin."""
    n_words = np.diff(at)
    many = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    bounds = np.concatenate(([0], np.cumsum(many)))
    first = np.repeat(at[:-1] - bounds[:-1], many) + np.arange(bounds[-1])
    size = np.repeat(np.minimum(n_words, shingle), many)
    out = size.astype(np.uint64)
    for k in range(shingle):
        word = words[np.minimum(first + k, max(len(words) - 1, 0))] if len(words) else out
        out = np.where(k < size, mix(out * _BASE + word), out)
    return out, bounds


def sketch_of(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    if len(hashes) > 4 * k:       # copies may be among the smallest: take more until enough
        take = 2 * k
        while take < len(hashes):
            low = np.unique(np.partition(hashes, take - 1)[:take])
            if len(low) >= k:
                return low[:k]
            take *= 4
    return np.unique(hashes)[:k]


def sketches(texts: list[str], k: int = K, shingle: int = SHINGLE,
             hasher: WordHasher | None = None) -> list[np.ndarray]:
    """The sketch of each text."""
    hasher = hasher or WordHasher()
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(raw):
        hi, size = lo, 0
        while hi < len(raw) and (hi == lo or size + len(raw[hi]) <= BLOCK_BYTES):
            size += len(raw[hi])
            hi += 1
        h, at = shingle_hashes(*hasher(raw[lo:hi]), shingle)
        out += [sketch_of(h[a:b], k) for a, b in zip(at.tolist(), at[1:].tolist())]
        lo = hi
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of two shingle sets."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity (two empty sets: 1; exact when both sets
    together have at most k shingles)."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1.0) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds (empty a: 1)."""
    n = distinct(a, k)
    if not n:
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / n)


def to_text(a: np.ndarray) -> str:
    """A sketch as text: base64 of its hashes, big-endian."""
    return base64.b64encode(a.astype(">u8").tobytes()).decode("ascii")


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint and the estimated number of distinct shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            found = sketches([t or "" for t in b.column(1).to_pylist()], k, shingle, hasher)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([to_text(s) for s in found], pa.string()),
                 pa.array([distinct(s, k) for s in found], pa.float64())],
                names=["doc_id", "fingerprint", "n_shingles"])
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, fingerprint string, n_shingles double")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the
    following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def merged(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """The sketch of all parts of each key: ``by``, fingerprint and n_shingles,
    from rows of (by, fingerprint)."""
    names = [*by, "fingerprint", "n_shingles"]
    src = sketches.select(*by, "fingerprint")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1])
    types = [f.dataType for f in src.schema[:-1]]

    def rows(keys: list[tuple], found: list[np.ndarray]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type
        columns = [pa.array([key[c] for key in keys], to_arrow_type(t)) for c, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([
            *columns, pa.array([to_text(s) for s in found], pa.string()),
            pa.array([distinct(s, k) for s in found], pa.float64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            for *key, text in zip(*[c.to_pylist() for c in b.columns]):
                own = from_text(text)
                key = tuple(key)
                held[key] = merge(held[key], own, k) if key in held else own[:k]
            if len(held) > HELD:
                yield rows(list(held), list(held.values()))
                held = {}
        yield rows(list(held), list(held.values()))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a key come one after another: one sketch is held.
        key, sketch = None, None
        for b in batches:
            keys, out = [], []
            for *own, text in zip(*[c.to_pylist() for c in b.columns]):
                if tuple(own) == key:
                    sketch = merge(sketch, from_text(text), k)
                    continue
                if key is not None:
                    keys.append(key)
                    out.append(sketch)
                key, sketch = tuple(own), from_text(text)
            yield rows(keys, out)
        if key is not None:
            yield rows([key], [sketch])

    out = f"{kinds}, fingerprint string, n_shingles double"
    partial = src.mapInArrow(run, out).select(*by, "fingerprint")
    return partial.repartition(*by).sortWithinPartitions(*by).mapInArrow(last, out)


def compared(pairs: DataFrame, a: str = "a", b: str = "b", k: int = K) -> DataFrame:
    """Pairs of sketches (fingerprints in columns a and b) with resemblance,
    a_in_b and b_in_a (containment), a_shingles and b_shingles."""
    names = ["resemblance", "a_in_b", "b_in_a", "a_shingles", "b_shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([from_text(t) for t in batch.column(c).to_pylist()] for c in (a, b))
            rows = [(resemblance(p, q, k), containment(p, q, k), containment(q, p, k), distinct(p, k), distinct(q, k))
                    for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array([r[c] for r in rows], pa.float64()) for c in range(5)]],
                names=[*batch.schema.names, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(run, kinds + "".join(f", {c} double" for c in names))


def _cuts(ids: DataFrame, parts: int) -> list[tuple[object, int]]:
    """(id, hash) where parts begin, ascending: from a sample of at most some
    ``SAMPLE`` ids a part, so that parts have about as many rows. An id of more
    than a part's rows is cut at even steps of its texts' hashes."""
    total = ids.count()
    share = SAMPLE * parts / total if total else 1.0
    sample = ids.sample(share, _SEED) if share < 1 else ids
    rows = sample.filter("doc_id IS NOT NULL").groupBy("doc_id").count().orderBy("doc_id").collect()
    per = max(1, sum(r["count"] for r in rows) / parts)
    cuts, upto = [], 0.0
    for r in rows:
        if upto >= per:
            cuts.append((r["doc_id"], -(1 << 63)))
            upto = 0.0
        steps = int(r["count"] / per)
        cuts += [(r["doc_id"], -(1 << 63) + (j << 64) // (steps + 1)) for j in range(1, steps + 1) if steps > 1]
        upto = 0.0 if steps > 1 else upto + r["count"]
    return cuts


def _dealt(docs: DataFrame) -> DataFrame:
    """doc_id, text, h (the text's hash), part and guest: documents dealt to
    parts by cuts of their ids, and the first document of each part (and of the
    next parts, should they be empty) as a guest at the end of the part before
    it; the very first is the last part's guest."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    cuts = _cuts(docs.select("doc_id"), PARTS * partitions(spark))
    own = docs.withColumn("h", F.xxhash64("text"))
    part = F.lit(0)
    if cuts:
        # The number of cuts at or before the row, from one constant: the blocks
        # of cuts that begin there, and then those of the last of these blocks.
        per = max(1, int(len(cuts) ** 0.5))
        blocks = [[{"i": i, "h": h} for i, h in cuts[k:k + per]] for k in range(0, len(cuts), per)]
        table = F.from_json(F.lit(json.dumps(blocks, default=str)), f"array<array<struct<i: {kind}, h: bigint>>>")
        row = F.struct(F.col("doc_id").alias("i"), F.col("h"))
        block = F.size(F.filter(table, lambda b: b[0] <= row)) - 1
        inside = F.size(F.filter(F.get(table, block), lambda c: c <= row))
        part = F.when(F.col("doc_id").isNull() | (block < 0), F.lit(0)).otherwise(block * per + inside)
    own = own.withColumn("part", part.cast("int"))
    order = F.struct(F.col("doc_id").isNotNull().alias("k"), F.col("doc_id"), "h")
    # At most one row for each of the parts.
    firsts = own.groupBy("part").agg(F.min(order).alias("first")).orderBy("part").collect()
    before = {r["part"]: firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    if not before:
        return own.withColumn("guest", F.lit(False))
    heads = spark.createDataFrame(
        [(r["part"], before[r["part"]], r["first"]["doc_id"], r["first"]["h"]) for r in firsts],
        f"part int, to int, head {kind}, head_h long")
    guests = (own.join(F.broadcast(heads), "part")
              .filter(F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("h") == F.col("head_h")))
              .select("doc_id", "text", "h", F.col("to").alias("part"), F.lit(True).alias("guest")))
    return own.withColumn("guest", F.lit(False)).unionByName(guests)


def sketch_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                 shingle: int = SHINGLE) -> DataFrame:
    """Per document: n_chars, the edited text's SHA-256, both fingerprints, the
    resemblance of its sketch to the edited text's and the next document's, the
    number of its distinct shingles, and the share of them that the next document
    holds."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = partitions(docs.sparkSession)
    ordered = _dealt(src).repartition(n, "part").sortWithinPartitions("part", "guest", "doc_id", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        waiting = None        # the last document seen: part, id, text, sketch
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                rows = b.slice(lo, 1000)
                part, ids = rows.column(0).to_pylist(), rows.column(1)
                texts, guest = rows.column(2).to_pylist(), rows.column(3).to_pylist()
                own = sketches(texts, k, shingle, hasher)
                at: list[tuple] = []
                for i in range(len(texts)):
                    if waiting is not None and waiting[0] == part[i]:
                        at.append((waiting, texts[i], own[i]))
                    waiting = None if guest[i] else (part[i], ids[i].as_py(), texts[i], own[i])
                made = [edited(w[2], t) for w, t, _ in at]
                after = sketches(made, k, shingle, hasher)
                yield pa.RecordBatch.from_arrays([
                    pa.array([w[1] for w, _, _ in at], ids.type),
                    pa.array([len(w[2]) for w, _, _ in at], pa.int64()),
                    pa.array([hashlib.sha256(m.encode("utf-8", "surrogatepass")).hexdigest()
                              for m in made], pa.string()),
                    pa.array([to_text(w[3]) for w, _, _ in at], pa.string()),
                    pa.array([to_text(s) for s in after], pa.string()),
                    pa.array([resemblance(w[3], s, k) for (w, _, _), s in zip(at, after)], pa.float64()),
                    pa.array([resemblance(w[3], s, k) for w, _, s in at], pa.float64()),
                    pa.array([distinct(w[3], k) for w, _, _ in at], pa.float64()),
                    pa.array([containment(w[3], s, k) for w, _, s in at], pa.float64())],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                           "near_edited", "near_next", "n_shingles", "in_next"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return ordered.select("part", "doc_id", "text", "guest").mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double, n_shingles double, in_next double")
