"""Spelling variant grouping with a frequency-vector trie (operator 11).

Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF, A-Z lower-cased) that
occur at least ``min_count`` times and have at least ``min_length`` letters.
Two are near if they differ by one inserted, deleted or replaced letter.

A word's frequency vector counts its letters, then those of each of ``GROUPS``;
a trie arranges the words by the first count, then the second, and so on. One
edit moves a vector by one surplus (a letter more in a group), one deficit, or
both, so a depth-first search from the root spends a budget of one each and
finds all near words; words at its leaves are verified letter by letter. Of a
pair, the search goes from the shorter word, or from the one whose vector is
smaller where they first differ, so the surplus is spent before the deficit and
each pair is found once.

The search takes many words at once: an entry of its stack is a set of words,
each at its node, that have spent the same; one step takes them a level down,
once for each of the three moves. A vector is one 64-bit number with the first
count on top, so a node is a range of the sorted numbers.

On Spark the trie is cut into buckets: a node of more than LIMIT words (at least
``bucket``, and at least words / (8 * partitions), so that there are at most
8 * partitions such nodes a level) is opened, its other children are buckets.
The opened nodes are broadcast; tasks walk them with all words of a batch at
once and send each word to the buckets it reaches. A bucket's index words make
a trie in one task, and the queries are streamed past it. Buckets of many
queries, and words of one vector that are more than a bucket, are dealt into
blocks of a grid, so that every pair still meets in one cell.

Counts above 15 are taken as 15 in vectors (of all letters: 255): differences
only shrink by that, so no near pair is lost, and a node has at most 16 children.

Defined cases: a null or empty text has no words; repeated rows and ids count as
often as they occur; with a null id no letter is deleted. Words of any length
are whole. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored

#: Levels of the trie below the number of letters, from the letters that tell
#: most words apart to the rest; letters beyond z are the last one.
GROUPS = ["e", "a", "i", "n", "r", "s", "t", "o", "lu", "dc", "mbp", "ghfk", "vwjqxyz",
          "".join(map(chr, range(0xC0, 0x100)))]
TOP_COUNT, TOP_LENGTH = 15, 255
LEVELS = len(GROUPS) + 1
#: Place of each level's count in the number: eight bits and then four each.
SHIFT = [4 * (LEVELS - 1 - k) for k in range(LEVELS)]
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DROP_MOD = 31
BUCKET = 1 << 15
QUERIES = 1 << 17
#: Distinct words held by a counting task before they are sent on.
HELD = 1 << 19
#: Words up to this length are compared as rows of a matrix, longer ones singly.
WIDE = 48
#: Index words of a node that are compared without going down further; pairs
#: compared at once, and queries searched for together.
LEAF, PAIRS, TOGETHER = 8, 1 << 18, 1 << 15

#: Latin-1 bytes of a text: letters lower-cased (A-Z only), the rest a space.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_GROUP_OF = np.full(256, len(GROUPS), np.uint8)
for _g, _letters in enumerate(GROUPS):
    for _c in _letters:
        _GROUP_OF[ord(_c)] = _g


# --- words --------------------------------------------------------------------

def letter_runs(text: str) -> list[bytes]:
    """The runs of letters of a text, as Latin-1 bytes (other characters of the
    text are not Latin-1 letters, so they separate runs whatever they become)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def with_slips(doc_id: object, counts: Counter, min_length: int, drop_mod: int) -> Iterator[tuple[bytes, int]]:
    """Words of a document with their counts; of those whose crc32 of
    ``<doc_id>:<word>`` is divisible by ``drop_mod`` one letter is deleted."""
    head = None if doc_id is None or not drop_mod else zlib.crc32(f"{doc_id}:".encode())
    for w, n in counts.items():
        if len(w) < min_length:
            continue
        if head is not None:
            h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), head)
            if h % drop_mod == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
                if len(w) < min_length:
                    continue
        yield w, n


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, drop_mod: int = DROP_MOD) -> DataFrame:
    """(word, n) of every word of at least ``min_length`` letters and
    ``min_count`` occurrences. Each task sums its own texts first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for k in range(0, len(words), 1 << 16):
                some = words[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("latin-1") for w in some], pa.string()),
                     pa.array([held[w] for w in some], pa.int64())], names=["word", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, n in with_slips(i, Counter(letter_runs(t or "")), min_length, drop_mod):
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield from out()
                    held.clear()
        yield from out()

    src = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- frequency vectors and their trie -------------------------------------------

def vector(word: Column) -> Column:
    """The number of letters (at most 255) and the letter-group counts (at most
    15 each) of a word."""
    return F.array(F.least(F.char_length(word), F.lit(TOP_LENGTH)), *[F.least(
        F.char_length(word) - F.char_length(F.translate(word, g, "")), F.lit(TOP_COUNT)) for g in GROUPS])


def open_nodes(words: DataFrame, limit: int) -> dict[tuple[int, ...], dict[int, int | None]]:
    """The opened nodes of the trie: their children by count, with a bucket
    number, or None for a child that is opened too. ``words`` has the vector
    ``v``. At most words / limit nodes a level are opened."""
    nodes: dict[tuple[int, ...], dict[int, int | None]] = {}
    spark = words.sparkSession
    buckets, level = 0, [()]
    for depth in range(LEVELS):
        if not level:
            break
        under = words
        if depth:
            parents = spark.createDataFrame([(list(p),) for p in level], "p array<int>")
            under = words.join(F.broadcast(parents), F.slice("v", 1, depth) == F.col("p"), "left_semi")
        sums = under.groupBy(F.slice("v", 1, depth + 1).alias("p")).count().collect()
        nodes |= {p: {} for p in level}
        level = []
        for row in sorted(sums):
            p = tuple(row["p"])
            if row["count"] > limit and depth + 1 < LEVELS:
                level.append(p)
                nodes[p[:-1]][p[-1]] = None
            else:
                nodes[p[:-1]][p[-1]] = buckets
                buckets += 1
    return nodes


def as_matrix(words: list[bytes], width: int) -> np.ndarray:
    """Words as rows of bytes, 0 beyond their end."""
    return np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)


def vectors(words: list[bytes]) -> np.ndarray:
    """The vector of each word as a row of counts."""
    flat = _GROUP_OF[np.frombuffer(b"".join(words), np.uint8)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    of = np.repeat(np.arange(len(words)), sizes)
    g = len(GROUPS)
    n = np.bincount(of * g + flat, minlength=len(words) * g).reshape(-1, g)
    return np.concatenate((np.minimum(sizes, TOP_LENGTH)[:, None], np.minimum(n, TOP_COUNT)), 1)


def packed(v: np.ndarray) -> np.ndarray:
    """Vectors as numbers whose order is that of the vectors."""
    return (v.astype(np.uint64) << np.array(SHIFT, np.uint64)).sum(1, dtype=np.uint64)


#: What a query has spent: nothing; on the number of letters, so that one surplus
#: is to come; the surplus of a word as long; all.
NOTHING, LONGER, SURPLUS, ALL = range(4)


def steps(level: int, spent: int) -> list[tuple[int, int]]:
    """The moves at a level: (change of the count, what is spent then)."""
    if level == 0:
        return [(0, NOTHING), (1, LONGER)]
    return {NOTHING: [(0, NOTHING), (1, SURPLUS)], LONGER: [(0, LONGER), (1, ALL)],
            SURPLUS: [(0, SURPLUS), (-1, ALL)], ALL: [(0, ALL)]}[spent]


def reached(nodes: dict, v: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Depth-first through the opened nodes: (bucket, rows of v that reach it)."""
    stack = [((), np.arange(len(v)), NOTHING)]
    while stack:
        prefix, live, spent = stack.pop()
        counts = v[live, len(prefix)]
        children = nodes.get(prefix, {})
        for change, then in steps(len(prefix), spent):
            for c in np.unique(counts).tolist():
                if c + change not in children:
                    continue
                rows, bucket = live[counts == c], children[c + change]
                if bucket is None:
                    stack.append(((*prefix, c + change), rows, then))
                else:
                    yield bucket, rows


def home(nodes: dict, v: np.ndarray) -> np.ndarray:
    """The bucket of each vector."""
    out = np.empty(len(v), np.int64)
    for i, row in enumerate(v.tolist()):
        p: tuple[int, ...] = ()
        while (b := nodes[p][row[len(p)]]) is None:
            p = (*p, row[len(p)])
        out[i] = b
    return out


def one_edit(p: bytes, q: bytes) -> bool:
    """Whether one letter inserted, deleted or replaced makes p into q."""
    if len(p) > len(q):
        p, q = q, p
    if p == q or len(q) - len(p) > 1:
        return False
    k = next((k for k, (s, t) in enumerate(zip(p, q)) if s != t), len(p))
    return p[k + (len(p) == len(q)):] == q[k + 1:]


class Words:
    """Words with their vectors, and as rows of bytes."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.v = vectors(words)
        self.key = packed(self.v)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.rows = as_matrix([w if len(w) <= WIDE else b"" for w in words], WIDE + 1)


def in_order(words: list[bytes], n: list[np.ndarray]) -> tuple[Words, np.ndarray]:
    """Words and their counts in the order of their vectors."""
    by = np.argsort(packed(vectors(words)), kind="stable")
    return Words([words[i] for i in by.tolist()]), np.concatenate(n)[by]


def verified(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether a's words i and b's words j are near, from the side that finds
    the pair: the shorter word, or the smaller vector, or (of equal vectors) the
    smaller word."""
    x, y = a.rows[i], b.rows[j]
    differ = x != y
    first = differ.argmax(1)
    n = np.arange(len(i))
    replaced = (a.size[i] == b.size[j]) & (differ.sum(1) == 1)
    # An insertion: the same up to a place, and shifted by one from there.
    shifted = np.arange(WIDE) < first[:, None]
    shifted |= x[:, :-1] == y[:, 1:]
    inserted = (a.size[i] + 1 == b.size[j]) & shifted.all(1)
    smaller = (a.key[i] < b.key[j]) | ((a.key[i] == b.key[j]) & (x[n, first] < y[n, first]))
    out = (replaced & smaller) | inserted
    for k in np.flatnonzero(np.maximum(a.size[i], b.size[j]) > WIDE).tolist():
        p, q = a.words[i[k]], b.words[j[k]]
        out[k] = (len(p), a.key[i[k]], p) < (len(q), b.key[j[k]], q) and one_edit(p, q)
    return out


def near_in(index: Words, queries: Words) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of queries, row of index) of near words, each found from one
    side; ``index`` is in the order of its vectors."""
    found_i, found_j = [], []

    def compare(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        many = hi - lo
        upto = np.cumsum(many)
        for k in range(0, int(upto[-1]), PAIRS):
            at = np.arange(k, min(k + PAIRS, int(upto[-1])))
            of = np.searchsorted(upto, at, side="right")
            i, j = q[of], hi[of] - (upto[of] - at)
            # At most two counts differ (and the number of letters).
            x = queries.key[i] ^ index.key[j]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            few = np.bitwise_count(x & _NIBBLES) <= 2
            i, j = i[few], j[few]
            ok = verified(queries, i, index, j)
            found_i.append(i[ok])
            found_j.append(j[ok])

    n = len(queries.words)
    stack = [(0, NOTHING, np.arange(n), queries.key, np.zeros(n, np.int64), np.full(n, len(index.words)))]
    while stack:
        level, spent, q, key, lo, hi = stack.pop()
        few = hi - lo <= LEAF if level < LEVELS else np.ones(len(q), bool)
        if few.any():
            compare(q[few], lo[few], hi[few])
            q, key = q[~few], key[~few]
        if not len(q):
            continue
        shift = np.uint64(SHIFT[level])
        count = (key >> shift) & np.uint64(TOP_COUNT if level else TOP_LENGTH)
        for change, then in steps(level, spent):
            able = count < (TOP_COUNT if level else TOP_LENGTH) if change > 0 else count > 0 if change < 0 else None
            own, moved = (q, key) if able is None else (q[able], key[able])
            if change > 0:
                moved = moved + (np.uint64(1) << shift)
            elif change < 0:
                moved = moved - (np.uint64(1) << shift)
            node = moved >> shift
            a = np.searchsorted(index.key, node << shift)
            # The last node's end is beyond all numbers.
            end = (node << shift) | ((np.uint64(1) << shift) - np.uint64(1))
            b = np.searchsorted(index.key, end, side="right")
            there = b > a
            if there.any():
                stack.append((level + 1, then, own[there], moved[there], a[there], b[there]))
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


#: The lowest bit of each letter group's count.
_NIBBLES = np.uint64(sum(1 << k for k in SHIFT[1:]))


# --- the search on Spark ------------------------------------------------------------

def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def near_words(words: DataFrame, bucket: int = BUCKET, queries: int = QUERIES) -> DataFrame:
    """(word, near, near_n), both ways, of every pair of near words of
    (word, n): distinct Latin-1 words."""
    spark = words.sparkSession
    parts = partitions(spark)
    listed = stored(words.select("word", "n", vector(F.col("word")).alias("v")))
    limit = max(bucket, listed.count() // (8 * parts))
    nodes = spark.sparkContext.broadcast(open_nodes(listed, limit))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = vectors(_latin(b.column("word")))
            at, to = [np.arange(len(v))], [home(nodes.value, v)]
            index = len(v)
            for k, rows in reached(nodes.value, v):
                at.append(rows)
                to.append(np.full(len(rows), k))
            rows = pa.array(np.concatenate(at))
            query = np.arange(len(rows)) >= index
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(to).astype(np.int32)), pa.array(query),
                 b.column("word").take(rows), b.column("n").take(rows)],
                names=["bucket", "query", "word", "n"])

    sent = stored(listed.select("word", "n").mapInArrow(
        spread, "bucket int, query boolean, word string, n long"))
    sizes = sent.groupBy("bucket").agg(
        F.ceil(F.count_if(~F.col("query")) / F.lit(2 * limit)).cast("int").alias("n_i"),
        F.ceil(F.count_if("query") / F.lit(max(queries, 8 * limit))).cast("int").alias("n_q"))
    grid = sizes.filter("n_i > 1 OR n_q > 1")
    # At most rows / limit buckets are dealt into blocks.
    dealt = sent.join(F.broadcast(grid), "bucket", "left")
    h = F.xxhash64("word")
    n_i, n_q = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("n_i", "n_q"))
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), n_i).otherwise(n_q) - 1))
    cells = dealt.withColumn("own", F.pmod(h, F.when(F.col("query"), n_q).otherwise(n_i)).cast("int")).select(
        "bucket", "query", "word", "n", "own", others.alias("other")).select(
            "bucket", F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("i"),
            F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("q"), "query", "word", "n")
    cells = cells.repartition(parts, "bucket", "i", "q").sortWithinPartitions("bucket", "i", "q", "query", "word")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: tuple | None = None
        index, index_n, asked, asked_n = [], [], [], []
        trie: tuple[Words, np.ndarray] | None = None

        def answers() -> Iterator[pa.RecordBatch]:
            """The pairs of the queries held."""
            nonlocal trie
            if index and asked:
                trie = trie or in_order(index, index_n)
                words, n = trie
                queries, m = in_order(asked, asked_n)      # neighbours share paths
                i, j = near_in(words, queries)
                a = pa.array([queries.words[x].decode("latin-1") for x in i.tolist()], pa.string())
                c = pa.array([words.words[x].decode("latin-1") for x in j.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([a, c, pa.array(n[j])], names=names)
                yield pa.RecordBatch.from_arrays([c, a, pa.array(m[i])], names=names)
            asked.clear()
            asked_n.clear()

        for b in batches:
            keys = np.stack([b.column(k).to_numpy() for k in ("bucket", "i", "q")] + [
                b.column("query").to_numpy(zero_copy_only=False).astype(np.int32)], 1)
            cuts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
            for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                here, query = tuple(keys[lo, :3].tolist()), bool(keys[lo, 3])
                if here != cell:
                    yield from answers()
                    cell, index, index_n, trie = here, [], [], None
                words, n = (asked, asked_n) if query else (index, index_n)
                words += _latin(part.column("word"))
                n.append(part.column("n").to_numpy())
                if len(asked) >= TOGETHER:
                    yield from answers()
        yield from answers()

    names = ["word", "near", "near_n"]
    return cells.mapInArrow(search, "word string, near string, near_n long")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, drop_mod: int = DROP_MOD,
             bucket: int = BUCKET, queries: int = QUERIES) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word. The form is the
    near word of largest n (ties: the smallest), if that is at least ``ratio``
    (2 or more) times the word's n; the root is the last one when forms are
    followed."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that forms don't go in circles")
    words = stored(word_counts(docs, doc_id, text, min_length, min_count, drop_mod))
    best = near_words(words, bucket, queries).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    own = words.join(best, "word", "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    table = stored(own.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")))
    return with_roots(table, ratio)


def with_roots(table: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Follow forms by pointer jumping: the reach doubles each round, and a chain
    is no longer than the largest n has powers of ``ratio``."""
    links = stored(table.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    top = table.agg(F.max("n")).first()[0] or 1
    longest, reach = 0, 1
    while ratio ** (longest + 1) <= top:
        longest += 1
    while reach < longest:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("_sp_next"))
        links = stored(links.join(on, "root", "left").select(
            "word", F.coalesce("_sp_next", "root").alias("root")))
        reach *= 2
    return table.join(links, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
