"""Best-fit packing by linear grouping (operator 4).

Texts are tokenised, ended with one id, and cut into pieces of at most
``capacity`` tokens. Pieces go into as few sequences as possible:

1. large lengths, longest first, are cut into groups of equal cardinality, and
   each length is rounded up to the longest of its group;
2. for those few sizes, configurations (sizes that fit one sequence together)
   are optimised by a knapsack over the sizes left, the best one being used as
   often as its sizes last;
3. the actual documents take the places of the rounded sizes;
4. small pieces, longest first, go where they leave the least room (best fit).

Only the histogram of lengths, at most ``capacity`` rows, comes to the driver.
The plan is made on it: classes of sequences with equal contents and how many
of each. A piece finds its place from its length and its rank among pieces of
that length, so the plan grows with ``capacity`` and not with the data, and
its broadcast is bounded by that.

Defined cases: a null text is an empty text (one piece, the end id alone); a
null doc_id is kept; repeated rows are packed as often as they occur; an empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.scan import dense_position

from .common import stored

CAPACITY = 4096
END_ID = 1
GROUPS = 256
#: Lengths up to capacity / SMALL are small: placed by best fit at the end.
SMALL = 16
TOKENIZER = "word_bpe_49k.json"

#: Whitespace that str.split() and the tokenizer's \s may see differently.
_ODD_SPACE = re.compile(
    "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: Latin-1 bytes: lower case, and kinds (a letter or ASCII digit, white space,
#: the marks . and , others, and X for space that is seen differently).
_LETTER = re.compile(b"[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
_KIND = bytes(
    ord("a") if _LETTER.match(bytes([c])) or 48 <= c <= 57 else ord(" ") if c in b" \t\n\x0b\f\r" else
    ord("M") if c in b".," else ord("X") if 0x1C <= c <= 0x1F or c in (0x85, 0xA0) else ord("P")
    for c in range(256))
#: Words whose ids a worker keeps, and words encoded in one call.
CACHE_WORDS = 800_000
CALL_WORDS = 1000

_encoders: dict[str, WordEncoder] = {}      # one per worker process


class WordEncoder:
    """Ids of whole texts from ids of their words. The tokenizer cuts at every
    whitespace and merges within words only, so a text's ids are its words' ids
    in order; words repeat, so most are encoded once per worker. Texts with
    unusual whitespace are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.ids: dict[str | bytes, bytes] = {}

    def learn(self, missing: list[str] | list[bytes]) -> None:
        """Keep the ids of new words; bytes are Latin-1."""
        if len(self.ids) + len(missing) > CACHE_WORDS:
            self.ids.clear()
        for k in range(0, len(missing), CALL_WORDS):
            some = missing[k:k + CALL_WORDS]
            line = " ".join(some) if isinstance(some[0], str) else b" ".join(some).decode("latin-1")
            e = self.tok.encode(line, add_special_tokens=False)
            ids = np.asarray(e.ids, np.uint32)
            begins = np.fromiter((a for a, _ in e.offsets), np.int64, len(ids))
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
            cut = np.searchsorted(begins, ends[:-1])
            at = [0, *cut.tolist(), len(ids)]
            raw = ids.astype("<u4").tobytes()
            for w, a, b in zip(some, at, at[1:]):
                self.ids[w] = raw[4 * a:4 * b]

    def words(self, text: str) -> list[str] | list[bytes] | None:
        """A text's words, or None if white space in it is unusual. In Latin-1
        texts case is folded as the tokenizer does it (its special tokens, which
        start with <|, depend on case), and marks that stand alone, each a word
        of its own, are cut off: fewer different words are left to learn."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None if _ODD_SPACE.search(text) else text.split()
        kind = raw.translate(_KIND)
        if b"X" in kind:
            return None
        if b"<|" in raw:
            return raw.split()
        raw = raw.translate(_LOWER)
        if not (b"MM" in kind or b"MP" in kind or b"PM" in kind):
            raw = raw.replace(b".", b" . ").replace(b",", b" , ")
        return raw.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self.words(t) for t in texts]
        known = self.ids
        need = set().union(*[ws for ws in split if ws]).difference(known)
        if len(known) + len(need) > CACHE_WORDS:
            known.clear()
            need = set().union(*[ws for ws in split if ws])
        for kind in (str, bytes):
            self.learn(sorted(w for w in need if isinstance(w, kind)))
        whole = lambda t: np.asarray(self.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        return [whole(t) if ws is None else b"".join(map(known.__getitem__, ws)) for t, ws in zip(texts, split)]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


PIECES = "piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id",
           text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           position: Column | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, and its
    document's ``position`` if that is given. ``tokenizer`` is a file that every
    worker has (None: the public one installed there)."""
    more = [] if position is None else ["position"]
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                      *[position.cast("double").alias(c) for c in more])
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer or tokenizer_path())
        for b in batches:
            if not b.num_rows:
                continue
            step = 500
            for k in range(0, b.num_rows, step):
                part = b.slice(k, step)
                texts = [t or "" for t in part.column(1).to_pylist()]
                doc, piece, start, length, crc = [], [], [], [], []
                for i, raw in enumerate(enc.encode(texts)):
                    raw += end
                    for p, a in enumerate(range(0, len(raw), 4 * capacity)):
                        ids = raw[a:a + 4 * capacity]
                        doc.append(i)
                        piece.append(p)
                        start.append(a // 4)
                        length.append(len(ids) // 4)
                        crc.append(zlib.crc32(ids))
                own = pa.array(doc, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64()), *[part.column(2).take(own) for _ in more]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", *more])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, {PIECES}{', position double' if more else ''}")


def groups_of(lengths: np.ndarray, counts: np.ndarray, groups: int) -> list[tuple[int, int]]:
    """(size, how many) of each group: the items in descending order, cut into
    groups of equal cardinality; the size is the longest of the group."""
    order = np.argsort(-lengths)
    ln, ct = lengths[order], counts[order]
    n = int(ct.sum())
    if not n:
        return []
    per = -(-n // groups)
    upto = np.cumsum(ct)
    heads = np.arange(0, n, per)
    size = ln[np.searchsorted(upto, heads, side="right")]
    many = np.minimum(per, n - heads)
    out: list[tuple[int, int]] = []
    for s, m in zip(size.tolist(), many.tolist()):     # groups of one size are one
        if out and out[-1][0] == s:
            out[-1] = (s, out[-1][1] + m)
        else:
            out.append((s, m))
    return out


def configuration(sizes: list[int], left: list[int], first: int, capacity: int) -> list[int]:
    """The sizes (indexes) of one sequence: the largest size left, and of the
    others those that fill the room best, no size more often than it is left
    (a knapsack over the room, whose value is the tokens filled)."""
    room = capacity - sizes[first]
    # reach[r]: whether r tokens can be filled; last[r]: the size that got there.
    last = np.full(room + 1, -1, np.int32)
    used = np.zeros(room + 1, np.int32)
    done = np.zeros(room + 1, bool)
    done[0] = True
    for j in range(first, len(sizes)):
        s, cap = sizes[j], left[j] - (j == first)
        if cap <= 0 or s > room:
            continue
        used[:] = 0
        for _ in range(min(cap, room // s)):
            new = np.zeros_like(done)
            new[s:] = done[:-s]
            new &= ~done
            if not new.any():
                break
            at = np.flatnonzero(new)
            ok = used[at - s] < cap
            at = at[ok]
            done[at] = True
            last[at] = j
            used[at] = used[at - s] + 1
        if done[room]:
            break
    r = int(np.flatnonzero(done)[-1])
    chosen = [first]
    while r:
        chosen.append(int(last[r]))
        r -= sizes[last[r]]
    return chosen


def configurations(sized: list[tuple[int, int]], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations (indexes of sizes) and how often each is used, until every
    size is used up."""
    sizes, left = [s for s, _ in sized], [m for _, m in sized]
    out = []
    for first in range(len(sizes)):
        while left[first] > 0:
            chosen = configuration(sizes, left, first, capacity)
            need = np.bincount(chosen, minlength=len(sizes))
            times = min(left[j] // need[j] for j in set(chosen))
            for j in set(chosen):
                left[j] -= int(need[j]) * times
            out.append((chosen, int(times)))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
         small: int = SMALL) -> np.ndarray:
    """Where the pieces go: rows (length, from rank, to rank, sequence of the
    first rank, offset), the rank being that among pieces of the length; piece
    ``rank`` is in sequence + rank - from."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    if not len(lengths):
        return np.empty((0, 5), np.int64)
    large = lengths > capacity // small
    sized = groups_of(lengths[large], counts[large], groups)
    # Ranks over the large items in descending order: runs of equal lengths.
    desc = np.argsort(-lengths[large])
    run_len = lengths[large][desc]
    run_end = np.cumsum(counts[large][desc])
    run_start = run_end - counts[large][desc]
    group_at = np.cumsum([0] + [m for _, m in sized])
    taken = [0] * len(sized)
    rows: list[tuple[int, int, int, int, int]] = []
    classes: list[tuple[int, int, int]] = []          # room left, first sequence, how many
    sequence = 0
    for chosen, times in configurations(sized, capacity):
        # Slot k of the configuration takes the ranks from[k] to from[k] + times.
        slots = []
        for j in chosen:
            slots.append(int(group_at[j] + taken[j]))
            taken[j] += times
        cuts = {0, times}
        for a in slots:
            inside = run_end[(run_end > a) & (run_end < a + times)]
            cuts.update((inside - a).tolist())
        cuts = sorted(cuts)
        for lo, hi in zip(cuts, cuts[1:]):
            offset = 0
            for a in slots:
                r = int(np.searchsorted(run_end, a + lo, side="right"))
                at = a + lo - int(run_start[r])
                rows.append((int(run_len[r]), at, at + hi - lo, sequence + lo, offset))
                offset += int(run_len[r])
            classes.append((capacity - offset, sequence + lo, hi - lo))
        sequence += times
    # Best fit: the sequences with the least room that is enough.
    rooms = sorted(classes)
    for length, count in zip(lengths[~large][::-1].tolist(), counts[~large][::-1].tolist()):
        rank = 0
        while rank < count:
            i = bisect_left(rooms, (length, -1, -1))
            if i == len(rooms):                       # open as many as the rest needs
                per = capacity // length
                many = -(-(count - rank) // per)
                insort(rooms, (capacity, sequence, many))
                sequence += many
                i = bisect_left(rooms, (length, -1, -1))
            room, first, many = rooms.pop(i)
            n = min(many, count - rank)
            rows.append((length, rank, rank + n, first, capacity - room))
            insort(rooms, (room - length, first, n))
            if n < many:
                insort(rooms, (room, first + n, many - n))
            rank += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(table: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """The pieces with sequence_id and offset. Of equal lengths the pieces of
    earlier ``position`` (if there is one) come first, and sequences are numbered
    by the mean position of their pieces."""
    spark = table.sparkSession
    histogram = {int(r[0]): int(r[1]) for r in table.groupBy("length").count().collect()}
    plan_rows = spark.sparkContext.broadcast(plan(histogram, capacity, groups))
    timed = ["position"] if "position" in table.columns else []
    ranked = dense_position(table, ["length"], [*timed, "doc_id", "piece", "ids_crc32"], "_pk_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan_rows.value
        # (length, rank) as one sorted key
        key = rows[:, 0].astype(np.float64) * 2.0 ** 40 + rows[:, 1]
        for b in batches:
            ln = b.column("length").to_numpy()
            rank = b.column("_pk_rank").to_numpy()
            i = np.searchsorted(key, ln.astype(np.float64) * 2.0 ** 40 + rank, side="right") - 1
            seq = rows[i, 3] + rank - rows[i, 1]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(seq), pa.array(rows[i, 4])],
                names=[*keep, "sequence_id", "offset"])

    keep = table.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    placed = ranked.select(*keep, "_pk_rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")
    if not timed:
        return placed
    placed = stored(placed)
    means = placed.groupBy("sequence_id").agg(F.avg("position").alias("_pk_mean"))
    numbers = dense_position(means, [], ["_pk_mean", "sequence_id"], "_pk_new")
    return placed.join(numbers, "sequence_id").select(*[
        F.col("_pk_new").alias(c) if c == "sequence_id" else F.col(c) for c in placed.columns])


def packed(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id",
           text: str = "text", capacity: int = CAPACITY, groups: int = GROUPS,
           end_id: int = END_ID, position: Column | None = None) -> DataFrame:
    """Every piece with its sequence_id and offset; texts are tokenised once.
    With ``position`` (a number that ascends in training order) sequences are
    numbered in that order."""
    return place(stored(pieces(docs, tokenizer, doc_id, text, capacity, end_id, position)), capacity, groups)
