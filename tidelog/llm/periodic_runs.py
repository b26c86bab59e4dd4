"""Periodic runs of words by block convolution (operator 13).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least max(12, 2q) words that no neighbouring word extends.

At each dyadic scale B the text is cut into blocks of B words. A run of period q
in [2B - 1, 4B - 2] holds a whole block in its first words, and that block again
q words later. So the sum of squared differences of word numbers between the
block and each place of the window that follows it, as far as those distances,
is 0 at every such q; it is a correlation, taken for many blocks at once by an
exact number-theoretic transform modulo a prime. The distances found seed the
runs: each is extended to both sides as far as words q apart are identical.
Scales from B = 2 (periods 1 to 6, whose runs have 12 words at least) double
until 2(2B - 1) is longer than the text.

Blocks with a word that doesn't occur again at any of the scale's distances
can't match and aren't transformed; in text without repetition few are left.
Sums are exact modulo the prime; a sum that is a multiple of it, but not 0, only
gives a seed that extension drops. Extension compares hashes of stretches by
binary search, and a run's words are compared one by one at the end; a run that
then fails is extended word by word instead, so hashes never decide. Of runs
over the same stretch the smallest period is the period (a multiple of it is
found there too).

Tasks work on single texts, whole: many short texts in one array, whose numbers
and blocks are each text's own. Memory follows the longest text of a task.

Defined cases: a null or empty text has no words, no runs, and the empty text as
its collapsed text; with a null id a text isn't made periodic; repeated rows are
judged each; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: Prime of the transform, 119 * 2^23 + 1 with the primitive root 3: products
#: of two residues fit 64 bits.
PRIME, ROOT = 998244353, 3
#: Modulus and base of the stretch hashes.
HASH_PRIME, HASH_BASE = (1 << 31) - 1, 1_000_003
#: Numbers transformed at once, and words of texts that are handled together.
CELLS = 1 << 20
WORDS = 1 << 17
#: Words of a block that are looked for at most, and distances at once: together
#: they must fit a transform of 2^23 numbers, the most that the prime has.
LONGEST, SPAN = 1 << 20, 1 << 21
#: Words of a block that are asked whether they come again.
ASKED = 256


def planted(n: int, h: int) -> tuple[int, int] | None:
    """(a, p): from word a on, the words repeat with period p; None if not."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


# --- the transform ------------------------------------------------------------------

_powers: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(size: int, inverse: bool) -> np.ndarray:
    """The first size / 2 powers of a root of unity of order ``size``."""
    if (size, inverse) not in _powers:
        w = pow(ROOT, (PRIME - 1) // size, PRIME)
        w = pow(w, PRIME - 2, PRIME) if inverse else w
        out = np.ones(1, np.uint64)
        while len(out) < size // 2:                 # double: w^len times the first ones
            step = np.uint64(pow(w, len(out), PRIME))
            out = np.concatenate((out, out * step % np.uint64(PRIME)))
        _powers[size, inverse] = out[:max(size // 2, 1)]
    return _powers[size, inverse]


def ntt(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The transform of each row (a power of two long, residues as uint64)."""
    p = np.uint64(PRIME)
    rows, size = x.shape
    y = x.reshape(rows, size, 1)
    # Decimation in time without bit reversal: halves become interleaved.
    while y.shape[1] > 1:
        half, width = y.shape[1] // 2, y.shape[2]
        w = _twiddles(2 * width, inverse)[:width]
        a, b = y[:, :half], y[:, half:] * w % p
        low, high = a + b, a + (p - b)
        y = np.concatenate((np.where(low >= p, low - p, low), np.where(high >= p, high - p, high)), 2)
    y = y.reshape(rows, size)
    if inverse:
        y = y * np.uint64(pow(size, PRIME - 2, PRIME)) % p
    return y


def zero_distances(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int,
                   nearest: int, farthest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in starts, distance) of every distance in [nearest, farthest] at
    which the block from starts[i] occurs again before ends[i]. ``x`` holds the
    word numbers, from 1."""
    p = np.uint64(PRIME)
    found_i, found_d = [], []
    span = farthest - nearest + block               # words a window looks at
    size = 1 << (span - 1).bit_length()
    for k in range(0, len(starts), max(1, CELLS // size)):
        s, e = starts[k:k + max(1, CELLS // size)], ends[k:k + max(1, CELLS // size)]
        blocks = np.zeros((len(s), size), np.uint64)
        # Reversed, so that the product of the transforms is the correlation.
        blocks[:, :block] = x[s[:, None] + np.arange(block)[::-1]]
        at = s[:, None] + nearest + np.arange(span)
        inside = at < e[:, None]
        windows = np.zeros((len(s), size), np.uint64)
        windows[:, :span] = np.where(inside, x[np.minimum(at, len(x) - 1)], 0)
        both = ntt(ntt(blocks) * ntt(windows) % p, inverse=True)
        products = both[:, block - 1:span]
        squares = np.cumsum(windows[:, :span] ** np.uint64(2) % p, axis=1)
        squares = np.concatenate((np.zeros((len(s), 1), np.uint64), squares), 1)
        of_window = (squares[:, block:] - squares[:, :-block]) % p
        of_block = (blocks ** np.uint64(2) % p).sum(1) % p
        i, d = np.nonzero((of_block[:, None] + of_window) % p == np.uint64(2) * products % p)
        ok = s[i] + nearest + d + block <= e[i]
        found_i.append(k + i[ok])
        found_d.append(nearest + d[ok])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_d)


# --- runs of many texts ----------------------------------------------------------------

class Texts:
    """The words of some texts as one array of numbers from 1; text t has the
    words begin[t] to begin[t + 1]."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray):
        self.x = numbers.astype(np.uint64)
        self.begin = np.concatenate(([0], np.cumsum(sizes)))
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        # Each text's words by number, then place: where a word comes again.
        key = self.text * np.int64(int(numbers.max(initial=0)) + 1) + numbers
        self.by = np.argsort(key, kind="stable")
        self.width = len(numbers) + 1
        self.rank = np.cumsum(np.concatenate(([0], np.diff(key[self.by]) != 0)))[:len(numbers)] if len(numbers) else key
        # A last place beyond all others.
        self.places = np.append(self.rank * self.width + self.by, np.iinfo(np.int64).max)
        own = np.empty(len(numbers), np.int64)
        own[self.by] = self.rank
        self.key = own
        self._hash: tuple[np.ndarray, np.ndarray] | None = None

    def comes_again(self, at: np.ndarray, nearest: int, farthest: int) -> np.ndarray:
        """Whether the word of each place occurs in its text at a distance in
        [nearest, farthest]."""
        base = self.key[at] * self.width
        i = np.searchsorted(self.places, base + np.minimum(at + nearest, self.width - 1))
        return self.places[i] <= base + np.minimum(at + farthest, self.width - 1)

    def blocks(self, size: int, nearest: int, farthest: int) -> np.ndarray:
        """Starts of the aligned blocks, each of whose (first) words comes again."""
        many = np.diff(self.begin) // size
        text = np.repeat(np.arange(len(many)), many)
        s = self.begin[text] + (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * size
        s = s[s + nearest + size <= self.begin[text + 1]]
        for k in range(min(size, ASKED)):
            if not len(s):
                break
            s = s[self.comes_again(s + k, nearest, farthest)]
        return s

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix hashes of all words, and powers of the base."""
        if self._hash is None:
            p = np.uint64(HASH_PRIME)
            n = len(self.x)
            power = np.ones(1, np.uint64)
            while len(power) <= n:
                step = np.uint64(pow(HASH_BASE, len(power), HASH_PRIME))
                power = np.concatenate((power, power * step % p))
            power = power[:n + 1]
            # Sum of (number mixed) * base^place: compared after shifting.
            mixed = (self.x * np.uint64(2654435761) + np.uint64(97)) % p
            terms = mixed * power[:n] % p
            prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms % p)))
            self._hash = prefix % p, power
        return self._hash

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the stretches of n words from a and from b > a hash alike."""
        p = np.uint64(HASH_PRIME)
        prefix, power = self.hashes()
        of_a = (prefix[a + n] + p - prefix[a]) % p * power[b - a] % p
        return of_a == (prefix[b + n] + p - prefix[b]) % p

    def extended(self, s: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretch [from, to) of places i around s with word i equal to word
        i + q; s itself is one of them."""
        lo, hi = self.begin[self.text[s]], self.begin[self.text[s] + 1] - q
        # Right: the most n with words s .. s + n equal to those q later.
        known, most = np.ones(len(s), np.int64), hi - s
        while (open_ := known < most).any():
            mid = np.where(open_, (known + most + 1) // 2, known)
            ok = self.same(s, s + q, mid)
            known, most = np.where(ok, mid, known), np.where(ok, most, mid - 1)
        to = s + known
        known, most = np.zeros(len(s), np.int64), s - lo
        while (open_ := known < most).any():
            mid = np.where(open_, (known + most + 1) // 2, known)
            ok = self.same(s - mid, s - mid + q, mid)
            known, most = np.where(ok, mid, known), np.where(ok, most, mid - 1)
        return s - known, to

    def plainly(self, s: int, q: int) -> tuple[int, int]:
        """``extended`` for one seed, word by word."""
        lo, hi = int(self.begin[self.text[s]]), int(self.begin[self.text[s] + 1]) - q
        x = self.x
        a = b = s
        while b < hi and x[b] == x[b + q]:
            b += 1
        while a > lo and x[a - 1] == x[a - 1 + q]:
            a -= 1
        return a, b

    def runs(self) -> np.ndarray:
        """Rows (text, start, length, period) of every run, in that order."""
        found = [np.empty((0, 3), np.int64)]
        longest = int(np.diff(self.begin).max(initial=0))
        # A run already found around a place: its end and period. Inside it a
        # block as long as the period comes again at multiples of it only.
        inside_to, inside_q = np.zeros((2, len(self.x)), np.int64)
        block = 2
        while block == 2 or 2 * (2 * block - 1) <= longest:
            nearest, farthest = (1 if block == 2 else 2 * block - 1), 4 * block - 2
            part = min(block, LONGEST)
            all_s = self.blocks(block, nearest, farthest)
            all_s = all_s[(inside_to[all_s] < all_s + farthest + part) | (inside_q[all_s] > part)]
            rows = []
            for near in range(nearest, farthest + 1, SPAN):
                i, q = zero_distances(self.x, all_s, self.begin[self.text[all_s] + 1], part, near,
                                      min(farthest, near + SPAN - 1))
                s = all_s[i]
                known = (s + q + part <= inside_to[s]) & (q > inside_q[s]) & (q % np.maximum(inside_q[s], 1) == 0)
                rows.append(self._grown(s[~known], q[~known], block if part == block else None))
            new = np.concatenate(rows)
            for a, b, d in new[np.argsort(new[:, 2])[::-1]].tolist():
                inside_to[a:b], inside_q[a:b] = b, d
            found.append(new)
            block *= 2
        out = np.unique(np.concatenate(found), axis=0)
        # Of one stretch the smallest period (rows are sorted by it last).
        first = np.ones(len(out), bool)
        first[1:] = (out[1:, :2] != out[:-1, :2]).any(1)
        a, b, q = out[first].T
        t = self.text[a] if len(a) else a
        return np.stack((t, a - self.begin[t], b - a, q), 1)

    def _grown(self, s: np.ndarray, q: np.ndarray, block: int | None) -> np.ndarray:
        """Rows (from, to, period) of the runs that seeds belong to; ``block`` is
        the blocks' length, if they match as a whole."""
        if not len(s):
            return np.empty((0, 3), np.int64)
        # A chain of whole blocks at one distance is one stretch: its first is enough.
        by = np.lexsort((s, q))
        s, q = s[by], q[by]
        head = np.ones(len(s), bool)
        head[1:] = (q[1:] != q[:-1]) | (s[1:] - s[:-1] != block) | (self.text[s[1:]] != self.text[s[:-1]])
        s, q = s[head], q[head]
        equal = self.x[s] == self.x[s + q]
        s, q = s[equal], q[equal]
        a, b = self.extended(s, q)
        ok = b - a + q >= np.maximum(MIN_LENGTH, 2 * q)
        s = s[ok]
        rows, of = np.unique(np.stack((a[ok], b[ok] + q[ok], q[ok]), 1), axis=0, return_inverse=True)
        kept = []
        for k, (lo, hi, d) in enumerate(rows.tolist()):
            # Word by word: hashes may only have said too much.
            if np.array_equal(self.x[lo:hi - d], self.x[lo + d:hi]):
                kept.append((lo, hi, d))
                continue
            for seed in s[of.ravel() == k].tolist():
                lo, hi = self.plainly(seed, d)
                if hi + d - lo >= max(MIN_LENGTH, 2 * d):
                    kept.append((lo, hi + d, d))
        return np.array(kept, np.int64).reshape(-1, 3)

    def repeats(self, runs: np.ndarray) -> np.ndarray:
        """For each word, whether a run holds it after the run's first period."""
        change = np.zeros(len(self.x) + 1, np.int64)
        if len(runs):
            a = self.begin[runs[:, 0]] + runs[:, 1]
            np.add.at(change, a + runs[:, 3], 1)
            np.add.at(change, a + runs[:, 2], -1)
        return np.cumsum(change)[:-1] > 0


def numbered(words: list[list[bytes]]) -> Texts:
    """The texts' words as numbers: equal words of a text are equal numbers."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.array([w for ws in words for w in ws], object)
    numbers = pd.factorize(flat)[0] if len(flat) else np.empty(0, np.int64)
    return Texts(numbers.astype(np.int64) + 1, sizes)


def made_periodic(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words, periodic from a place on if the id's crc32 says so."""
    at = None if doc_id is None else planted(len(words), zlib.crc32(str(doc_id).encode()))
    if at is None:
        return words
    a, p = at
    cycle = words[a:a + p]
    return words[:a] + (cycle * -(-(len(words) - a) // p))[:len(words) - a]


OUT = ("n_runs long, start long, length long, period long, exponent_milli long, "
       "runs_sha256 string, collapsed_sha256 string")


def runs_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """doc_id and runs (start, length, period) of every text, by start and
    period, and its words after dropping repeats, joined by a space. With
    ``plant`` texts are made periodic first as their ids' crc32 says."""
    def rows(ids: list, lists: list[list[bytes]]) -> pa.RecordBatch:
        texts = numbered(lists)
        runs = texts.runs()
        drop = texts.repeats(runs)
        cuts = np.searchsorted(runs[:, 0], np.arange(len(lists) + 1))
        of, kept = [], []
        for t, ws in enumerate(lists):
            of.append([{"start": int(a), "length": int(n), "period": int(q)}
                       for _, a, n, q in runs[cuts[t]:cuts[t + 1]]])
            if len(of[-1]):
                gone = drop[texts.begin[t]:texts.begin[t + 1]]
                ws = [w for w, g in zip(ws, gone.tolist()) if not g]
            kept.append(b" ".join(ws).decode())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(of, kind), pa.array(kept, pa.string())], names=["doc_id", "runs", "collapsed"])

    return _by_texts(docs, doc_id, text, plant, rows,
                     "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = True) -> DataFrame:
    """doc_id, n_runs, the longest run and digests of all runs and of the
    collapsed text, without moving texts."""
    def rows(ids: list, lists: list[list[bytes]]) -> pa.RecordBatch:
        texts = numbered(lists)
        runs = texts.runs()
        drop = texts.repeats(runs)
        cuts = np.searchsorted(runs[:, 0], np.arange(len(lists) + 1))
        top: list[list[int | None]] = []
        shas: list[tuple[str, str]] = []
        for t, ws in enumerate(lists):
            own = runs[cuts[t]:cuts[t + 1], 1:]
            if len(own):
                start, length, period = own[np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]].tolist()
                top.append([len(own), start, length, period, 1000 * length // period])
                gone = drop[texts.begin[t]:texts.begin[t + 1]]
                ws = [w for w, g in zip(ws, gone.tolist()) if not g]
            else:
                top.append([0, None, None, None, None])
            listed = "".join([f"{a},{n},{q}\n" for a, n, q in own.tolist()])
            shas.append((hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(ws)).hexdigest()))
        columns = [pa.array([r[k] for r in top], pa.int64()) for k in range(5)]
        columns += [pa.array([s[k] for s in shas], pa.string()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *[
            c.split()[0] for c in OUT.split(", ")]])

    return _by_texts(docs, doc_id, text, plant, rows, OUT)


def _by_texts(docs: DataFrame, doc_id: str, text: str, plant: bool, rows, out: str) -> DataFrame:
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, held, lists = 0, 0, []
            ids = b.column(0).to_pylist() if plant else [None] * b.num_rows
            for k, t in enumerate(b.column(1).to_pylist()):
                words = (t or "").encode().split()
                lists.append(made_periodic(words, ids[k]))
                held += len(words)
                if held >= WORDS or k == b.num_rows - 1:
                    yield rows(b.column(0).slice(lo, k + 1 - lo), lists)
                    lo, held, lists = k + 1, 0, []

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {out}")
