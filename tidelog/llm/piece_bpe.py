"""SentencePiece BPE encoding and decoding in vectorised merge rounds (operator 12).

A text gets a space before it, every space is the mark U+2581, and the symbols
are its characters. As long as two neighbours make a piece together, the pair of
the best score is merged, leftmost first. Neighbouring characters that are not
neighbours in any piece never come together, so a text is cut there into words
(in most texts at white space), which are merged independently.

The words of many texts are one flat array of symbols. In each round

1. every pair's rank is looked up in the sorted table of pairs that make a piece;
2. a segmented minimum gives each word's best rank;
3. its occurrences are merged at once, leftmost first where they overlap;
4. the array is compacted; words without a pair left are done.

Some pieces have a better-ranked (or equal) piece that continues them: after one
such merge the library would go on there before it comes to the next
occurrence, so of these only the leftmost of a word is merged in a round. Words
of more than ``LONG`` symbols are merged through a heap of their pairs, in the
same order, so that a run of a million spaces doesn't take a million rounds.

Symbols that are no piece are written as the pieces of their UTF-8 bytes. Ids of
words are kept per worker process up to ``CACHE_WORDS`` words.

Decoding joins the pieces' bytes, byte pieces as they are, marks as spaces, and
takes away the space put before the text; bytes that are not UTF-8 become U+FFFD
each. Control ids are nothing, the unknown id is " ⁇ ".

Only models of this kind are taken (BPE with byte pieces, identity
normalisation): others raise. Defined cases: a null or empty text has the end id
alone and decodes to the empty text; texts of any length are whole; repeated
rows and null ids are kept; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"
LONG = 1 << 12
CACHE_WORDS = 800_000
#: Symbols merged in one flat array; texts handled together.
FLAT = 1 << 18
TEXTS = 256
NONE = np.int32(1 << 30)
#: Marks where a text is cut; one that has it already is cut another way.
CUT = "\ue000"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceModel:
    """The vocabulary of a model, as arrays. Symbols below ``size`` are pieces;
    characters that occur in pieces but are none come after them, and then, for
    one call, other characters."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = sp.get_piece_size()
        self.end_id = sp.eos_id()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = np.full(256, -1, np.int64)
        normal = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        probe = f"  a {MARK} Ω "
        if (self.byte_id < 0).any() or sp.decode(sp.encode(probe)) != probe.replace(MARK, " "):
            raise ValueError(f"not a byte-fallback model with identity normalisation: {path}")
        # Ranks: 0 is the best score; equal scores have equal ranks.
        score = np.array([-sp.get_score(i) for i in normal])
        rank = dict(zip(normal, np.unique(score, return_inverse=True)[1].tolist()))
        self.symbol = {pieces[i]: i for i in normal}
        self.pieces = pieces + sorted({c for i in normal for c in pieces[i]} - set(self.symbol))
        self.chars = {p: i for i, p in enumerate(self.pieces) if len(p) == 1 and (i >= n or i in rank)}
        width = self.width = len(self.pieces)
        # Every way to make a piece of two symbols, and where characters meet.
        pairs, careful, meet = [], np.zeros(n, bool), set()
        for i in normal:
            p = pieces[i]
            meet.update(zip(p, p[1:]))
            for k in range(1, len(p)):
                a, b = (self.symbol.get(x, self.chars.get(x)) for x in (p[:k], p[k:]))
                if a is None or b is None:
                    continue
                pairs.append((a * width + b, rank[i], i))
                for x in (a, b):
                    if x < n and len(pieces[x]) > 1 and rank[x] >= rank[i]:
                        careful[x] = True
        pairs.sort()
        self.keys = np.array([k for k, _, _ in pairs], np.int64)
        self.ranks = np.array([r for _, r, _ in pairs], np.int32)
        self.made = np.array([m for _, _, m in pairs], np.int64)
        self.careful = careful
        self.pair_of: dict[int, tuple[int, int]] | None = None      # for long words
        meets = "|".join(f"{re.escape(a)}(?=[{''.join(map(re.escape, sorted(b)))}])" for a, b in self._followers(meet))
        # A word: characters each of which meets the next one, and the last.
        self.word = re.compile(f"(?:{meets})*.", re.DOTALL)
        self.spaced = not any((b == MARK and a != MARK) or "\n" in (a, b) for a, b in meet)
        self._tables(sp, pieces)
        self.known: dict[str, tuple[bytes, int, str]] = {}

    @staticmethod
    def _followers(meet: set[tuple[str, str]]) -> list[tuple[str, set[str]]]:
        by: dict[str, set[str]] = {}
        for a, b in meet:
            by.setdefault(a, set()).add(b)
        return sorted(by.items())

    def _tables(self, sp, pieces: list[str]) -> None:
        """What each id is when decoded, and its decimal digits."""
        self.out = []
        self.kind = np.zeros(len(pieces), np.int8)          # 1: byte piece, 2: nothing
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.kind[i] = 1
                self.out.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i):
                self.kind[i] = 2
                self.out.append(b"")
            elif sp.is_unknown(i):
                self.out.append(" ⁇ ".encode())
            else:
                self.out.append(p.replace(MARK, " ").encode())
        self.decimal = [str(i) for i in range(len(pieces))]
        self.text_of = ["" if k == 1 else o.decode() for k, o in zip(self.kind.tolist(), self.out)]

    # --- merging ---------------------------------------------------------------

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that a and b make (``NONE`` if none), and its id."""
        inside = (a < self.width) & (b < self.width)
        key = np.where(inside, a * self.width + b, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    def merge_rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left, and their words; ``word`` numbers each symbol's word
        and ascends."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank, made = self.lookup(symbols[:-1], symbols[1:])
            rank[word[:-1] != word[1:]] = NONE
            rank = np.append(rank, NONE)
            made = np.append(made, 0)
            begins = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, begins)
            many = np.diff(np.append(begins, len(word)))
            live = best < NONE
            if not live.all():                                  # finished words leave
                over = np.repeat(~live, many)
                done.append((word[over], symbols[over]))
                keep = ~over
                symbols, word, rank, made = symbols[keep], word[keep], rank[keep], made[keep]
                best, many = best[live], many[live]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, many))
            # Occurrences that overlap are next to each other: every other one.
            new = np.concatenate(([True], np.diff(hit) > 1))
            nth = np.arange(len(hit)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            hit = hit[nth % 2 == 0]
            # A word with a careful piece among them merges its leftmost one only.
            first = np.concatenate(([True], word[hit][1:] != word[hit][:-1]))
            lead = np.flatnonzero(first)
            guarded = np.logical_or.reduceat(self.careful[made[hit]], lead)
            hit = hit[first | ~np.repeat(guarded, np.diff(np.append(lead, len(hit))))]
            symbols[hit] = made[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done:
            return symbols, word
        at = np.concatenate([w for w, _ in done])
        order = np.argsort(at, kind="stable")
        return np.concatenate([s for _, s in done])[order], at[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges for one long word, by a heap of (rank, place)."""
        sym = symbols.tolist()
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        rank, _ = self.lookup(symbols[:-1], symbols[1:])
        heap = [(int(r), i, sym[i], sym[i + 1]) for i, r in enumerate(rank.tolist()) if r < NONE]
        heapq.heapify(heap)
        if self.pair_of is None:
            self.pair_of = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        table = self.pair_of

        def push(i: int, j: int) -> None:
            if i >= 0 and j < len(sym) and sym[i] < self.width and sym[j] < self.width:
                found = table.get(sym[i] * self.width + sym[j])
                if found:
                    heapq.heappush(heap, (found[0], i, sym[i], sym[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            sym[i] = table[a * self.width + b][1]
            sym[j] = -1
            after[i] = after[j]
            if after[j] < len(sym):
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return np.array([s for s in sym if s >= 0], np.int64)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's begin."""
        flat = "".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        distinct = np.unique(code)
        name = self.pieces + [c for c in map(chr, distinct.tolist()) if c not in self.chars]
        number = self.chars | {c: self.width + k for k, c in enumerate(name[self.width:])}
        symbols = np.array([number[chr(c)] for c in distinct.tolist()], np.int64)[np.searchsorted(distinct, code)]
        word = np.repeat(np.arange(len(words)), sizes)
        out, of = [], []
        # Words of up to FLAT symbols together; a longer one than LONG alone.
        at = np.concatenate(([0], np.cumsum(sizes)))
        lo = 0
        while lo < len(words):
            if sizes[lo] > LONG:
                out.append(self.merge_long(symbols[at[lo]:at[lo + 1]]))
                of.append(np.full(len(out[-1]), lo))
                lo += 1
                continue
            hi = int(np.searchsorted(at, at[lo] + FLAT, side="right")) - 1
            long = np.flatnonzero(sizes[lo:hi] > LONG)
            hi = lo + int(long[0]) if len(long) else hi
            s, w = self.merge_rounds(symbols[at[lo]:at[hi]], word[at[lo]:at[hi]])
            out.append(s)
            of.append(w)
            lo = hi
        ids = np.concatenate(out) if out else symbols
        of = np.concatenate(of) if of else word
        # Symbols that are no piece: the pieces of their UTF-8 bytes.
        alien = np.flatnonzero(ids >= self.size)
        if len(alien):
            raw = [self.byte_id[np.frombuffer(name[s].encode(), np.uint8)] for s in ids[alien].tolist()]
            many = np.ones(len(ids), np.int64)
            many[alien] = list(map(len, raw))
            own = np.repeat(np.isin(np.arange(len(ids)), alien), many)
            ids, of = np.repeat(ids, many), np.repeat(of, many)
            ids[own] = np.concatenate(raw)
        return ids, np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(words)))))

    # --- whole texts -------------------------------------------------------------

    def words_of(self, text: str) -> list[str]:
        """A text's words: cut before marks, if no piece has a mark after another
        character (a run of marks belongs to the word after it), and around line
        ends, if no piece has one. ``parts`` cuts them further."""
        marked = MARK + text.replace(" ", MARK)
        if not self.spaced:
            return [marked]
        if MARK * 2 in marked or CUT in marked:
            return _RUNS.findall(marked)
        words = marked.replace(MARK, CUT + MARK).replace("\n", f"{CUT}\n{CUT}").split(CUT)
        return [w for w in words if w]

    def learn(self, words: list[str]) -> None:
        """Keep decimal ids, how many, and the decoded text of new words."""
        parts = [self.word.findall(w) for w in words]
        once = list(dict.fromkeys(p for ps in parts for p in ps))
        ids, at = self.merged(once)
        digits = [self.decimal[i] for i in ids.tolist()]
        texts = [self.text_of[i] for i in ids.tolist()]
        raw = np.concatenate(([0], np.cumsum(self.kind[ids] != 0)))[at]
        kept, at = {}, at.tolist()
        for p, a, b, n in zip(once, at, at[1:], np.diff(raw).tolist()):
            kept[p] = (" ".join(digits[a:b]), b - a,
                       self._text(ids[a:b].tolist()) if n else "".join(texts[a:b]))
        for w, ps in zip(words, parts):
            if len(ps) == 1:
                self.known[w] = kept[ps[0]]
            else:
                own = [kept[p] for p in ps]
                self.known[w] = (" ".join([d for d, _, _ in own]), sum(n for _, n, _ in own),
                                 "".join([t for _, _, t in own]))

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without an end id."""
        if not text:
            return []
        parts = [p for w in self.words_of(text) for p in self.word.findall(w)]
        return self.merged(parts)[0].tolist()

    def encoded(self, texts: list[str]) -> list[list[tuple[str, int, str]]]:
        """What is kept of each text's words, in order."""
        split = [self.words_of(t) if t else [] for t in texts]
        known = self.known
        need = {w for ws in split for w in ws if w not in known}
        if len(known) + len(need) > CACHE_WORDS:
            known.clear()
            need = {w for ws in split for w in ws}
        if need:
            self.learn(sorted(need))
        out = [[known[w] for w in ws] for ws in split]
        if len(known) > CACHE_WORDS:
            known.clear()
        return out

    def _text(self, ids: list[int]) -> str:
        """The text of ids with the leading space still there."""
        raw, run, parts = b"", False, []
        for i in ids:
            if (self.kind[i] == 1) != run:
                parts.append((raw, run))
                raw, run = b"", not run
            raw += self.out[i]
        parts.append((raw, run))
        return "".join(_bytes_text(r) if run else r.decode() for r, run in parts)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space put before the text is taken away."""
        ids = [i for i in ids if self.kind[i] != 2]
        text = self._text(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(MARK) else text


_RUNS = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


def _bytes_text(raw: bytes) -> str:
    """UTF-8 text of a run of byte pieces; each byte that isn't part of a
    character is U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, k = [], 0
    while k < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[k:k + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        k += n
    return "".join(out)


_models: dict[str, PieceModel] = {}         # one per worker process


def model(path: str | None = None) -> PieceModel:
    path = path or model_path()
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encoded(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (with the end id) and the decoded text of every text.
    ``path`` is a model file that every worker has (None: the public one)."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            for k in range(0, b.num_rows, TEXTS):
                part = b.slice(k, TEXTS)
                ids, texts = [], []
                for t in part.column(1).to_pylist():
                    own = [*m.encode(t or ""), m.end_id]
                    ids.append(own)
                    texts.append(m.decode(own))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space) and
    decoded_sha256 of every text, without moving ids or texts."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            for k in range(0, b.num_rows, TEXTS):
                part = b.slice(k, TEXTS)
                n, ids, texts = [], [], []
                for words in m.encoded([t or "" for t in part.column(1).to_pylist()]):
                    digits, many, decoded = zip(*words) if words else ((), (), ())
                    n.append(sum(many) + 1)
                    ids.append(sha(" ".join([*digits, str(m.end_id)])))
                    texts.append(sha("".join(decoded)[1:]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
