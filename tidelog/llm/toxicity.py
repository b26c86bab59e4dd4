"""Toxicity by subword-bag embeddings and a linear softmax (operator 8).

A word is the bag of its byte n-grams (3 to 5 bytes, the word padded with a
space on both sides) and itself, hashed to ``BUCKETS`` rows of an embedding
table; its vector is their mean, so a misspelling never seen shares most of
its n-grams' vectors. Words are averaged over blocks of ``BLOCK`` words, each
block goes through a linear softmax, and a text's log-odds are the log-mean-exp
of its ``TOP`` highest blocks', so a few words count in a long text too. Embeddings and softmax
are trained together, in numpy, by AdaGrad.

The model is fitted on a sample of the labelled documents: at most
``TRAIN_EACH`` of either label (expected; chosen by the hash of the id), in one
task; the log-odds are then moved to the labels' real shares. Every document
is scored in place.

Defined cases: a null or empty text, or one without words, gets the share of
label 1 as its score. Without labels of both kinds there is nothing to learn:
every score is the share of label 1 (0 if there is no label). A null label, or
a label whose id is null, is no label; of several labels of an id any 1 counts.
Repeated rows are scored as often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod

BITS = 18
BUCKETS = 1 << BITS
DIM = 8
GRAMS = (3, 4, 5)
BLOCK = 4
TOP = 4
TRAIN_EACH = 4000
EPOCHS = 8
RATE = 2.0
SOFT_RATE = 0.1
BATCH = 64
SEED = 8
THRESHOLD = 0.3
#: Bytes scored at once; texts are gathered up to this (a longer one is alone).
BLOCK_BYTES = 1 << 20

_BYTE = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)
_MUL = np.uint32(0x9E3779B1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def grams(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, bucket) arrays, one pair for each n-gram length and one for
    the words themselves."""
    x = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    white = x == 32
    word = np.cumsum(white) - 1           # a space belongs to the word after it
    value = _BYTE[x]
    shift = np.uint32(32 - BITS)
    h = value.copy()
    inner = np.zeros(len(x), bool)        # a space after the window's first byte
    for n in range(2, max(GRAMS) + 1):
        m = len(x) - n + 1
        if m <= 0:
            break
        if n > 2:
            inner = inner[:m] | white[n - 2:n - 2 + m]
        else:
            inner = inner[:m]
        h = (h[:m] * _MUL) ^ value[n - 1:]
        if n in GRAMS:
            at = np.flatnonzero(~inner)
            yield word[at], ((h[at] * _MUL) >> shift).astype(np.int64)
    start = np.flatnonzero(white)
    if len(words):
        with np.errstate(over="ignore"):
            whole = np.add.reduceat(value.astype(np.uint64) * (np.arange(len(x), dtype=np.uint64) - np.repeat(
                start, np.diff(np.concatenate((start, [len(x)])))).astype(np.uint64) + np.uint64(7)) ** np.uint64(3),
                start)[:len(words)]
        yield np.arange(len(words)), (((whole * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64))


def block_starts(n_words: int) -> list[int]:
    """Blocks of BLOCK words; a rest of less than half a block joins the last."""
    n = max(1, (n_words + BLOCK // 2) // BLOCK)
    return [i * BLOCK for i in range(n)]


def starts_of(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the blocks of texts of so many words begin, and each block's text."""
    starts, of_doc, at = [], [], 0
    for d, n in enumerate(sizes):
        if n:
            s = block_starts(n)
            starts += [at + b for b in s]
            of_doc += [d] * len(s)
            at += n
    return np.array(starts, np.int64), np.array(of_doc, np.int64)


def pool(odds: np.ndarray, of_doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-mean-exp of each text's blocks (nan without blocks), and each block's
    share in it."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, of_doc, odds)
    e = np.exp(odds - top[of_doc])
    total = np.bincount(of_doc, weights=e, minlength=n)
    many = np.bincount(of_doc, minlength=n)
    some = many > 0
    out = np.full(n, np.nan)
    out[some] = top[some] + np.log(total[some] / many[some])
    return out, e / total[of_doc]


def best_blocks(odds: np.ndarray, of_doc: np.ndarray) -> np.ndarray:
    """The TOP blocks of each text by their log-odds, in order."""
    best = np.lexsort((-odds, of_doc))
    rank = np.arange(len(best)) - np.searchsorted(of_doc, of_doc)
    return np.sort(best[rank < TOP])


def train(texts: list[str], labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> dict:
    """Embeddings and softmax trained together. Returns what scoring needs: each
    bucket's projection on the softmax's log-odds, and the bias."""
    rng = np.random.default_rng(seed)
    vocabulary: dict[bytes, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64) for t in texts]
    pairs = list(grams(list(vocabulary)))
    owner = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, np.int64)
    bucket = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, np.int64)
    order = np.argsort(owner, kind="stable")
    bucket = bucket[order]
    n_grams = np.bincount(owner, minlength=len(vocabulary))
    gram_at = np.concatenate(([0], np.cumsum(n_grams)))

    table = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    soft = ((rng.random((DIM, 2)) - 0.5)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    sq, soft_sq, bias_sq = np.zeros(BUCKETS, np.float32), 1e-12, 1e-12
    usable = np.array([i for i, d in enumerate(docs) if len(d)], np.int64)

    def grams_of(used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        many = n_grams[used]
        upto = np.cumsum(many)
        return bucket[np.repeat(gram_at[used] - upto + many, many) + np.arange(upto[-1])], many

    def per_word(values: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Mean over each word's n-grams."""
        sums = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
        upto = np.cumsum(many)
        return ((sums[upto] - sums[upto - many]).T / np.maximum(many, 1)).T

    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(usable), max(1, -(-len(usable) // BATCH))):
            if not len(part):
                continue
            # Which blocks count: the TOP of each text by their log-odds.
            tokens = np.concatenate([docs[i] for i in part])
            starts, of_doc = starts_of([len(docs[i]) for i in part])
            size = np.diff(np.concatenate((starts, [len(tokens)])))
            used, inv = np.unique(tokens, return_inverse=True)
            g, many = grams_of(used)
            odds = np.add.reduceat(per_word((table @ (soft[:, 1] - soft[:, 0]))[g], many)[inv], starts) / size
            best = best_blocks(odds, of_doc)
            # Their words, forward and backward.
            starts, size, of_doc = starts[best], size[best], of_doc[best]
            upto = np.cumsum(size)
            tokens = tokens[np.repeat(starts - upto + size, size) + np.arange(upto[-1])]
            starts = upto - size
            used, inv = np.unique(tokens, return_inverse=True)
            g, many = grams_of(used)
            vec = per_word(table[g], many)
            blocks = np.add.reduceat(vec[inv], starts, axis=0) / size[:, None]
            logits = blocks @ soft + bias
            odds = logits[:, 1] - logits[:, 0]
            pooled, weight = pool(odds, of_doc, len(part))
            p = 1.0 / (1.0 + np.exp(-pooled))
            d_odds = ((p - labels[part])[of_doc] * weight / len(part)).astype(np.float32)
            d_logits = np.stack([-d_odds, d_odds], axis=1)
            d_soft, d_bias = blocks.T @ d_logits, d_logits.sum(axis=0)
            d_block = (d_logits @ soft.T) / size[:, None]
            token_block = np.repeat(np.arange(len(starts)), size)
            d_vec = np.stack([np.bincount(inv, weights=d_block[token_block, k], minlength=len(used))
                              for k in range(DIM)], axis=1) / np.maximum(many, 1)[:, None]
            rows, row_of = np.unique(g, return_inverse=True)
            spread = np.repeat(np.arange(len(used)), many)
            d_rows = np.stack([np.bincount(row_of, weights=d_vec[spread, k], minlength=len(rows))
                               for k in range(DIM)], axis=1)
            sq[rows] += (d_rows ** 2).sum(axis=1)
            table[rows] -= rate * d_rows / np.sqrt(sq[rows] + 1e-12)[:, None]
            soft_sq += (d_soft ** 2).sum()
            soft -= rate * SOFT_RATE * d_soft / np.sqrt(soft_sq)
            bias_sq += (d_bias ** 2).sum()
            bias -= rate * SOFT_RATE * d_bias / np.sqrt(bias_sq)
    return {"gram": (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32),
            "bias": float(bias[1] - bias[0])}


def log_odds(texts: list[str | None], model: dict) -> np.ndarray:
    """Log-odds of label 1 for each text (a text without words: nan)."""
    out = np.full(len(texts), np.nan)
    split = [words_of(t) for t in texts]
    lo = 0
    while lo < len(split):
        hi, size = lo, 0
        while hi < len(split) and (hi == lo or size <= BLOCK_BYTES):
            size += len(texts[hi] or "")
            hi += 1
        words = [w for ws in split[lo:hi] for w in ws]
        if words:
            total = np.zeros(len(words))
            many = np.zeros(len(words))
            for word, bucket in grams(words):
                total += np.bincount(word, weights=model["gram"][bucket], minlength=len(words))[:len(words)]
                many += np.bincount(word, minlength=len(words))[:len(words)]
            score = total / many
            starts, of_doc = starts_of([len(ws) for ws in split[lo:hi]])
            odds = np.add.reduceat(score, starts) / np.diff(
                np.concatenate((starts, [len(words)]))) + model["bias"]
            best = best_blocks(odds, of_doc)
            out[lo:hi] = pool(odds[best], of_doc[best], hi - lo)[0]
        lo = hi
    return out


def fit(docs: DataFrame, labels: DataFrame, train_each: int = TRAIN_EACH) -> dict:
    """The model from documents (doc_id, text) and labels (doc_id, toxic). The
    sampled ids, a bounded number, are broadcast to the documents; one task
    trains on the sample."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("label"))
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(n.values())
    share = n.get(1, 0) / total if total else 0.0
    if len(n) < 2:
        return {"gram": None, "share": share}
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("label") == 1, F.lit(train_each / n[1])).otherwise(F.lit(train_each / n[0]))
    chosen = known.filter(place < rate)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(i, y, t or "") for b in batches for i, y, t in zip(
            b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())})
        y = np.array([r[1] for r in rows])
        model = None
        if len(rows) and 0 < y.sum() < len(y):
            model = train([r[2] for r in rows], y) | {"sampled": float(y.mean())}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])
    found = [pickle.loads(r["model"]) for r in sample.repartition(1).mapInArrow(run, "model binary").collect()]
    model = next((m for m in found if m), {"gram": None})
    return model | {"share": share}


def predict(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row."""
    src = docs.select("doc_id", "text")
    shared = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            score = np.full(len(texts), m["share"])
            if m["gram"] is not None:
                prior = np.log(m["share"] / (1 - m["share"])) - np.log(m["sampled"] / (1 - m["sampled"]))
                odds = log_odds(texts, m) + prior
                score = np.where(np.isnan(odds), score, 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def scored(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Every document's score from a model that has seen only labels outside the
    held-out fold."""
    own = docs.select("doc_id", "text")
    seen = labels.filter(crc_mod(F.col("doc_id"), folds) != held).select("doc_id", "toxic")
    out = predict(own, fit(own, seen))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == held, F.lit(False)).alias(
        "held_out"), "score", "predicted")
