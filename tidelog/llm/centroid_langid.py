"""Language ID by nearest centroid (operator 9).

A text becomes a TF-IDF vector of its letters' n-grams (1 to 3 letters, words
padded with a space), hashed to ``DIMS`` dimensions: 1 + log tf, times idf, of
unit length. Each language is several centroids, found by spherical k-means of
its own texts. A text gets the language of the centroid with the greatest
cosine; where that cosine is below what the language's own texts show, the
text is marked as rejected (``rejected``), its nearest language still given.

Document frequencies come from all training documents. The centroids are
fitted on a sample: at most ``TRAIN_DOCS`` documents a language (expected;
chosen by the hash of the id).

Defined cases: a null or empty text, or one without a letter, is ``und`` with
score 0 and rejected. Without any training document every text is ``und``. A
null id is never held out nor trained on. Repeated rows count as often as they
occur. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod

BITS = 13
DIMS = 1 << BITS
CLUSTERS = 4
TRAIN_DOCS = 2000
ROUNDS = 10
#: Rejected: less than this share of the lowest cosines of the language's own
#: training texts (the 1% quantile).
REJECT = 0.5
SEED = 9
#: Letters counted at once; texts are gathered up to this (a longer one is alone).
BLOCK_CHARS = 1 << 20

_IS_LETTER = np.zeros(1 << 16, bool)
_IS_LETTER[[c for c in range(1 << 16) if chr(c).isalpha()]] = True


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def counts(texts: list[str]) -> Iterator[np.ndarray]:
    """Counts of the hashed n-grams of each text (DIMS numbers)."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK_CHARS):
            size += len(texts[hi]) + 1
            hi += 1
        lowered = [t.lower() for t in texts[lo:hi]]
        joined = " " + " ".join(lowered) + "  "
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = np.where(code < 1 << 16, _IS_LETTER[np.minimum(code, (1 << 16) - 1)], True)
        x = np.where(letter, code, 32).astype(np.uint32)
        a, b, c = x[:-2], x[1:-1], x[2:]
        spread = np.uint32(0x9E3779B1)
        shift = np.uint32(32 - BITS)
        one = (b * spread) >> shift
        two = ((b * np.uint32(0x85EBCA6B) ^ c) * spread) >> shift
        three = (((a * np.uint32(0xC2B2AE35) ^ b) * np.uint32(0x85EBCA6B) ^ c) * spread) >> shift
        mid = letter[1:-1]
        pair = mid | letter[2:]
        at = 0
        for t in lowered:
            s = slice(at, at + len(t))
            m, p = mid[s], pair[s]
            yield (np.bincount(one[s][m], minlength=DIMS) + np.bincount(two[s][p], minlength=DIMS)
                   + np.bincount(three[s][m], minlength=DIMS))
            at += len(t) + 1
        lo = hi


def unit(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    v = (np.log1p(tf) * idf).astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


def document_frequencies(train: DataFrame) -> np.ndarray:
    """How many training texts hold each hashed n-gram, then how many there
    are. A task sends DIMS + 1 sums, so DIMS + 1 rows come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)
        for b in batches:
            for tf in counts([t or "" for t in b.column(0).to_pylist()]):
                df[:DIMS] += tf > 0
                df[DIMS] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMS + 1), pa.int32()), pa.array(df)], names=["i", "n"])
    out = np.zeros(DIMS + 1, np.int64)
    for r in train.select("text").mapInArrow(run, "i int, n long").groupBy("i").agg(
            F.sum("n").alias("n")).collect():
        out[r["i"]] = r["n"]
    return out


def clustered(v: np.ndarray, k: int, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Unit centroids of k-means by cosine, and the 1% quantile of the rows'
    cosines to their own. Starts far apart; an empty cluster is dropped."""
    rng = np.random.default_rng(seed)
    centres = v[[int(rng.integers(len(v)))]]
    while len(centres) < min(k, len(v)):
        centres = np.vstack([centres, v[[int((v @ centres.T).max(axis=1).argmin())]]])
    for _ in range(ROUNDS):
        nearest = (v @ centres.T).argmax(axis=1)
        sums = [v[nearest == j].sum(axis=0) for j in range(len(centres)) if (nearest == j).any()]
        centres = np.array(sums)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32), float(np.quantile((v @ centres.T).max(axis=1), 0.01))


def fit(train: DataFrame, k: int = CLUSTERS, train_docs: int = TRAIN_DOCS) -> dict:
    """The model: idf, languages, centroids and the languages' lowest cosines.
    ``train``: doc_id, text, lang. Each language is clustered in its own task on
    its sample."""
    df = document_frequencies(train)
    idf = (np.log((1.0 + df[DIMS]) / (1.0 + df[:DIMS])) + 1.0).astype(np.float32)
    # One row a language, smaller than the model itself: broadcast, so that ids
    # aren't dealt by language.
    n = F.broadcast(train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    share = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    # The ids are sampled without the texts: about train_docs a language, so that
    # their broadcast is bounded, and only the sample's texts are moved.
    chosen = train.select("lang", "doc_id").join(n, "lang").filter(
        share * F.col("n") < train_docs).select("lang", "doc_id").distinct()
    sample = train.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", "doc_id", "text")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t for _, t in sorted(zip(rows["doc_id"], rows["text"]), key=lambda x: x[0])]
        v = np.empty((len(texts), DIMS), np.float32)
        for i, tf in enumerate(counts(texts)):
            v[i] = unit(tf, idf)
        centres, low = clustered(v, k)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "low": low, "centre": list(centres)})
    rows = sample.groupBy("lang").applyInPandas(
        one, "lang string, low double, centre array<float>").orderBy("lang").collect()
    return {"idf": idf, "lang": [r["lang"] for r in rows], "low": np.array([r["low"] for r in rows]),
            "centres": np.array([r["centre"] for r in rows], np.float32).reshape(-1, DIMS)}


def predict(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text",
            reject: float = REJECT) -> DataFrame:
    """doc_id, lang_pred, score (the cosine) and rejected of every row."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            lang, score, out = [], [], []
            v = np.empty((256, DIMS), np.float32)
            for lo in range(0, len(texts), 256):
                some = texts[lo:lo + 256]
                for i, tf in enumerate(counts(some)):
                    v[i] = tf
                cosine = unit(v[:len(some)], m["idf"]) @ m["centres"].T if len(m["lang"]) else None
                for i, t in enumerate(some):
                    if cosine is None or not has_letter(t):
                        lang.append("und")
                        score.append(0.0)
                        out.append(True)
                        continue
                    j = int(cosine[i].argmax())
                    s = float(cosine[i, j])
                    lang.append(m["lang"][j])
                    score.append(min(1.0, max(0.0, s)))
                    out.append(s < reject * m["low"][j])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(out, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Every document's predicted language from a model that has seen only
    documents outside the held-out fold."""
    fold = crc_mod(F.col("doc_id"), folds)
    train = docs.filter((fold != held) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", "lang")
    out = predict(docs, fit(train))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == held, F.lit(False)).alias(
        "held_out"), "lang_pred", "score", "rejected")
