"""Quality classifier: interpolated modified Kneser-Ney over characters (operator 1).

A 4-gram model of symbols is trained on trusted text. Symbols are characters
(digits as 0, runs of white space as one space); a 4-gram is one 64-bit number,
so suffixes and contexts are masks and shifts, and all counts are DataFrames:

* tasks count their texts' 4-grams, and the counts are summed by 4-gram;
* continuation counts of each lower order come from the order above, the three
  discounts of each order from its counts of counts;
* every 4-gram that occurs in the corpus gets its interpolated log probability
  by joins of the count tables, sharded by n-gram and by context;
* texts look up the ``HOT`` most frequent 4-grams in a broadcast of that many
  rows at most, and all others by a join; both parts are summed per document.

A document is kept if its perplexity is at most its language's threshold: the
``QUANTILE`` of the perplexities of the language's trusted documents, each
counted once or, as the query does, as often as it has symbols. By symbols a
text of a few characters, whose perplexity says little, can't set the limit
unless it is a thousandth of its language's trusted text; it is still judged.

Defined cases: a null or empty text is only the end of a text, scored like any
other; a null language is a language of its own; a language without trusted
documents takes the quantile of all trusted ones; without trusted text at all
nothing is judged and every document is kept, with a null threshold. Repeated
rows are scored as often as they occur; an id with several labels is trusted
if one of them says so; a null id is never trusted. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ORDER = 4
HOT = 1 << 17
QUANTILE = 0.999
#: Perplexities are binned to 1/BINS of their logarithm for the quantiles.
BINS = 1000
#: Bits of the filter by which unlabelled documents are left out before the
#: labels are joined; 64 bits a row, so its broadcast has BITMAP / 64 rows.
BITMAP = 1 << 22
#: Symbols handled at once; texts are gathered up to this (a longer one is
#: alone), and distinct 4-grams held by a task before they are sent on.
BLOCK = 1 << 20
HELD = 1 << 21

START, END, SPACE, ZERO = 2, 3, 32, 48
_KIND = np.arange(1 << 16, dtype=np.uint16)
_KIND[48:58] = ZERO
_KIND[[9, 10, 11, 12, 13]] = SPACE


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each with three start symbols before it and an end
    symbol after it, and the position of each text's first symbol. Code points
    beyond 16 bits share the private-use symbols."""
    pad = chr(START) * (ORDER - 1)
    joined = "".join(f"{pad}{t}{chr(END)}" for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = _KIND[np.where(code < 1 << 16, code, 0xE000 + code % 0x1900)]
    first = np.cumsum([0] + [len(t) + ORDER for t in texts])
    keep = ~((x[1:] == SPACE) & (x[:-1] == SPACE))
    keep = np.concatenate(([True], keep))
    at = np.concatenate(([0], np.cumsum(keep)))[first]
    return x[keep], at


def four_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each text's 4-grams in order, and where each text's begin."""
    x, at = symbols(texts)
    y = x.astype(np.uint64)
    s = [np.uint64(16 * k) for k in (3, 2, 1)]
    g = (y[:-3] << s[0]) | (y[1:-2] << s[1]) | (y[2:-1] << s[2]) | y[3:] if len(y) > 3 else y[:0]
    # 4-grams that run into the next text's start symbols are not of a text.
    inside = np.ones(len(g), bool)
    for k in range(1, ORDER):
        end = at[1:-1] - k
        inside[end] = False
    sizes = np.diff(at) - (ORDER - 1)
    return g[inside].view(np.int64), np.concatenate(([0], np.cumsum(sizes)))


def blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of at most BLOCK characters together, with their start."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi


def counted(texts: DataFrame) -> DataFrame:
    """(gram, n) over the column ``text``: each task sends its own sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            g, n = (np.concatenate(c) for c in zip(*held))
            u, inv = np.unique(g, return_inverse=True)
            return u, np.bincount(inv, weights=n).astype(np.int64)

        def out(g: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(g), 1 << 17):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[k:k + (1 << 17)]), pa.array(n[k:k + (1 << 17)])], names=["gram", "n"])

        for b in batches:
            for _, some in blocks([t or "" for t in b.column(0).to_pylist()]):
                held.append(np.unique(four_grams(some)[0], return_counts=True))
                if sum(len(g) for g, _ in held) > HELD:
                    held = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield from out(*held[0])
                        held = []
        if held:
            yield from out(*merged())
    return texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(
        F.sum("n").alias("n"))


def _mask(order: int) -> Column:
    return F.lit((1 << 16 * order) - 1).cast("long")


def suffix(gram: Column, order: int) -> Column:
    """The last ``order`` symbols of a gram of one more."""
    return gram.bitwiseAND(_mask(order))


def context(gram: Column, order: int) -> Column:
    """A gram of ``order`` symbols without its last one."""
    return F.shiftrightunsigned(gram, 16)


def count_tables(trusted: DataFrame) -> list[tuple[DataFrame, DataFrame, tuple[float, float, float]]]:
    """For each order from 1 to ORDER: the counts (gram, c), continuation counts
    below the highest order; the contexts (h, total, n1, n2, n3); the discounts.
    Four sums an order come to the driver."""
    out = []
    c = trusted.select("gram", F.col("n").alias("c"))
    for order in range(ORDER, 0, -1):
        c = stored(c)
        h = c.groupBy(context(F.col("gram"), order).alias("h")).agg(
            F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("n1"),
            F.count_if(F.col("c") == 2).alias("n2"), F.count_if(F.col("c") >= 3).alias("n3"))
        n1, n2, n3, n4 = c.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        of = lambda k, a, b, d: min(float(k), max(0.0, k - (k + 1) * y * b / a)) if a and b else d
        d1 = of(1, n1, n2, 0.5)
        d2 = of(2, n2, n3, max(d1, 0.5))
        out.append((c, h, (d1, d2, of(3, n3, n4, max(d2, 0.5)))))
        c = c.select(suffix(F.col("gram"), order - 1).alias("gram")).groupBy("gram").agg(
            F.count(F.lit(1)).alias("c"))
    return out[::-1]


def log_probabilities(corpus: DataFrame, tables: list) -> DataFrame:
    """(gram, n, logp) of each 4-gram of the corpus: the natural logarithm of its
    last symbol's interpolated probability after its first three."""
    wanted = [corpus.select("gram")]
    for order in range(ORDER - 1, 0, -1):
        wanted.append(wanted[-1].select(suffix(F.col("gram"), order).alias("gram")).distinct())
    wanted = wanted[::-1]                       # distinct grams of order 1, 2, ..., ORDER
    wanted[0] = stored(wanted[0])
    uniform = 1.0 / (wanted[0].count() + 1)     # the symbols there are, and one unseen
    p = wanted[0].select("gram", F.lit(uniform).alias("p"))
    for order in range(1, ORDER + 1):
        c, h, (d1, d2, d3) = tables[order - 1]
        t = wanted[order - 1].withColumns({
            "h": context(F.col("gram"), order),
            "s": suffix(F.col("gram"), order - 1) if order > 1 else F.col("gram")})
        t = t.join(c, "gram", "left").join(h, "h", "left").join(
            p.select(F.col("gram").alias("s"), "p"), "s")
        discount = (F.when(F.col("c") == 1, F.lit(d1)).when(F.col("c") == 2, F.lit(d2))
                    .otherwise(F.lit(d3)))
        own = F.coalesce(F.greatest(F.col("c") - discount, F.lit(0.0)) / F.col("total"), F.lit(0.0))
        back = F.coalesce((d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total"),
                          F.lit(1.0))
        # A context whose discounts are all 0 must still leave something.
        back = F.greatest(back, F.lit(1e-9))
        p = t.select("gram", (own + back * F.col("p")).alias("p"))
    return corpus.join(p, "gram").select("gram", "n", F.log("p").alias("logp"))


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with quality 1. A bitmap of hashed ids, of a fixed size, is
    broadcast first, so that only labelled texts (and a few others) are moved
    to be joined. The ids are distinct and joined by an inner join: the optimizer
    would push a semi join below the bitmap's, to all texts. It is a shuffled
    hash join of the ids at every size, so that texts are never sorted and the
    ids never broadcast."""
    ids = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP))
    word, bit = F.shiftright(slot, 6).alias("_lm_word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    bitmap = ids.select(word, bit.alias("_lm_bit")).groupBy("_lm_word").agg(
        F.bit_or("_lm_bit").alias("_lm_bits"))
    maybe = (docs.withColumns({"_lm_word": F.shiftright(slot, 6), "_lm_bit": bit})
             .join(F.broadcast(bitmap), "_lm_word")
             .filter(F.col("_lm_bits").bitwiseAND(F.col("_lm_bit")) != 0)
             .select(*docs.columns))
    return maybe.join(ids.hint("shuffle_hash"), "doc_id").select(*docs.columns)


def perplexities(docs: DataFrame, logp: DataFrame, hot_rows: int = HOT) -> DataFrame:
    """doc_id, lang, n_symbols and perplexity of every row of docs (doc_id,
    lang, text); ``logp`` must hold every 4-gram of them."""
    hot = logp.orderBy(F.desc("n"), "gram").limit(hot_rows).select("gram", "logp").toArrow()
    g, v = hot.column(0).to_numpy(), hot.column(1).to_numpy()
    order = np.argsort(g)
    shared = docs.sparkSession.sparkContext.broadcast((g[order], v[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = shared.value
        for b in batches:
            for lo, some in blocks([t or "" for t in b.column(3).to_pylist()]):
                grams, at = four_grams(some)
                i = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
                known = keys[i] == grams if len(keys) else np.zeros(len(grams), bool)
                text = np.repeat(np.arange(len(some)), np.diff(at))
                total = np.bincount(text[known], weights=values[i[known]] if len(keys) else None,
                                    minlength=len(some))
                rows = b.slice(lo, len(some))
                n = len(some)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), rows.column(1), rows.column(2), pa.nulls(n, pa.int64()),
                    pa.array(np.diff(at).astype(np.int64)), pa.array(total.astype(np.float64))], names=names)
                if known.all():
                    continue
                # The other 4-grams, once for each text with their number.
                t, r = text[~known], grams[~known]
                by = np.lexsort((r, t))
                t, r = t[by], r[by]
                new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (r[1:] != r[:-1]))))
                many = np.diff(np.concatenate((new, [len(t)])))
                m = len(new)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(pa.array(t[new])), pa.nulls(m, rows.column(1).type),
                    pa.nulls(m, pa.string()), pa.array(r[new]), pa.array(many.astype(np.int64)),
                    pa.nulls(m, pa.float64())], names=names)

    names = ["row", "doc_id", "lang", "gram", "n", "logp"]
    src = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                      F.col("lang").cast("string").alias("lang"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    parts = stored(src.mapInArrow(
        run, f"row long, doc_id {kind}, lang string, gram long, n long, logp double"))
    rare = parts.filter("gram IS NOT NULL").select("row", "gram", "n").join(
        logp.select("gram", F.col("logp").alias("each")), "gram").groupBy("row").agg(
            F.sum(F.col("n") * F.col("each")).alias("rest"))
    whole = parts.filter("gram IS NULL").drop("gram").join(rare, "row", "left")
    mean = (F.col("logp") + F.coalesce("rest", F.lit(0.0))) / F.col("n")
    return whole.select("doc_id", "lang", F.col("n").alias("n_symbols"), F.exp(-mean).alias("perplexity"))


def thresholds(scored: DataFrame, quantile: float, by_symbols: bool = False) -> DataFrame:
    """lang key and threshold: the quantile of the perplexities by language, and
    of all under a null key, from a histogram of their logarithms. Each row
    counts once, or ``by_symbols`` as often as it has symbols."""
    weight = F.col("n_symbols") if by_symbols else F.lit(1)
    bins = scored.select("_lm_lang", F.ceil(F.log("perplexity") * BINS).alias("bin"), weight.alias("w")).groupBy(
        "_lm_lang", "bin").agg(F.sum("w").alias("n"))
    both = bins.unionByName(bins.groupBy("bin").agg(F.sum("n").alias("n")).select(
        F.lit(None).cast("string").alias("_lm_lang"), "bin", "n"))
    upto = Window.partitionBy("_lm_lang").orderBy("bin")
    every = Window.partitionBy("_lm_lang")
    ranked = both.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(every)})
    return ranked.filter(F.col("upto") >= quantile * F.col("total")).groupBy("_lm_lang").agg(
        F.exp(F.min("bin") / BINS).alias("threshold"))


def classified(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
               hot_rows: int = HOT, by_symbols: bool = False) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold and kept of every
    document (doc_id, lang, text), by a model of those with quality 1; the
    limit's quantile is over documents or, ``by_symbols``, over their symbols."""
    own = docs.select("doc_id", "lang", "text")
    tables = count_tables(counted(trusted_documents(own.select("doc_id", "text"), labels)))
    logp = stored(log_probabilities(stored(counted(own)), tables))
    scored = stored(perplexities(own, logp, hot_rows).withColumn(
        "_lm_lang", F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))))
    ids = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    limits = thresholds(scored.join(ids, "doc_id", "left_semi"), quantile, by_symbols)
    general = limits.filter("_lm_lang IS NULL").first()
    limit = F.coalesce("threshold", F.lit(general["threshold"] if general else None).cast("double"))
    out = scored.join(limits.filter("_lm_lang IS NOT NULL"), "_lm_lang", "left")
    return out.select("doc_id", "lang", "n_symbols", "perplexity", limit.alias("threshold"),
                      F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("kept"))
