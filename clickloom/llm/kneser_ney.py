"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, and perplexity thresholds.

The model is over symbols of lower-case characters, of order 5, so an n-gram packs into a bigint exactly: contexts and
shorter n-grams are bit operations, and counts of all orders are grouped and joined by key.  Every character keeps its
identity: those of ``SINGLE`` are one symbol, all others two, a lead and a trail, beyond U+FFFF three.  Leads, trails
and single symbols are apart, so different texts are different streams.  Every trusted document is counted.

1. Counts: the texts of trusted documents are joined by id; a broadcast bitmap of fixed size can drop most others (the
   optimiser may move it behind the join, whose result is the same).  Each slice of texts is counted in numpy, the slices are added up by key.  Lower orders
   are continuation counts, each grouped from the distinct keys of the order above.
2. Probabilities: for every distinct n-gram of the corpus, order by order, by joins with counts and context totals
   that are sharded by their keys.
3. Scores: n-grams that are frequent in the corpus, ``FREQUENT`` at most, are broadcast and looked up in numpy; the
   others of a document go through a sharded join on the key and are added up per document.
4. Thresholds: per language from a histogram of log-perplexity over all trusted documents: the upper quantile plus
   ``SLACK`` times its distance from the median.  Every language with trusted documents has its own; the
   others, and a null language, share the threshold over all.

Defined results: a null or empty text has no perplexity and is not kept; without trusted text no document has a
threshold and all with a text are kept; repeated rows with one id are scored alike; a document labelled several times
is trusted if any label says so; texts of any length are scored whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.batches import map_texts
from clickloom.session import Scratch

ORDER = 5
BITS = 12
# Symbols: 0 before the text, 1 behind it, then the code points of their own, leads by upper bits, trails by byte.
SINGLE = np.r_[0:0x700, 0x900:0xFE0]
LEAD = 2 + len(SINGLE)
FAR_LEAD = LEAD + 256
TRAIL = FAR_LEAD + 16
assert TRAIL + 256 <= 1 << BITS
SYMBOL = np.zeros(0x1000, np.int32)
SYMBOL[SINGLE] = np.arange(2, LEAD)
FREQUENT = 1 << 20
QUANTILE = 0.99
SLACK = 4.0
# Histogram bins per unit of log-perplexity.
BINS = 1000
COUNT_SLICE = 8 << 20
# Bits of the bitmap of trusted documents: at most a 64th as many rows are broadcast.
TRUSTED_BITS = 1 << 24


def mask(order: int) -> int:
    return (1 << (BITS * order)) - 1


def _spread(codes: np.ndarray, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stream in which characters without a symbol of their own (0 in ``symbols``) are two or three; its ends."""
    at = np.flatnonzero(symbols == 0)
    wide = codes[at]
    far = wide > 0xFFFF
    width = np.ones(len(codes), np.int64)
    width[at] = 2 + far
    upto = np.cumsum(width)
    out = np.empty(upto[-1] if len(upto) else 0, np.int32)
    out[upto - width] = symbols
    start = (upto - width)[at]
    out[start] = np.where(far, FAR_LEAD + (wide >> 16) - 1, LEAD + (wide >> 8))
    out[start + 1] = TRAIL + (np.where(far, wide >> 8, wide) & 255)
    out[start[far] + 2] = TRAIL + (wide[far] & 255)
    return out, upto[ends - 1]


def keys_of(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts, one per symbol and one for the end of each, and their number per text."""
    pad = "\0" * (order - 1)
    joined = "".join(f"{pad}{t}\0" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
    del joined
    ends = np.cumsum(np.array([len(t) + order for t in texts], np.int64))
    symbols = SYMBOL[np.minimum(codes, len(SYMBOL) - 1)]
    if not symbols.all():
        symbols, ends = _spread(codes, symbols, ends)
    sizes = np.diff(ends, prepend=0)
    for k in range(order - 1):
        symbols[ends - sizes + k] = 0
    symbols[ends - 1] = 1
    keys = np.zeros(max(len(symbols) - order + 1, 0), np.int64)
    for k in range(order):
        keys <<= BITS
        keys |= symbols[k:k + len(keys)]
    inside = np.ones(len(keys), bool)  # windows that do not cross into the next text
    for k in range(1, order):
        inside[ends[:-1] - k] = False
    return keys[inside], sizes - order + 1


def _plain(texts: list) -> list[str]:
    return [t.decode("utf-8", "replace").lower() if t else "" for t in texts]


def count_keys(docs: DataFrame, text: str) -> DataFrame:
    """``key, n``: n-grams of all texts and how often they occur."""
    def compute(texts: list) -> list:
        found, n = np.unique(keys_of([t for t in _plain(texts) if t])[0], return_counts=True)
        ends = np.concatenate(([0], np.full(len(texts), len(found)))).astype(np.int32)  # all on the first row
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (found, n)]

    counted = map_texts(docs, text, [], compute, "key array<long>, n array<long>", COUNT_SLICE)
    return counted.select(F.inline(F.arrays_zip("key", "n"))).groupBy("key").agg(F.sum("n").alias("n"))


def of_trusted(docs: DataFrame, trusted: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` (id, text) whose id is in ``trusted`` (id, no nulls)."""
    bit = F.xxhash64("id").bitwiseAND(TRUSTED_BITS - 1)
    split = lambda df: df.withColumns({"_w": F.shiftright(bit, 6), "_b": (bit % 64).cast("int")})
    words = split(trusted).groupBy("_w").agg(F.bit_or(F.expr("shiftleft(1L, _b)")).alias("_bits"))
    likely = split(docs).join(F.broadcast(words), "_w").where(F.expr("shiftrightunsigned(_bits, _b) & 1 = 1"))
    # written, or the join would be moved below the bitmap and all texts be shuffled
    likely = scratch.keep(likely.select("id", "text"))
    # always by a shuffle, whatever the sizes: the list of trusted documents has no bound
    return likely.join(trusted.hint("merge"), "id", "left_semi")


def _discounts(counts: DataFrame) -> list[float]:
    """The discounts of counts of one, two, and three or more."""
    row = counts.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n = [0, row.n1, row.n2, row.n3, row.n4]
    out = []
    for i in (1, 2, 3):
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i / 2
        out.append(min(max(d, 0.0), float(i)))
    return out


def _by_count(n: Column, values: list[float]) -> Column:
    return F.when(n == 1, values[0]).when(n == 2, values[1]).when(n >= 3, values[2]).otherwise(0.0)


def log_probabilities(counts: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """``key, n, logp`` for the n-grams in ``wanted`` (key, n) under the model of ``counts`` (key, n)."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = scratch.keep(tables[order + 1].groupBy(
            F.col("key").bitwiseAND(mask(order)).alias("key")).agg(F.count("*").alias("n")))
    letters = tables[1].count() + 1
    shorter = None
    for order in range(1, ORDER + 1):
        table, d = tables[order], _discounts(tables[order])
        n, context = F.col("n"), F.shiftright("key", BITS)
        totals = table.groupBy(context.alias("context")).agg(
            F.sum("n").alias("total"), (F.sum(_by_count(n, d)) / F.sum("n")).alias("left"))
        here = wanted.select(F.col("key").bitwiseAND(mask(order)).alias("key")).distinct()
        joined = here.join(table, "key", "left").withColumn("context", context).join(totals, "context", "left")
        if shorter is None:
            below = joined.withColumn("below", F.lit(1.0 / letters))
        else:
            below = joined.withColumn("short", F.col("key").bitwiseAND(mask(order - 1))).join(
                shorter.select(F.col("key").alias("short"), F.col("p").alias("below")), "short")
        count = F.coalesce(n, F.lit(0))
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            (count - _by_count(count, d)) / F.col("total") + F.col("left") * F.col("below"))
        shorter = scratch.keep(below.select("key", p.alias("p")))
    return wanted.join(shorter, "key").select("key", "n", F.log("p").alias("logp"))


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, logp = table
    if not len(known):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys).clip(0, len(known) - 1)
    found = known[at] == keys
    return np.where(found, logp[at], 0.0), found


def score(docs: DataFrame, probabilities: DataFrame, key: str, text: str, carry: list[str], scratch: Scratch) -> DataFrame:
    """The carried columns, ``n_symbols`` and ``perplexity`` for every row."""
    sizes = {r.b: r.c for r in probabilities.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(
        F.count("*").alias("c")).collect()}
    least, total = 64, 0
    for b in sorted(sizes, reverse=True):
        total += sizes[b]
        if total > FREQUENT:
            break
        least = b
    often = probabilities.where(F.col("n") >= float(2 ** least)).select("key", "logp").toArrow()
    known, logp = often.column(0).to_numpy(), often.column(1).to_numpy()
    order = np.argsort(known)
    sent = docs.sparkSession.sparkContext.broadcast((known[order], logp[order]))

    def compute(texts: list) -> list:
        keys, n = keys_of(_plain(texts))
        distinct, back = np.unique(keys, return_inverse=True)
        value, found = _lookup(sent.value, distinct)
        per_key = value[back]
        row = np.repeat(np.arange(len(texts)), n)
        sums = np.bincount(row, per_key, len(texts))
        rare: list[list] = [[] for _ in texts]
        for i in np.flatnonzero(~found[back]):
            rare[row[i]].append(int(keys[i]))
        return [n - np.array([not t for t in texts], np.int64), sums, rare]

    names = [f"_k{i}" for i in range(len(carry))]
    source = docs.select(*[F.col(f"`{c}`").alias(a) for a, c in zip(names, carry)], F.xxhash64(F.col(f"`{text}`")).alias("_h"),
                         F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    base = scratch.keep(map_texts(source, "_text", [*names, "_id", "_h"], compute,
                                  "_n long, _sum double, _rare array<long>"))
    rare = base.where(F.size("_rare") > 0).select("_id", "_h", "_rare").dropDuplicates(["_id", "_h"])
    sums = rare.select("_id", "_h", F.explode("_rare").alias("key")).groupBy("_id", "_h", "key").agg(
        F.count("*").alias("times")).join(probabilities.select("key", "logp"), "key").groupBy("_id", "_h").agg(
        F.sum(F.col("times") * F.col("logp")).alias("_more"))
    same = base["_id"].eqNullSafe(sums["_id"]) & (base["_h"] == sums["_h"])
    both = base.join(sums, same, "left").drop(sums["_id"]).drop(sums["_h"])
    mean = (F.col("_sum") + F.coalesce("_more", F.lit(0.0))) / F.col("_n")
    return both.select(*names, F.col("_n"), F.when(F.col("_n") > 0, F.exp(-mean))).toDF(*carry, "n_symbols", "perplexity")


def thresholds(scored: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> tuple[DataFrame, float | None]:
    """Limits of log-perplexity per language (``lang, limit``), and over all, from ``scored`` (lang, perplexity)."""
    bins = scored.where("perplexity is not null").select(
        "lang", F.floor(F.log("perplexity") * BINS).cast("int").alias("bin"))
    cells = bins.groupBy("lang", "bin").agg(F.count("*").alias("c"))

    def limits(rows: DataFrame, by: list[str]) -> DataFrame:
        # windows over a histogram: as many rows as bins
        order = Window.partitionBy(*by).orderBy("bin")
        shares = rows.withColumns({"upto": F.sum("c").over(order), "total": F.sum("c").over(Window.partitionBy(*by))})
        reach = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin") + 1)) / F.lit(float(BINS))
        grouped = shares.groupBy(*by) if by else shares.groupBy()
        return grouped.agg(reach(quantile).alias("high"), reach(0.5).alias("mid")).select(
            *by, (F.col("high") + slack * (F.col("high") - F.col("mid"))).alias("limit"))

    known = limits(cells.where("lang is not null"), ["lang"])
    everything = limits(cells.groupBy("bin").agg(F.sum("c").alias("c")), []).first()
    return known, everything.limit if everything else None


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``key, lang, n_symbols, perplexity, trusted, kept`` for every row; ``labels`` has the key and ``quality``."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
                       F.col(f"`{lang}`").cast("string").alias("lang"))
    trusted = scratch.keep(labels.where("quality = 1").select(F.col(key).alias("id")).where("id is not null").distinct())
    counts = scratch.keep(count_keys(of_trusted(rows.select("id", "text"), trusted, scratch), "text"))
    wanted = scratch.keep(count_keys(rows, "text"))
    probabilities = scratch.keep(log_probabilities(counts, wanted, scratch))
    scored = scratch.keep(score(rows, probabilities, "id", "text", ["id", "lang"], scratch).join(
        trusted.withColumn("trusted", F.lit(True)), "id", "left"))
    known, overall = thresholds(scored.where("trusted"), quantile, slack)
    limit = F.coalesce("limit", F.lit(overall if overall is not None else math.inf))
    # a row per language, however many there are: written, so that its size says how it is joined
    out = scored.join(scratch.keep(known), "lang", "left")
    return out.select("id", "lang", "n_symbols", "perplexity", F.coalesce("trusted", F.lit(False)).alias("trusted"),
                      F.coalesce(F.log("perplexity") <= limit, F.lit(False)).alias("kept")).withColumnRenamed("id", key)
