"""Language identification by a byte convolutional network: multi-width filters, max pooling and softmax in numpy.

The network reads fixed-length windows of bytes.  It is fitted on a bounded sample of labelled texts (``SAMPLE``
in all, ``WINDOWS`` windows each, at places spread over the whole text): of each language the distinct texts that are
the first in the order of a hash, however many copies they have; then every window of every text is
classified in batches and a document gets the mean of its windows' softmax values.

Because a filter is linear before the pooling, its response is a sum of entries of tables by byte pair: applying the
network needs gathers, additions and maxima only.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no labelled rows everything is
``und``; a null doc_id is neither learned from nor held out; repeated texts count once in the sample.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.batches import cuts, map_texts

WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
SAMPLE = 2400
WINDOWS = 4
STEPS = 1200
BATCH = 64
RATE = 0.004
SEED = 11
# Texts of each language at least, and how often training sees a window at least; every label present is learned.
LEAST = 8
EPOCHS = 8
UNDETERMINED = "und"
# Windows classified at a time, and softmax values held at a time.
BLOCK = 64
CELLS = 1 << 22


class Network:
    """Byte embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED)),
                  "out": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))),
                  "bias": np.zeros(len(languages))}
        for k in WIDTHS:
            self.p[f"f{k}"] = rng.normal(0, 1 / np.sqrt(k * EMBED), (k * EMBED, FILTERS))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _forward(self, x: np.ndarray):
        e = self.p["embed"][x]
        pooled, kept = [], []
        for k in WIDTHS:
            cols = np.concatenate([e[:, j: x.shape[1] - k + 1 + j] for j in range(k)], axis=2)
            conv = cols @ self.p[f"f{k}"]
            at = conv.argmax(1)
            pooled.append(np.take_along_axis(conv, at[:, None], 1)[:, 0])
            kept.append((cols, at))
        h = np.tanh(np.concatenate(pooled, 1))
        return h, softmax(h @ self.p["out"] + self.p["bias"]), kept

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(x), BATCH)
            xb = x[pick]
            h, prob, kept = self._forward(xb)
            d = prob.copy()
            d[np.arange(BATCH), y[pick]] -= 1
            d /= BATCH
            g = {"out": h.T @ d, "bias": d.sum(0), "embed": np.zeros_like(self.p["embed"])}
            dh = (d @ self.p["out"].T) * (1 - h * h)
            rows = np.arange(BATCH)[:, None]
            for i, k in enumerate(WIDTHS):
                cols, at = kept[i]
                part = dh[:, i * FILTERS:(i + 1) * FILTERS]
                best = cols[rows, at]  # window, filter, input
                g[f"f{k}"] = np.einsum("bfi,bf->if", best, part)
                back = part[:, :, None] * self.p[f"f{k}"].T[None]
                for j in range(k):
                    np.add.at(g["embed"], xb[rows, at + j], back[:, :, j * EMBED:(j + 1) * EMBED])
            for key, grad in g.items():
                first[key] = 0.9 * first[key] + 0.1 * grad
                second[key] = 0.999 * second[key] + 0.001 * grad * grad
                up = first[key] / (1 - 0.9 ** step)
                self.p[key] -= (RATE * up / (np.sqrt(second[key] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def tables(self) -> tuple:
        """Responses by byte pair, and for the last byte of an odd width by byte."""
        out = []
        for k in WIDTHS:
            single = [self.p["embed"] @ self.p[f"f{k}"][j * EMBED:(j + 1) * EMBED] for j in range(k)]
            pairs = [(single[j][:, None] + single[j + 1][None]).reshape(65536, FILTERS) for j in range(0, k - 1, 2)]
            out.append((k, pairs, single[-1] if k % 2 else None))
        return tuple(out)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text, one after another; the last is filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def classify(net: Network, tables: tuple, x: np.ndarray) -> np.ndarray:
    """Softmax values of many windows, from the tables."""
    out = np.empty((len(x), len(net.languages)), np.float32)
    for start in range(0, len(x), BLOCK):
        part = x[start:start + BLOCK].T.astype(np.intp)  # places first: the maxima then run over whole rows
        pair = part[:-1] * 256 + part[1:]
        pooled = []
        for k, pairs, single in tables:
            places = WINDOW - k + 1
            response = pairs[0].take(pair[:places], axis=0)
            for j, more in enumerate(pairs[1:], 1):
                response += more.take(pair[2 * j:2 * j + places], axis=0)
            if single is not None:
                response += single.take(part[k - 1:k - 1 + places], axis=0)
            pooled.append(response.max(0))
        h = np.tanh(np.concatenate(pooled, 1))
        out[start:start + BLOCK] = softmax(h @ net.p["out"] + net.p["bias"])
    return out


def fold_of(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5: fold 0 is held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def sample(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
           size: int = SAMPLE) -> list[tuple[str, bytes]]:
    """(language, windows) of about ``size`` labelled texts, as many of each language, ``LEAST`` or more: the first by
    a hash."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
                       fold_of(key).alias("fold")).where("fold <> 0 and lang is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not counts:
        return []
    share = max(min(LEAST, size), size // len(counts))

    def compute(texts: list) -> list:
        out = []
        for t in texts:
            w = windows_of(t)
            pick = np.unique(np.linspace(0, len(w) - 1, min(WINDOWS, len(w))).astype(int))
            out.append(w[pick].tobytes())
        return [out]

    out = []
    limits = {r.lang: min(1.0, 2.0 * share / max(1, r.n)) for r in counts}
    place = F.pmod("h", F.lit(1 << 30))
    while limits:
        parts = docs.sparkSession.createDataFrame(list(limits.items()), "lang string, part double")
        chosen = rows.join(F.broadcast(parts), "lang").where(place < F.col("part") * float(1 << 30))
        # copies of a text give one row
        made = map_texts(chosen.withColumn("place", place), "text", ["lang", "place", "h"], compute, "w binary")
        got: dict[str, list] = {}
        for r in made.groupBy("lang", "place", "h").agg(F.min("w").alias("w")).collect():
            got.setdefault(r.lang, []).append((r.place, r.h, bytes(r.w)))
        # too few below the limit, while there may be more: look further
        more = {k: min(1.0, 8 * part) for k, part in limits.items() if part < 1 and len(got.get(k, [])) < share}
        out += [(k, w) for k in limits if k not in more for _, _, w in sorted(got.get(k, []))[:share]]
        limits = more
    return sorted(out)


def train(rows: list[tuple[str, bytes]], steps: int = STEPS) -> Network | None:
    if not rows:
        return None
    languages = sorted({name for name, _ in rows})
    x = np.concatenate([np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for _, w in rows])
    y = np.concatenate([np.full(len(w) // WINDOW, languages.index(name)) for name, w in rows])
    return Network(languages).fit(x, y, max(steps, EPOCHS * len(x) // BATCH if len(languages) > SAMPLE // LEAST else 0))


def has_letter(text: str) -> bool:
    """Whether a character is a letter; signs that stand for numbers are none."""
    return any(map(str.isalpha, text))


_TABLES: dict = {}


def identify(docs: DataFrame, net: Network | None, text: str = "text", carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The carried columns, ``lang_pred`` and ``score`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def compute(texts: list) -> list:
        net = sent.value
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        lettered = [i for i, t in enumerate(texts) if net and t and has_letter(t.decode("utf-8", "replace"))]
        if not lettered:
            return [names, scores]
        if _TABLES.get("net") is not net:
            _TABLES.update(net=net, tables=net.tables())
        parts = [windows_of(texts[i]) for i in lettered]
        sizes = np.array([len(p) for p in parts])
        limit = max(BLOCK, CELLS // len(net.languages))
        for start, end in cuts(sizes, limit):
            if sizes[start] > limit:  # one text
                mean = sum(classify(net, _TABLES["tables"], parts[start][k:k + limit]).sum(0, dtype=np.float64)
                           for k in range(0, sizes[start], limit))[None]
            else:
                prob = classify(net, _TABLES["tables"], np.concatenate(parts[start:end]))
                firsts = np.concatenate(([0], np.cumsum(sizes[start:end])[:-1]))
                mean = np.add.reduceat(prob, firsts, axis=0, dtype=np.float64)
            mean /= sizes[start:end, None]
            for i, row in zip(lettered[start:end], mean):
                best = int(row.argmax())
                names[i], scores[i] = net.languages[best], min(1.0, float(row[best]))
        return [names, scores]

    return map_texts(docs, text, carry, compute, "lang_pred string, score double")
