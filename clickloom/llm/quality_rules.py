"""Quality rules on repetition: characters inside duplicated n-grams and lines, by rolling hashes in numpy.

Words are runs of bytes other than the ASCII white space; they are numbered per slice of documents, and the n-grams
of all documents of a slice are hashed and sorted together.  There is no shuffle and no state between slices.

Defined results: a null text counts as an empty one (no words, so it fails the base rule and is not kept); repeated
rows are judged alike; a document of any length is judged whole.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame

from clickloom.llm.batches import keep_rows, map_texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
MIN_WORDS = 50
MAX_REPEATED = 0.5
# Largest share of the word characters that later copies of n-grams may cover, by n; fixed values from the
# published repetition rules for web text, as is the limit on lines.  Lines count by their characters only: one short
# line that stands twice is a third of a text of three lines.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS_LIMIT = 0.20
# Odd multiplier of the rolling hash and of the mixing of word numbers.
BASE = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, "
          "dup_line_chars double, " + ", ".join(f"dup_{n}gram_chars double" for n in NGRAM_LIMITS)
          + ", base_failed boolean, kept boolean")


def _mix(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * BASE
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _pairs_alike(keys: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (``at`` ascends) whose key occurs again in the same document: all, and all but the first of each key."""
    order = np.argsort(keys, kind="stable")
    sorted_keys, places = keys[order], at[order]
    same = (sorted_keys[1:] == sorted_keys[:-1]) & (doc[places[1:]] == doc[places[:-1]])
    later = np.zeros(len(keys), bool)
    later[1:] = same
    every = later.copy()
    every[:-1] |= same
    return np.sort(places[every]), places[later]


def _covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which words lie in one of the n-word windows that begin at ``starts``."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _triples(ids: np.ndarray, distinct: int) -> np.ndarray:
    """A number for every 3-word window, equal only for equal windows."""
    wide = np.int64(distinct)
    pairs = ids[:-2] * wide + ids[1:-1]
    if distinct >= 1 << 21:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    return pairs * wide + ids[2:]


def measure(texts: list) -> dict[str, np.ndarray]:
    """The features of a slice of texts (UTF-8 bytes or None)."""
    texts = [t or b"" for t in texts]
    split = [t.split() for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    total = int(n_words.sum())
    words = [w for doc in split for w in doc]
    del split
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, total)
    lengths = np.fromiter((len(w.translate(None, CONTINUATION)) for w in numbers), np.int64, len(numbers))
    chars = lengths[ids] if total else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    ends = np.cumsum(n_words)
    per_doc = lambda mask, what: np.bincount(doc[mask], what[mask], len(texts))
    one = np.ones(total, np.int64)

    out = {"n_words": n_words, "word_chars": np.bincount(doc, chars, len(texts)).astype(np.int64)}
    out["n_symbols"] = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)

    n_lines, n_dup, dup_chars = (np.zeros(len(texts), np.int64) for _ in range(3))
    for i, t in enumerate(texts):
        lines = [line for line in t.split(b"\n") if line.strip()]
        n_lines[i] = len(lines)
        if len(set(lines)) < len(lines):
            seen: set[bytes] = set()
            for line in lines:
                if line in seen:
                    n_dup[i] += 1
                    dup_chars[i] += len(line.translate(None, CONTINUATION + SPACES))
                seen.add(line)
    safe = np.maximum(out["word_chars"], 1)
    out |= {"n_lines": n_lines, "n_dup_lines": n_dup}

    at = np.flatnonzero(np.arange(total) + 3 <= ends[doc]) if total else np.zeros(0, np.int64)
    every = _pairs_alike(_triples(ids, len(numbers))[at], at, doc)[0] if len(at) else at
    out["n_repeat_words"] = per_doc(_covered(every, 3, total), one).astype(np.int64)
    out["dup_line_chars"] = dup_chars / safe

    mixed, sums, upto = _mix(ids), np.zeros(total, np.uint64), 0
    alive = np.arange(total)  # windows whose shorter form is repeated: only these can repeat at full length
    for n in NGRAM_LIMITS:
        alive = alive[alive + n <= ends[doc[alive]]] if len(alive) else alive
        if upto == 0:
            for k in range(n if total >= n else 0):
                sums[: total - k] = sums[: total - k] * BASE + mixed[k:]
        else:
            for k in range(upto, n):
                sums[alive] = sums[alive] * BASE + mixed[alive + k]
        upto = n
        alive, later = _pairs_alike(sums[alive], alive, doc) if len(alive) else (alive, alive)
        out[f"dup_{n}gram_chars"] = per_doc(_covered(later, n, total), chars) / safe
    return out


def judge(f: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Add ``base_failed`` and ``kept`` to the features."""
    base_failed = (f["n_words"] < MIN_WORDS) | (f["n_repeat_words"] > MAX_REPEATED * f["n_words"])
    bad = base_failed | (f["dup_line_chars"] > LINE_CHARS_LIMIT)
    for n, limit in NGRAM_LIMITS.items():
        bad = bad | (f[f"dup_{n}gram_chars"] > limit)
    return f | {"base_failed": base_failed, "kept": ~bad}


def quality(docs: DataFrame, text: str = "text", carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The carried columns, the repetition features, ``base_failed`` and ``kept`` for every row."""
    return map_texts(docs, text, carry, lambda texts: list(judge(measure(texts)).values()), SCHEMA)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    return keep_rows(docs, text, lambda texts: judge(measure(texts))["kept"])
