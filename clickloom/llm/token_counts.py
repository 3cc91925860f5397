"""Token counts for a word-level byte-pair vocabulary with word ends, by a whole-token shortcut.

Before the scan, every vocabulary string with a word end is put through the merges; those that come out as one token
are proven whole.  A pre-token of the text that is proven counts one, without merging.  Only the rest is merged, once
per distinct pre-token while a worker remembers it.  Texts are read once and nothing is shuffled.

Defined results: a null or empty text has no tokens; special strings inside a text count one token each, as in the
library's default; texts of any length are counted whole; repeated rows count alike.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable

import numpy as np
import regex
from pyspark.sql import DataFrame

from clickloom.llm.batches import map_texts

LIMIT = 2048
WORD_END = "</w>"
# A worker forgets the merged pre-tokens when it remembers this many; the proven ones stay.
REMEMBERED = 300_000
# Fixed values of the vocabulary's pre-tokenizer: contractions, letters, single digits, other marks.  White space is
# spelled out because the regex dialects differ on it.
WHITE = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
SCHEMA = "n_bytes long, n_tokens long, over_limit boolean"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself if printable, else the next letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Counter:
    """Counts tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Tokenizer.from_file(path).model.tokenize
        self.letters = byte_letters()
        specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.proven = self.prove(spec["model"]["vocab"])
        self.cost = _Cost(self)

    def prove(self, vocab: Iterable[str]) -> dict[str, int]:
        """The vocabulary strings, as text, that the merges turn into one token."""
        byte_of = {c: b for b, c in self.letters.items()}
        out = {}
        for piece in vocab:
            word = piece[: -len(WORD_END)]
            if not piece.endswith(WORD_END) or not word or not all(c in byte_of for c in word):
                continue
            if len(self.merges(word)) != 1:
                continue
            try:
                out[bytes(map(byte_of.__getitem__, word)).decode()] = 1
            except UnicodeDecodeError:
                pass  # part of a character: no pre-token can be this
        return out

    def merged(self, pre_token: str) -> int:
        return len(self.merges("".join(map(self.letters.__getitem__, pre_token.encode()))))

    def plain(self, text: str) -> int:
        if not text.isascii():
            # lower-casing goes letter by letter, so a final capital sigma is no exception
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return sum(map(self.cost.__getitem__, self.pre_tokens(text.lower())))

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


class _Cost(dict):
    def __init__(self, counter: Counter):
        super().__init__(counter.proven)
        self.counter = counter

    def __missing__(self, pre_token: str) -> int:
        n = self.counter.merged(pre_token)
        if len(self) > REMEMBERED:
            self.clear()
            self.update(self.counter.proven)
        if len(pre_token) <= 64:
            self[pre_token] = n
        return n


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """This process's counter for a vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", carry: Iterable[str] = ("doc_id",),
                 limit: int = LIMIT) -> DataFrame:
    """The carried columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row.

    ``vocabulary`` is a tokenizer file that every executor can read under the same path.
    """
    def compute(texts: list) -> list:
        count = counter(vocabulary).count
        n = np.array([count(t.decode("utf-8", "replace")) if t else 0 for t in texts], np.int64)
        return [np.array([len(t) if t else 0 for t in texts], np.int64), n, n > limit]

    return map_texts(docs, text, carry, compute, SCHEMA)
