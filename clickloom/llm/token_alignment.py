"""Cross-tokenizer alignment: groups of tokens between the byte offsets at which tokens of both vocabularies end.

A is a byte-level BPE vocabulary that encodes a space and the text, B a sentence-piece model that adds the space itself.
The token ends of a slice of texts lie on one byte axis.  Groups are found by divide and conquer: a common end near the
middle of an interval (by A tokens) is located by bisecting B's ends, nearest candidates first, and both halves are
treated alike, all intervals of a level at a time; an interval without a common end inside is a leaf, one group.

Linked are an A and a B token whose bytes overlap.  The number of documents that hold an id pair linked is counted over
the whole table: every document sends each of its pairs once, with its number of occurrences kept aside, and counts
come from partial aggregates.  Documents then sum the counts of their links: the ``FREQUENT`` most common pairs are
broadcast, so that most links never move, all others are joined through a shuffle.

A is encoded by a merger built from the file's vocabulary, which is proven to list its merges in the order of ids; texts
with very long runs without a break go to the library that the file is made for, whose time does not grow with the
square of a run.

Defined results: a null or empty text, and one whose A or B tokens do not give its bytes back, has no tokens: zeros and
an empty digest; every row is a document of its own, repeated ones included; strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

import numpy as np
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from clickloom.llm.batches import map_texts
from clickloom.session import Scratch

# So many of the most common id pairs are broadcast, at most.
FREQUENT = 1 << 17
# An id takes so many bits of a pair; a pair of ids and the number of a text in its slice fit a bigint.
ID_BITS = 20
LONG_RUN, LONG_SPACE = 1024, re.compile(r"\s{1024}")
# fixed: how a byte-level vocabulary cuts a text into words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _letters() -> dict[str, int]:
    """The character that stands for every byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Encoder of a byte-level BPE file, without special tokens; ``bytes`` holds every id's bytes."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        vocab, before = made["model"]["vocab"], made["pre_tokenizer"] or {}
        letter = _letters()
        self.bytes = [b""] * (max(self.library.get_vocab().values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(letter.__getitem__, token))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        singles = sorted(i for t, i in vocab.items() if len(t) == 1)
        ordered = singles == list(range(256)) and [vocab[a + b] for a, b in pairs] == list(range(256, 256 + len(pairs)))
        plain = made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") \
            and not before.get("add_prefix_space")
        self.fast = tiktoken.Encoding(
            "bytes", pat_str=WORDS, mergeable_ranks={self.bytes[i]: i for i in vocab.values()}, special_tokens={},
        ) if ordered and plain else None

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and max(map(len, text.split()), default=0) < LONG_RUN and not LONG_SPACE.search(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Encoder of a sentence-piece file; ``bytes`` holds every id's bytes, U+2581 as a space."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        piece = self.library.id_to_piece
        self.bytes = [bytes([int(piece(i)[3:5], 16)]) if self.library.is_byte(i) else
                      piece(i).replace("▁", " ").encode() for i in range(self.library.get_piece_size())]

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text)


def shared_cuts(a: np.ndarray, b: np.ndarray, la: np.ndarray, ha: np.ndarray, lb: np.ndarray,
                hb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``a`` and in ``b`` of their common ends inside intervals, in order.

    ``a`` and ``b`` are increasing; the ends inside interval i are ``a[la[i]:ha[i]]`` and ``b[lb[i]:hb[i]]``.
    """
    found_a, found_b = [], []
    while True:
        live = (la < ha) & (lb < hb)
        la, ha, lb, hb = la[live], ha[live], lb[live], hb[live]
        if not len(la):
            break
        middle = (la + ha) // 2
        cut_a, cut_b = np.full(len(la), -1), np.full(len(la), -1)
        left, near, width = np.arange(len(la)), 0, 1
        while len(left):
            # candidates at distances near .. near + width - 1, on both sides
            away = np.arange(near, near + width)
            probe = middle[left, None] + (np.column_stack([away, -away]).ravel() if near else away)
            inside = (probe >= la[left, None]) & (probe < ha[left, None])
            end = a[probe[inside]]
            place = np.zeros(probe.shape, np.int64)
            place[inside] = np.searchsorted(b, end)
            hit = inside
            hit[inside] = b[np.minimum(place[inside], len(b) - 1)] == end
            first = hit.argmax(axis=1)
            row = np.flatnonzero(hit[np.arange(len(left)), first])
            cut_a[left[row]], cut_b[left[row]] = probe[row, first[row]], place[row, first[row]]
            near, width = near + width, 2 * width
            left = left[cut_a[left] < 0]
            left = left[(middle[left] - near >= la[left]) | (middle[left] + near < ha[left])]
        some = cut_a >= 0
        cut_a, cut_b = cut_a[some], cut_b[some]
        found_a.append(cut_a)
        found_b.append(cut_b)
        # halves side by side, so that the intervals stay in order
        la, ha = np.column_stack([la[some], cut_a + 1]).ravel(), np.column_stack([cut_a, ha[some]]).ravel()
        lb, hb = np.column_stack([lb[some], cut_b + 1]).ravel(), np.column_stack([cut_b, hb[some]]).ravel()
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


class _Vocabularies:
    def __init__(self, byte_file: str, piece_file: str):
        self.sides = ByteTokens(byte_file), PieceTokens(piece_file)
        self.lengths = [np.array([len(x) for x in s.bytes], np.int64) for s in self.sides]
        most = max(len(s.bytes) for s in self.sides)
        if most > 1 << ID_BITS:
            raise ValueError("an id needs more bits")
        # decimal digits of every id, and a place for what stands behind it; zero bytes stand for nothing
        self.digits = np.zeros((most, 9), np.uint8)
        text = np.char.mod("%d", np.arange(most)).astype("S8")
        self.digits[:, :8] = text.view(np.uint8).reshape(most, 8)


_LOADED: dict[tuple[str, str], _Vocabularies] = {}


def vocabularies(byte_file: str, piece_file: str) -> _Vocabularies:
    """This process's encoders of two files."""
    if (byte_file, piece_file) not in _LOADED:
        _LOADED[byte_file, piece_file] = _Vocabularies(byte_file, piece_file)
    return _LOADED[byte_file, piece_file]


class Aligned:
    """A slice of texts on one byte axis: ids, ends, and the groups' last tokens on both sides."""

    def __init__(self, known: _Vocabularies, texts: list):
        self.known, counts, ids = known, ([], []), ([], [])
        for text in texts:
            made = [[], []]
            if text:
                # bytes that are no UTF-8 are replaced, so the tokens do not give them back
                spaced = text.decode("utf-8", "replace")
                made = [known.sides[0].encode(" " + spaced), known.sides[1].encode(spaced)]
                if any(b"".join(map(s.bytes.__getitem__, m)) != b" " + text for s, m in zip(known.sides, made)):
                    made = [[], []]
            for side in (0, 1):
                counts[side].append(len(made[side]))
                ids[side].extend(made[side])
        self.ids = [np.array(x, np.int64) for x in ids]
        # the tokens of text i are bounds[side][i] to bounds[side][i + 1]
        self.bounds = [np.concatenate([[0], np.cumsum(c)]).astype(np.int64) for c in counts]
        self.ends = [np.cumsum(length[x]) for length, x in zip(known.lengths, self.ids)]
        some = np.flatnonzero(np.diff(self.bounds[0]))
        edges = [x for side in self.bounds for x in (side[some], side[some + 1] - 1)]
        inner = shared_cuts(*self.ends, *edges)
        # with the texts' own ends, the last token of every group
        self.last = [np.sort(np.concatenate([c, edge])) for c, edge in zip(inner, (edges[1], edges[3]))]

    def count(self, side: int) -> np.ndarray:
        return np.diff(self.bounds[side])

    def groups(self) -> np.ndarray:
        """The number of groups of every text."""
        return np.diff(np.searchsorted(self.last[0], self.bounds[0]))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """For every link its text and its id pair: each stretch between neighbouring ends is one A and one B token."""
        size = int(self.ends[0][-1]) + 1 if len(self.ends[0]) else 0
        marks = []
        for e in self.ends:
            mark = np.zeros(size, bool)
            mark[e] = True
            marks.append(mark)
        at_end = np.flatnonzero(marks[0] | marks[1])
        # the token of a side that ends at or behind a byte: as many as end before it
        at = [(np.cumsum(m) - m)[at_end] for m in marks]
        text = np.repeat(np.arange(len(self.bounds[0]) - 1), self.count(0))[at[0]]
        return text, self.ids[0][at[0]] << ID_BITS | self.ids[1][at[1]]

    def digests(self) -> list[str]:
        """The hexadecimal digest of ``a1,a2|b1;a3|b2,b3`` of every text; empty without tokens."""
        n = [len(x) for x in self.ids]
        shown = np.empty((sum(n), 9), np.uint8)
        for side in (0, 1):
            here, other = self.last[side], self.last[1 - side]
            last = np.zeros(n[side], bool)
            last[here] = True
            group = np.cumsum(last) - last
            # A tokens come behind the other side's earlier groups, B tokens behind its own group's too
            ahead = np.concatenate([[0], other + 1])
            place = np.arange(n[side]) + ahead[group + side]
            rows = self.known.digits[self.ids[side]]
            rows[:, 8] = np.where(last, ord(";") if side else ord("|"), ord(","))
            if side:
                rows[self.bounds[1][1:][self.count(1) > 0] - 1, 8] = 0
            shown[place] = rows
        kept = shown != 0
        body = memoryview(shown[kept])
        size = np.concatenate([[0], np.cumsum(np.count_nonzero(kept, axis=1))])
        at = size[self.bounds[0] + self.bounds[1]]
        return [hashlib.sha256(body[s:e]).hexdigest() if e > s else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def align(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text",
          carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The carried columns, the ids ``a`` and ``b``, and ``a_ends``, ``b_ends``: the number of tokens up to the end of
    every group."""
    def compute(texts: list) -> list:
        made = Aligned(vocabularies(byte_file, piece_file), texts)
        out = []
        for side in (0, 1):
            bounds = made.bounds[side]
            out.append(np.split(made.ids[side], bounds[1:-1]))
            at = np.searchsorted(made.last[side], bounds)
            out.append([made.last[side][s:e] + 1 - first for s, e, first in zip(at, at[1:], bounds)])
        return [out[0], out[2], out[1], out[3]]

    return map_texts(docs, text, carry, compute,
                     "a array<long>, b array<long>, a_ends array<long>, b_ends array<long>")


MEASURED = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, "
            "times array<int>")


def measured(docs: DataFrame, byte_file: str, piece_file: str, text: str, carry: Iterable[str]) -> DataFrame:
    """The carried columns, sizes and digest of every text, its distinct id pairs and how often it holds each."""
    def compute(texts: list) -> list:
        made = Aligned(vocabularies(byte_file, piece_file), texts)
        at, pair = made.links()
        # texts in a slice are numbered from 0, so that one sort groups all their pairs
        keys, times = np.unique(at << 2 * ID_BITS | pair, return_counts=True)
        bounds = np.searchsorted(keys >> 2 * ID_BITS, np.arange(1, len(texts)))
        return [made.count(0), made.count(1), made.groups(), np.bincount(at, minlength=len(texts)), made.digests(),
                np.split(keys & (1 << 2 * ID_BITS) - 1, bounds), np.split(times.astype(np.int32), bounds)]

    return map_texts(docs, text, carry, compute, MEASURED)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, held, best``: the documents that hold each id pair linked, and whether no pair of its A id has more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("held"))
    # an A id has no more pairs than B has ids
    mine = Window.partitionBy(F.shiftright("pair", ID_BITS))
    return counts.withColumn("best", F.col("held") == F.max("held").over(mine))


def alignment_counts(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text",
                     carry: Iterable[str] = ("doc_id",), frequent: int = FREQUENT) -> DataFrame:
    """The carried columns, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    carry = list(carry)
    names = [f"_k{i}" for i in range(len(carry))]
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], F.col(f"`{text}`").alias("_text"))
    # the number of a row holds once it is written
    found = scratch.keep(measured(rows.withColumn("_row", F.monotonically_increasing_id()), byte_file, piece_file,
                                  "_text", ["_row", *names]))
    counts = scratch.keep(pair_counts(found))
    common = F.broadcast(scratch.keep(counts.orderBy(F.desc("held"), "pair").limit(frequent)))
    links = found.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "_row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("held")).alias("count_sum"))

    rare = links.join(common.select("pair"), "pair", "left_anti").join(counts, "pair")
    sums = summed(links.join(common, "pair")).unionByName(summed(rare)).groupBy("_row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.drop("pairs", "times").join(sums, "_row", "left").select(
        *names, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256").toDF(
        *carry, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
