"""SentencePiece encoding and decoding with N-best segmentation over the piece lattice.

The lattice of a text has an edge for every vocabulary piece that stands in it; a path's score is the sum of the
pieces' scores from the model file, and a character without a piece is one edge that becomes its UTF-8 bytes.  A
forward Viterbi pass gives every node the score of its best path from the start; these are exact heuristics for a
backward A* search, which pops the N best paths in order without touching others.

No piece crosses from a word into the white space behind it, so the lattice is cut there, and every distinct chunk is
solved once per worker: all new chunks of a slice go through one vectorised forward and backward pass.  These give the
best path and the loss of the second best one.  The N best paths of a text differ from its best one in the N - 1
chunks with the smallest losses only (any other change is no better than the N - 1 single changes there), so the A*
search runs over those chunks, all others staying as they are.

Defined results: a null text gives null ids and no alternatives; an empty text gives empty ids; a text with fewer than
N segmentations gives those it has; equal scores come in a fixed order; U+2581 in a text reads as a space, any other
text decodes to itself; texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.batches import map_texts

NBEST = 4
SPACE = "▁"
# A worker forgets its chunks when it remembers this many, or this many ids.
REMEMBERED = 400_000
REMEMBERED_IDS = 4_000_000
# Longer chunks are solved one by one.
LONG = 48
UNKNOWN_PENALTY = 10.0
_CHUNKS = re.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
_PRIME = np.uint64(0x100000001B3)
SCHEMA = ("ids array<int>, n_ids int, score double, nbest array<struct<score: double, edits: array<struct<"
          "at: int, drop: int, ids: array<int>>>>>, lossless boolean")


class Vocabulary:
    """The pieces of a model file, their scores, and lookups by hash."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = []
        self.pieces: dict[str, int] = {}
        self.score = np.array([sp.get_score(i) for i in range(size)], np.float64)
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.pieces[piece] = i
                self.raw.append(piece.replace(SPACE, " ").encode())
        inner = [p for p in self.pieces if SPACE in p[1:] and p.strip(SPACE)]
        if inner or any("\n" in p for p in self.pieces):
            raise ValueError("pieces that cross white space are not supported")
        self.longest = max(map(len, self.pieces))
        self.unknown = float(self.score[list(self.pieces.values())].min()) - UNKNOWN_PENALTY
        self.letters = {p for p in self.pieces if len(p) == 1}
        self.by_length = {}
        for n in range(1, self.longest + 1):
            some = sorted((self._hash(p), i) for p, i in self.pieces.items() if len(p) == n)
            if some:
                keys = np.array([h for h, _ in some], np.uint64)
                if len(np.unique(keys)) < len(keys):
                    raise ValueError("two pieces have one hash")
                self.by_length[n] = (keys, np.array([i for _, i in some], np.int32))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_PRIME) + (ord(c) + 1) * 0x9E3779B97F4A7C15) % (1 << 64)
        return h

    def edges(self, chunk: str) -> list[list[tuple[int, int, float]]]:
        """For every end position the edges (start, id, score), longest first; id -1 is an unknown character."""
        out: list[list[tuple[int, int, float]]] = [[]]
        for end in range(1, len(chunk) + 1):
            here = []
            for start in range(max(0, end - self.longest), end):
                i = self.pieces.get(chunk[start:end])
                if i is not None:
                    here.append((start, i, float(self.score[i])))
            if chunk[end - 1] not in self.letters:
                here.append((end - 1, -1, self.unknown))
            out.append(here)
        return out

    def spell(self, chunk: str, path: list[tuple[int, int]]) -> list[int]:
        """The ids of a path of (start, id); unknown characters as bytes."""
        out: list[int] = []
        for start, i in path:
            if i < 0:
                out += [self.byte_ids[b] for b in chunk[start].encode()]
            else:
                out.append(i)
        return out


def forward(edges: list) -> list[float]:
    """Score of the best path from the start to every position."""
    alpha = [0.0]
    for here in edges[1:]:
        alpha.append(max(alpha[start] + s for start, _, s in here))
    return alpha


def nbest_paths(lattices: list[tuple[str, list, list[float]]], n: int) -> list[tuple[float, list[list]]]:
    """The ``n`` best paths through a row of chunk lattices (chunk, edges, forward scores): (score, path per chunk).

    Backward A* search: a hypothesis is a node with the path behind it; the forward score of the node is the exact
    score of the best way to complete it, so goals are popped in order of their scores.  Of equal hypotheses the
    newest goes first, which completes a path instead of widening all of them; longer pieces are pushed last.
    """
    base = [0.0]
    for _, _, alpha in lattices:
        base.append(base[-1] + alpha[-1])
    last = len(lattices)
    count = 0
    # (minus the whole score, order, chunk, position, minus the score behind, path behind as a linked list)
    agenda = [(-base[last], 0, last - 1, len(lattices[-1][2]) - 1, 0.0, None)] if last else [(0.0, 0, -1, 0, 0.0, None)]
    done = []
    while agenda and len(done) < n:
        whole, _, at, pos, behind, path = heapq.heappop(agenda)
        while at >= 0 and pos == 0:
            at -= 1
            pos = len(lattices[at][2]) - 1 if at >= 0 else 0
        if at < 0:
            split: list[list] = [[] for _ in lattices]
            while path is not None:
                (chunk, start, i), path = path
                split[chunk].append((start, i))
            done.append((-whole, split))
            continue
        _, edges, alpha = lattices[at]
        for start, i, s in reversed(edges[pos]):
            count -= 1
            tail = behind - s
            heapq.heappush(agenda, (tail - base[at] - alpha[start], count, at, start, tail, ((at, start, i), path)))
    return done


def best_path(edges: list, alpha: list[float]) -> list[tuple[int, int]]:
    """The best path as (start, id); of equal ones that with the longest last pieces."""
    path, pos = [], len(alpha) - 1
    while pos:
        start, i, _ = next(e for e in edges[pos] if alpha[e[0]] + e[2] == alpha[pos])
        path.append((start, i))
        pos = start
    return path[::-1]


class Encoder:
    """Solves chunks once and keeps their best ids, scores and losses of the second best path."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int32)
        self.score = np.zeros(1 << 14, np.float64)
        self.loss = np.zeros(1 << 14, np.float64)
        self.lattices: dict[str, tuple] = {}

    def _store(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray, score: np.ndarray, loss: np.ndarray):
        k, m = len(self.number), len(chunks)
        while k + m > len(self.first):
            for name in ("first", "length", "score", "loss"):
                setattr(self, name, np.concatenate((getattr(self, name), np.zeros_like(getattr(self, name)))))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.first[k:k + m] = self.used + np.cumsum(lengths) - lengths
        self.length[k:k + m], self.score[k:k + m], self.loss[k:k + m] = lengths, score, loss
        self.used += len(ids)
        self.number.update(zip(chunks, range(k, k + m)))

    def learn(self, chunks: Iterable[str]) -> None:
        """Solve chunks that are not known yet."""
        by_length: dict[int, list[str]] = {}
        single = []
        known = self.vocab.letters
        for c in chunks:
            if len(c) <= LONG and known.issuperset(c):
                by_length.setdefault(len(c), []).append(c)
            else:
                single.append(c)
        for size, group in by_length.items():
            for at in range(0, len(group), 20_000):
                self._solve_all(group[at:at + 20_000], size)
        for c in single:
            self._solve_one(c)

    def _solve_one(self, chunk: str) -> None:
        edges = self.vocab.edges(chunk)
        alpha = forward(edges)
        n = len(chunk)
        beta = [-np.inf] * n + [0.0]
        for end in range(n, 0, -1):
            for start, _, s in edges[end]:
                beta[start] = max(beta[start], beta[end] + s)
        path = best_path(edges, alpha)
        chosen = set(path)
        ends = {start: end for (start, _), end in zip(path, [p[0] for p in path[1:]] + [n])}
        second = max((alpha[start] + s + beta[end] for end in range(1, n + 1) for start, i, s in edges[end]
                      if (start, i) not in chosen or ends.get(start) != end), default=-np.inf)
        ids = np.array(self.vocab.spell(chunk, path), np.int32)
        self._store([chunk], ids, np.array([len(ids)]), np.array([alpha[n]]), np.array([alpha[n] - second]))

    def _solve_all(self, chunks: list[str], size: int) -> None:
        """Forward and backward Viterbi for many chunks of one length at a time."""
        m = len(chunks)
        letters = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).reshape(m, size).T
        mixed = (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        piece, score = {}, {}
        h = np.zeros((size, m), np.uint64)
        for n in range(1, min(self.vocab.longest, size) + 1):
            h = h[:size - n + 1] * _PRIME + mixed[n - 1:]
            if n in self.vocab.by_length:
                keys, ids = self.vocab.by_length[n]
                at = np.searchsorted(keys, h).clip(0, len(keys) - 1)
                found = keys[at] == h
                piece[n] = np.where(found, ids[at], -1)
                score[n] = np.where(found, self.vocab.score[ids[at]], -np.inf)
        alpha = np.full((size + 1, m), -np.inf)
        beta = np.full((size + 1, m), -np.inf)
        back = np.zeros((size + 1, m), np.int8)
        alpha[0], beta[size] = 0.0, 0.0
        for end in range(1, size + 1):
            for n in sorted((n for n in score if n <= end), reverse=True):
                whole = alpha[end - n] + score[n][end - n]
                better = whole > alpha[end]
                alpha[end][better] = whole[better]
                back[end][better] = n
        for start in range(size - 1, -1, -1):
            for n in score:
                if start + n <= size:
                    np.maximum(beta[start], beta[start + n] + score[n][start], out=beta[start])
        best = np.full((size, m), -1, np.int32)
        pos, rows = np.full(m, size), np.arange(m)
        through = {n: alpha[:size - n + 1] + score[n] + beta[n:] for n in score}
        while len(rows):
            step = back[pos[rows], rows].astype(np.int64)
            pos[rows] -= step
            for n in np.unique(step):
                some = rows[step == n]
                best[pos[some], some] = piece[n][pos[some], some]
                through[n][pos[some], some] = -np.inf
            rows = rows[pos[rows] > 0]
        second = np.full(m, -np.inf)
        for t in through.values():
            np.maximum(second, t.max(0), out=second)
        flat = best.T
        self._store(chunks, flat[flat >= 0], (flat >= 0).sum(1), alpha[size], alpha[size] - second)

    def lattice(self, chunk: str) -> tuple[str, list, list[float]]:
        if chunk not in self.lattices:
            if len(self.lattices) > 20_000:
                self.lattices.clear()
            edges = self.vocab.edges(chunk)
            self.lattices[chunk] = (chunk, edges, forward(edges))
        return self.lattices[chunk]

    def chunks(self, text: str) -> list[str]:
        return _CHUNKS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, texts: list[str], n: int = NBEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """(ids of all texts, ids per text, score per text, alternatives per text) of a slice."""
        if len(self.number) > REMEMBERED or self.used > REMEMBERED_IDS:
            self.reset()
        split = [self.chunks(t) for t in texts]
        new = {c for s in split for c in s}.difference(self.number)
        self.learn(sorted(new))
        number = self.number.__getitem__
        at = np.fromiter((number(c) for s in split for c in s), np.int64, sum(map(len, split)))
        size = self.length[at].astype(np.int64)
        ends = np.cumsum(size)
        shift = np.repeat(self.first[at] - (ends - size), size)
        ids = self.ids[np.arange(len(shift)) + shift]
        n_ids, scores, nbest, start = np.zeros(len(texts), np.int64), np.zeros(len(texts)), [], 0
        for i, parts in enumerate(split):
            mine = slice(start, start + len(parts))
            start += len(parts)
            n_ids[i], scores[i] = size[mine].sum(), self.score[at[mine]].sum()
            nbest.append(self._alternatives(parts, self.loss[at[mine]], size[mine], scores[i], n) if parts else [])
        return ids, n_ids, scores, nbest

    def _alternatives(self, parts: list[str], loss: np.ndarray, size: np.ndarray, score: float, n: int) -> list:
        few = min(n - 1, len(loss))
        if not few:
            return []
        edge = np.partition(loss, few - 1)[few - 1]
        below = np.flatnonzero(loss < edge)
        open_at = np.sort(np.concatenate((below, np.flatnonzero(loss == edge)[:few - len(below)])))
        open_at = open_at[np.isfinite(loss[open_at])]
        lattices = [self.lattice(parts[k]) for k in open_at]
        offset = np.cumsum(size) - size
        best = [best_path(edges, alpha) for _, edges, alpha in lattices]
        total = sum(alpha[-1] for _, _, alpha in lattices)
        out = []
        for whole, paths in [f for f in nbest_paths(lattices, n) if f[1] != best][:n - 1]:
            edits = []
            for k, path, kept in zip(open_at, paths, best):
                if path != kept:
                    edits.append({"at": int(offset[k]), "drop": int(size[k]),
                                  "ids": self.vocab.spell(parts[k], path)})
            out.append({"score": float(score + whole - total), "edits": edits})
        return out

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.vocab.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a model file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, model: str, text: str = "text", carry: Iterable[str] = ("doc_id",),
           nbest: int = NBEST) -> DataFrame:
    """The carried columns and ``ids, n_ids, score, nbest, lossless`` for every row.

    ``ids`` is the best segmentation; ``nbest`` has the next ones in order, each as replacements of runs of ``ids``
    (``drop`` ids from place ``at``); ``lossless`` says that the ids decode to the text.
    """
    def compute(texts: list) -> list:
        enc = encoder(model)
        plain = [t.decode("utf-8", "replace") if t else "" for t in texts]
        ids, n_ids, scores, more = enc.encode(plain, nbest)
        ends = np.cumsum(n_ids)
        null = np.array([t is None for t in texts], bool)
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
        if null.any():
            lists = pa.array([None if gone else x for gone, x in zip(null, lists.to_pylist())], pa.list_(pa.int32()))
        same = [None if gone else enc.decode(ids[a:b].tolist()) == t
                for gone, a, b, t in zip(null, offsets[:-1], offsets[1:], plain)]
        hide = lambda v: pa.array(v, mask=null)
        return [lists, hide(n_ids.astype(np.int32)), hide(scores), more, same]

    return map_texts(docs, text, carry, compute, SCHEMA)


def alternative(ids: list[int], edits: list) -> list[int]:
    """The ids of an alternative segmentation."""
    out, at = [], 0
    for e in edits:
        out += ids[at:e["at"]]
        out += e["ids"]
        at = e["at"] + e["drop"]
    return out + ids[at:]


def decode(encoded: DataFrame, model: str, ids: str = "ids", carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and the decoded ``text``; null ids give null, ids outside the vocabulary are an error."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def text_of(column):
        return column.map(lambda x: None if x is None else encoder(model).decode(x.tolist()))

    return encoded.select(*carry, text_of(F.col(ids)).alias("text"))
