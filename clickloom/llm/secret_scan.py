"""Secret scans: base patterns, and probabilistic automata inferred from the credentials that these label.

Grammar inference: the credentials found by a base pattern are written as format symbols, one per character (the class
of the character's run between separators, or the separator), and put into a prefix tree per label.  Tree states whose
outgoing and ending frequencies agree within a Hoeffding bound are merged, which leaves a probabilistic automaton per
label.  Credentials of every length are learned from.  A candidate is a maximal run of ``FEWEST`` or more credential
characters, however long; every one of every text is scored whole by its format likelihood against a background of
candidate symbols, and the accepted ones that overlap no base span are added.

Only the automata are fitted on a sample: at most ``SAMPLE`` distinct credentials per label and ``SAMPLE_CHARS``
characters of them, the first in the order of a hash.  Two scans of the texts; only distinct credentials are shuffled.

Defined results: a null text is empty and has no spans; offsets are code points, ends exclusive; without labelled
credentials the base spans remain; a text of any length is scanned whole; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.llm.batches import map_texts
from clickloom.session import Scratch

# Fixed patterns of the base rule: (kind, pattern, fewest characters, group that holds the credential).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [
    ("assign", re.compile(ASSIGN, re.IGNORECASE | re.ASCII), 6, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 24, 0),
]
KINDS = ["assign", "access", "hex", "learned"]
FEWEST = 6
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
RUN = re.compile(r"[A-Za-z0-9]+|[+/_.=-]")
SAMPLE, SAMPLE_CHARS = 2000, 1 << 20
# Formats whose verdict a worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 100_000, 64
# Confidence of the merge test, and the share of a label's own sample that may score below its threshold.
ALPHA = 0.01
QUANTILE = 0.01
FLOOR = 1e-4


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the base patterns, by start, then kind as listed."""
    found = []
    for order, (kind, pattern, fewest, group) in enumerate(BASE):
        for m in pattern.finditer(text):
            if len(m[group]) >= fewest:
                found.append((m.start(), order, m.end(), kind, m[group]))
    return [(start, end, kind, secret) for start, _, end, kind, secret in sorted(found)]


def symbols(token: str) -> str:
    """The format of a string: for each character the class of its run, or the separator itself."""
    if token.isalpha():
        return ("a" if token.islower() else "A" if token.isupper() else "m") * len(token)
    out = []
    for m in RUN.finditer(token):
        run = m[0]
        if not run[0].isalnum():
            out.append(run)
            continue
        digit = any(c.isdigit() for c in run)
        low, up = any("a" <= c <= "z" for c in run), any("A" <= c <= "Z" for c in run)
        if low and up:
            kind = "M" if digit else "m"
        elif low or up:
            hexed = all(c.isdigit() or c in "abcdefABCDEF" for c in run)
            kind = ("h" if hexed else "b") if digit else "a"
            kind = kind.upper() if up else kind
        else:
            kind = "9"
        out.append(kind * len(run))
    return "".join(out)


# Byte classes, one bit each: digit, a-f, other lower case, A-F, other upper case, separator.
CLASS = np.zeros(256, np.uint8)
for _bit, _chars in enumerate((b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ",
                               b"+/_.=-")):
    CLASS[list(_chars)] = 1 << _bit
SEPARATOR = 32
# The format symbol of a run by the classes it holds.
KIND = [symbols("".join(c for i, c in enumerate("0agAG") if f >> i & 1)).ljust(1)[0] for f in range(32)]


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    change = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def symbol_counts(texts: list[bytes | None]) -> Counter:
    """How often each format symbol occurs in the candidates of all texts."""
    data = np.frombuffer(b"\n".join(t or b"" for t in texts), np.uint8)
    classes = CLASS[data]
    starts, ends = _runs(classes > 0)
    short = ends - starts < FEWEST
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[short]], edge[ends[short]] = 1, -1
    classes[np.cumsum(edge[:-1], dtype=np.int8) > 0] = 0
    marks = np.bincount(data[classes == SEPARATOR], minlength=256)
    out = Counter({chr(c): int(marks[c]) for c in np.flatnonzero(marks)})
    starts, ends = _runs((classes & (SEPARATOR - 1)) > 0)
    if len(starts):
        held = np.bitwise_or.reduceat(classes, starts) & (SEPARATOR - 1)
        total = np.bincount(held, ends - starts, 32)
        for f in np.flatnonzero(total):
            out[KIND[f]] += int(total[f])
    return out


class Automaton:
    """A probabilistic automaton made by merging compatible prefix-tree states."""

    def __init__(self, samples: Iterable[str], alpha: float = ALPHA):
        self.seen, self.ended, self.next = [0], [0], [{}]
        for s in sorted(samples):
            state = 0
            for c in s:
                if c not in self.next[state]:
                    self.next[state][c] = [len(self.seen), 0]
                    self.seen.append(0)
                    self.ended.append(0)
                    self.next.append({})
                self.seen[state] += 1
                edge = self.next[state][c]
                edge[1] += 1
                state = edge[0]
            self.seen[state] += 1
            self.ended[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self._rates()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(self.ended[a], self.seen[a], self.ended[b], self.seen[b]):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if self._differ(x[1] if x else 0, self.seen[a], y[1] if y else 0, self.seen[b]):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.ended[a] += self.ended[b]
            for c, (child, n) in self.next[b].items():
                if c in self.next[a]:
                    self.next[a][c][1] += n
                    todo.append((self.next[a][c][0], child))
                else:
                    self.next[a][c] = [child, n]

    def _merge_states(self) -> None:
        kept = [0]
        while True:
            known = set(kept)
            edge = next(((s, c) for s in kept for c in sorted(self.next[s]) if self.next[s][c][0] not in known), None)
            if edge is None:
                return
            child = self.next[edge[0]][edge[1]][0]
            match = next((k for k in kept if self._compatible(k, child)), None)
            if match is None:
                kept.append(child)
            else:
                self.next[edge[0]][edge[1]][0] = match
                self._fold(match, child)

    def _rates(self) -> None:
        self.log_next = [{c: (t, math.log(n / self.seen[s])) for c, (t, n) in edges.items()}
                         for s, edges in enumerate(self.next)]
        self.log_end = [math.log(max(e / n, FLOOR)) if n else math.log(FLOOR)
                        for e, n in zip(self.ended, self.seen)]

    def score(self, s: str) -> float | None:
        """Mean log-likelihood of a format and its end, or None if no path takes it."""
        state, total = 0, 0.0
        for c in s:
            edge = self.log_next[state].get(c)
            if edge is None:
                return None
            state = edge[0]
            total += edge[1]
        return (total + self.log_end[state]) / (len(s) + 1) if self.ended[state] else None


class Grammar:
    """One automaton per label and the threshold that its own sample sets."""

    def __init__(self, labelled: dict[str, list[str]], background: Counter):
        total = sum(background.values()) + 16
        self.background = {c: math.log((n + 1) / total) for c, n in background.items()}
        self.unseen = math.log(1 / total)
        self.known: dict[str, bool] = {}
        self.parts = []
        for label in sorted(labelled):
            formats = [symbols(s) for s in labelled[label]]
            if formats:
                made = Automaton(formats)
                scores = [made.score(f) for f in formats]
                own = sorted(-math.inf if x is None else x for x in scores)
                self.parts.append((made, own[int(QUANTILE * (len(own) - 1))]))

    def accepts(self, token: str) -> bool:
        """Whether the format of a candidate is likelier under an automaton than in the background, and as likely as the
        label's own credentials.  Every candidate is scored; short formats are remembered, as most words share a few."""
        if not self.parts:
            return False
        form = symbols(token)
        verdict = self.known.get(form)
        if verdict is None:
            verdict = self._verdict(form)
            if len(form) <= REMEMBERED_CHARS and len(self.known) < REMEMBERED:
                self.known[form] = verdict
        return verdict

    def _verdict(self, form: str) -> bool:
        plain = sum(self.background.get(c, self.unseen) for c in form) / (len(form) + 1)
        return any((got := made.score(form)) is not None and got >= least and got > plain
                   for made, least in self.parts)


def learned_spans(text: str, base: list, grammar: Grammar) -> list[tuple[int, int, str, str]]:
    taken = [(a, b) for a, b, _, _ in base]
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if grammar.accepts(m[0]) and not any(x < b and a < y for x, y in taken):
            out.append((a, b, "learned", m[0]))
    return out


def _text(raw: bytes | None) -> str:
    return raw.decode("utf-8", "replace") if raw else ""


def labelled_credentials(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``label, secret`` of the base patterns over all texts; ``symbol`` rows count candidate symbols."""
    def compute(texts: list) -> list:
        found = []
        for raw in texts:
            t = _text(raw)
            found.append([{"label": kind, "secret": s, "n": 1} for _, _, kind, s in base_spans(t)])
        found[0] += [{"label": "symbol", "secret": c, "n": n} for c, n in symbol_counts(texts).items()]
        return [found]

    rows = map_texts(docs, text, [], compute, "found array<struct<label: string, secret: string, n: long>>")
    return rows.where(F.size("found") > 0).select(F.inline("found")).groupBy("label", "secret").agg(
        F.sum("n").alias("n"))


def learn(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Grammar:
    """Infer the automata from at most ``sample`` distinct credentials per label."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(labelled_credentials(docs, text))  # read once per label below
    upto = F.sum(F.length("secret").cast("long")).over(Window.partitionBy("label").orderBy(F.xxhash64("secret"), "secret"))
    parts = [found.where(F.col("label") == k).orderBy(F.xxhash64("secret"), "secret").limit(sample).withColumn(
        "upto", upto).where(F.col("upto") <= SAMPLE_CHARS).drop("upto") for k, _, _, _ in BASE]
    marks = found.where("label = 'symbol'")  # one row per format symbol
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(marks).collect()
    scratch.close()
    labelled: dict[str, list[str]] = {}
    for r in rows:
        if r.label != "symbol":
            labelled.setdefault(r.label, []).append(r.secret)
    return Grammar(labelled, Counter({r.secret: r.n for r in rows if r.label == "symbol"}))


def scan(docs: DataFrame, grammar: Grammar, text: str = "text", carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``n_assign, n_access, n_hex, n_learned, base_sha256, spans`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(grammar)

    def compute(texts: list) -> list:
        counts = np.zeros((len(texts), len(KINDS)), np.int64)
        digests, spans = [], []
        for i, raw in enumerate(texts):
            t = _text(raw)
            base = base_spans(t)
            every = sorted(base + learned_spans(t, base, sent.value), key=lambda s: (s[0], KINDS.index(s[2])))
            for s in every:
                counts[i, KINDS.index(s[2])] += 1
            show = lambda some: ",".join(f"{k}:{a}:{b}" for a, b, k, _ in some)
            digests.append(hashlib.sha256(show(base).encode()).hexdigest())
            spans.append(show(every))
        return [*counts.T, digests, spans]

    return map_texts(docs, text, carry, compute, "n_assign long, n_access long, n_hex long, n_learned long, "
                                                 "base_sha256 string, spans string")
