"""Benchmark decontamination: suffix arrays over shards of the documents, searched with every benchmark suffix.

A shard is a slice of documents inside a Spark partition.  Its words become numbers of the benchmark's vocabulary;
any other word ends a run.  Only runs long enough to hold a window are indexed: their suffixes are sorted by prefix
doubling, and every benchmark suffix is binary-searched for its longest verbatim match and all its locations.  The
documents are read once and never shuffled.  The benchmark is cut into blocks of bounded size by a hash of its rows;
each block is one pass in a chain, so a block is the only thing that is sent to all executors.

Defined results: a null or wordless document has no words, no hits and is not contaminated; a null or wordless item
has no windows; a null item_id stands for the empty string; several rows with one item_id are one item with all
their windows; an empty benchmark contaminates nothing; repeated documents are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.batches import map_texts

WINDOW = 13
# The benchmark is searched in blocks of about this many bytes.
BLOCK_BYTES = 8 << 20
# Lower-case A-Z, keep a-z, 0-9 and all bytes beyond ASCII; everything else parts words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                for c in range(256))
STATE = "n_words long, hits array<struct<start: int, end: int>>, items array<string>, longest long"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(LETTERS).split() if text else []


class Block:
    """The suffixes and windows of one block of benchmark items."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        ids, starts, lengths, names = [], [], [], []
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            width = min(window, len(words))
            first = len(ids)
            ids += [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            ids.append(0)
            starts += range(first, first + len(words) - width + 1)
            lengths += [width] * (len(words) - width + 1)
            names += [name] * (len(words) - width + 1)
        self.ids = np.array(ids + [0], np.int64)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        self.names = names
        self.shortest = int(self.lengths.min()) if names else window


def suffix_array(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``at`` sorted by the suffixes that begin there; a suffix ends before the next 0.  By prefix doubling."""
    place = np.full(len(ids) + 1, -1, np.int64)
    place[at] = np.arange(len(at))
    left = run_lengths(ids)[at]
    rank = np.unique(ids[at], return_inverse=True)[1].astype(np.int64) + 1
    step, groups = 1, -1
    while groups != (found := int(rank.max(initial=0))) and found < len(at):
        groups = found
        nxt = place[np.minimum(at + step, len(ids))]
        second = np.where(nxt >= 0, rank[nxt], 0)
        second[left <= step] = 0  # beyond the end of the run
        rank = np.unique(rank * (len(at) + 1) + second, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return at[np.argsort(rank, kind="stable")]


def run_lengths(ids: np.ndarray) -> np.ndarray:
    """For every place the number of places up to the next 0."""
    zero = np.flatnonzero(ids == 0)
    edges = np.append(zero, len(ids))
    return edges[np.searchsorted(zero, np.arange(len(ids)))] - np.arange(len(ids))


def _matched(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of a[i:] and b[j:], each at most ``most`` long; both arrays end in 0."""
    length = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        live = live[length[live] < most[live]]
        x, y = a[i[live] + length[live]], b[j[live] + length[live]]
        live = live[(x == y) & (x > 0)]
        length[live] += 1
    return length


def _lower(text, sa, query, at, most, after: bool) -> np.ndarray:
    """Binary search: the first suffix not below (``after``: above) the first ``most`` words of each query suffix."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(sa), np.int64)
    while len(live := np.flatnonzero(low < high)):
        mid = (low[live] + high[live]) // 2
        place = sa[mid]
        same = _matched(text, place, query, at[live], most[live])
        full = same == most[live]
        inside = ~full
        below = np.zeros(len(live), bool)
        below[inside] = text[place[inside] + same[inside]] < query[at[live][inside] + same[inside]]
        below |= full & after
        low[live] = np.where(below, mid + 1, low[live])
        high[live] = np.where(below, high[live], mid)
    return low


def search(block: Block, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of the block's windows in a shard.

    Returns ``first, last, sa`` (window w occurs at ``sa[first[w]:last[w]]``), and per window the length and a
    location of the longest verbatim match of its suffix.  ``ids`` must end in 0.
    """
    run = run_lengths(ids)
    begins = np.flatnonzero((ids > 0) & (np.concatenate(([0], ids[:-1])) == 0))
    wide = begins[run[begins] >= block.shortest]
    at = np.flatnonzero(np.repeat(run[begins] >= block.shortest, run[begins])) if len(wide) else wide
    at = np.flatnonzero(ids > 0)[at] if len(wide) else wide
    sa = suffix_array(ids, at) if len(at) else at
    none = np.zeros(len(block.starts), np.int64)
    if not len(sa) or not len(none):
        return none, none, sa, none, none
    whole = run_lengths(block.ids)[block.starts]
    near = _lower(ids, sa, block.ids, block.starts, whole, False)
    longest, where = none.copy(), none.copy()
    for step in (-1, 0):
        beside = np.clip(near + step, 0, len(sa) - 1)
        length = _matched(ids, sa[beside], block.ids, block.starts, whole)
        better = length > longest
        longest[better], where[better] = length[better], sa[beside][better]
    hit = np.flatnonzero(longest >= block.lengths)
    first, last = none.copy(), none.copy()
    for out, after in ((first, False), (last, True)):
        out[hit] = _lower(ids, sa, block.ids, block.starts[hit], block.lengths[hit], after)
    return first, last, sa, longest, where


def shard_ids(block: Block, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word numbers of a slice with a 0 behind every document, each document's first place, and its words."""
    number = block.vocab.get
    ids, n_words = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = words_of(t)
        n_words[i] = len(words)
        ids += [number(w, 0) for w in words]
        ids.append(0)
    first = np.concatenate(([0], np.cumsum(n_words + 1)[:-1])) if len(texts) else n_words
    return np.array(ids + [0], np.int64), first, n_words


def scan(block: Block, texts: list) -> tuple[np.ndarray, list, list, np.ndarray]:
    """Per document: its words, hit intervals of words (start, end), sorted items and longest verbatim match."""
    ids, first, n_words = shard_ids(block, texts)
    low, high, sa, _, _ = search(block, ids)
    hits: list = [np.zeros((0, 2), np.int32)] * len(texts)
    items: list[set] = [set() for _ in texts]
    longest = np.zeros(len(texts), np.int64)
    hit = np.flatnonzero(high > low)
    if len(hit):
        edge = np.zeros(len(ids) + 1, np.int64)
        spans: dict[tuple, set] = {}
        example: dict[tuple, list] = {}
        for w in hit:
            key = (int(low[w]), int(high[w]), int(block.lengths[w]))
            spans.setdefault(key, set()).add(block.names[w])
            example.setdefault(key, []).append(w)
        whole = run_lengths(block.ids)
        for (a, b, width), found in spans.items():
            places = sa[a:b]
            np.add.at(edge, places, 1)
            np.add.at(edge, places + width, -1)
            docs = np.searchsorted(first, places, side="right") - 1
            for d in np.unique(docs):
                items[d] |= found
            for start in np.unique(block.starts[example[a, b, width]]):
                far = _matched(ids, places, block.ids, np.full(len(places), start),
                               np.full(len(places), whole[start]))
                np.maximum.at(longest, docs, far)
        mark = np.diff(np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0])))
        begin, end = np.flatnonzero(mark == 1), np.flatnonzero(mark == -1)
        docs = np.searchsorted(first, begin, side="right") - 1
        for d in np.unique(docs):
            mine = docs == d
            hits[d] = np.stack((begin[mine] - first[d], end[mine] - first[d]), 1).astype(np.int32)
    return n_words, hits, [sorted(i) for i in items], longest


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> tuple[int, Iterator[list]]:
    """The number of blocks, and their rows one block at a time."""
    rows = benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("i"),
                            F.col(f"`{text}`").cast("string").alias("t")).where("t is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    number = F.pmod(F.xxhash64("i", "t"), F.lit(count))
    return count, ([(r.i, r.t.encode()) for r in rows.where(number == b).collect()] for b in range(count))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", carry: Iterable[str] = ("doc_id",),
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every row of ``docs`` the carried columns and ``n_words, n_hit, n_items, items_sha256, contaminated,
    longest_match, items, hits`` (intervals of word numbers, the end exclusive).

    A document is contaminated if at least a twentieth of its words lie in occurrences of benchmark windows.
    """
    carry = list(carry)
    names = [f"_k{i}" for i in range(len(carry))]
    state = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)],
                        F.col(f"`{text}`").cast("string").alias("_text"))
    count, blocks = _blocks(benchmark, item, item_text, block_bytes)
    made: list[list[str]] = []
    for rows in blocks:
        sent = docs.sparkSession.sparkContext.broadcast(Block(sorted(rows), window))

        def compute(texts: list, sent=sent) -> list:
            n_words, hits, items, longest = scan(sent.value, texts)
            return [n_words, [[{"start": a, "end": b} for a, b in h.tolist()] for h in hits], items, longest]

        kept = [*names, *[c for m in made for c in m]] + ["_text"] * (len(made) + 1 < count)
        made.append([f"{c}{len(made)}" for c in ("_words", "_hits", "_items", "_longest")])
        state = map_texts(state, "_text", kept, compute, STATE).toDF(*kept, *made[-1])
    hits = F.array_sort(F.flatten(F.array(*[m[1] for m in made])))
    # the words in the union of the intervals, which come by their starts
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["reach"]), F.lit(0))).alias("n"),
                                F.greatest(acc["reach"], x["end"]).alias("reach")), lambda acc: acc["n"])
    out = state.select(
        *names, F.col(made[0][0]).alias("n_words"), hits.alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[m[2] for m in made])))).alias("items"),
        F.greatest(*[F.col(m[3]) for m in made], F.lit(0)).alias("longest_match")).withColumn("n_hit", covered)
    return out.select(
        *names, "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256),
        (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")), "longest_match", "items", "hits",
    ).toDF(*carry, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "items", "hits")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they were."""
    cols = docs.columns
    names = [f"_c{i}" for i in range(len(cols))]
    judged = contamination(docs.toDF(*names), benchmark, names[cols.index(text)], names, **options)
    return judged.where(~F.col("contaminated")).select(*names).toDF(*cols)
