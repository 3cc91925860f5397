"""Spelling variants: words one edit apart, found by edit-distance rows that neighbours in a sorted list share.

Words are counted over the whole corpus.  Two words one edit apart, the shorter one n code points long, agree in their
first h = n // 2 code points (the edit is behind them) or in their last n - h.  So each word of n or n + 1 code points
goes to two lists, of all words with its first h and of those with its last n - h; the latter hold reversed words.  A list
longer than ``MOST`` is split by halving what its words do not share yet, up to a single code point, so lists are bounded
whatever the words are.

A list is sorted, and every word of n code points scans it: the rows of the edit matrix, three cells wide, are kept by
depth, and the next word goes on at the depth of its longest common prefix with the one before.  Once the smallest cell of
a row exceeds one, all words that share the prefix up to there are skipped at once.  All scans of a batch advance in
lock step.

A word's form is its near word with the most occurrences, if these are at least ``ratio`` times its own; roots are found
by doubling the forms' pointers.  As occurrences grow along them, there are few steps and no circles.

Defined results: a null or empty text has no words; rows with a null key count, without deletions; repeated rows count
each; a table without words gives no rows; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.batches import cuts
from clickloom.session import Scratch

RUN = "([A-Za-zÀ-ÿ]+)"
MIN_LENGTH, MIN_COUNT, RATIO, SLIP_EVERY = 6, 5, 5, 199
# The longest list that one scan goes through; a list of words with one code point left to differ is not split.
MOST = 4000
# Words of a batch of lists that are scanned in lock step.
AT_ONCE = 100_000
# Intermediate tables have about a file for so many words, not one for each shuffle partition of the corpus.
WORDS_A_FILE = 50_000
PAIRS = "word string, near string, n long, near_n long, back boolean"


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, slip_every: int = SLIP_EVERY) -> DataFrame:
    """``word, n``: the runs of letters of all texts, lower-cased, with the slips that a hash of key and run decides."""
    runs = docs.select(F.col(f"`{key}`").cast("string").alias("k"), F.explode(F.regexp_extract_all(
        F.col(f"`{text}`").cast("string"), F.lit(RUN), F.lit(1))).alias("run"))
    # a slip shortens a run, so shorter runs give no word
    runs = runs.where(F.length("run") >= min_length).select(
        "k", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    h = F.crc32(F.concat_ws(":", "k", "run"))
    at = (h % F.length("run")).cast("int")
    slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("k").isNotNull() & (h % slip_every == 0), slip).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= min_count)


def _first(words: DataFrame, min_length: int) -> DataFrame:
    """Every word in the lists of level ``m``, the length of the shorter of two near words, with ``a`` first and ``b`` last
    code points shared."""
    size = F.length("word")
    levels = F.filter(F.array(size, size - 1), lambda m: m >= min_length)
    rows = words.select("word", "n", F.explode(levels).alias("m")).withColumns({"a": F.lit(0), "b": F.lit(0)})
    return _split(rows)


def _split(rows: DataFrame) -> DataFrame:
    """Each row in two lists: with the first or with the last half of the code points that are not shared yet."""
    free = F.col("m") - F.col("a") - F.col("b")
    half = F.floor(free / 2).cast("int")
    side = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    both = F.array(side(F.col("a") + half, F.col("b")), side(F.col("a"), F.col("b") + free - half))
    return rows.select("word", "n", "m", F.explode(both).alias("s")).select(
        "word", "n", "m", "s.a", "s.b",
        F.concat_ws("|", F.substring("word", F.lit(1), F.col("s.a")),
                    F.when(F.col("s.b") > 0, F.expr("right(word, s.b)")).otherwise("")).alias("shared"))


LIST = ["m", "a", "b", "shared"]


def _lists(words: DataFrame, scratch: Scratch, min_length: int, most: int) -> Iterator[DataFrame]:
    """Tables of lists: ``back`` (reversed) and ``entries`` (word, occurrences, whether it is of the shorter length)."""
    rows = _first(words, min_length)
    while True:
        long = scratch.keep(rows.groupBy(*LIST).agg(F.count("*").alias("size")).where(
            (F.col("size") > most) & (F.col("m") - F.col("a") - F.col("b") > 1)).select(*LIST))
        more = not long.isEmpty()
        short = rows.join(long, LIST, "left_anti") if more else rows
        back = F.col("a") == 0
        entry = F.struct(F.when(back, F.reverse("word")).otherwise(F.col("word")).alias("w"), F.col("n").alias("n"),
                         (F.length("word") == F.col("m")).alias("short"))
        yield short.groupBy(*LIST).agg(F.sort_array(F.collect_list(entry)).alias("entries")).where(
            (F.size("entries") > 1) & F.exists("entries", lambda x: x["short"])).select(back.alias("back"), "entries")
        if not more:
            return
        rows = scratch.keep(_split(rows.join(long, LIST, "left_semi")))


class Lists:
    """Sorted lists of words in one row of code points, with what neighbours share."""

    def __init__(self, words: list[str], sizes: np.ndarray):
        self.length = np.array([len(w) for w in words], np.int64)
        # two places behind each word that equal no code point
        code = np.frombuffer("".join(w + "\0\0" for w in words).encode("utf-32-le"), np.uint32)
        self.code = code.astype(np.int64)
        self.start = np.cumsum(self.length + 2) - self.length - 2
        self.list_end = np.repeat(np.cumsum(sizes), sizes)
        first = np.concatenate([[True], self.list_end[1:] != self.list_end[:-1]])
        self.common = self._common(first)
        self.until = self._until()

    def _common(self, first: np.ndarray) -> np.ndarray:
        """The length of each word's common prefix with the word before it; 0 for the first of a list."""
        out = np.zeros(len(self.start), np.int64)
        at, depth = np.flatnonzero(~first), 0
        while len(at):
            at = at[(self.length[at] > depth) & (self.length[at - 1] > depth)]
            at = at[self.code[self.start[at] + depth] == self.code[self.start[at - 1] + depth]]
            depth += 1
            out[at] = depth
        return out

    def _until(self) -> np.ndarray:
        """For each code point of each word the first later word that does not share the prefix up to it."""
        out = np.zeros(len(self.code), np.int64)
        at, depth = np.arange(len(self.start)), 0
        while len(at := at[self.length[at] > depth]):
            breaks = np.concatenate([np.flatnonzero((np.diff(at) != 1) | (self.common[at[1:]] <= depth)), [len(at) - 1]])
            ends = at[breaks] + 1
            out[self.start[at] + depth] = ends[np.searchsorted(breaks, np.arange(len(at)))]
            depth += 1
        return out

    def scan(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, other) for each of the words ``asked`` and all words of its list at one edit; words of a list are not
        longer than those asked by more than one."""
        length = self.length[asked]
        # the rows of every scan by depth: cells for the word's prefixes one shorter, as long, one longer
        base = np.cumsum(length + 2) - length - 2
        rows = np.full((int((length + 2).sum()), 3), 2, np.int8)
        rows[base, 1], rows[base, 2] = 0, 1
        who = np.arange(len(asked))
        # scans begin with the first word of the list
        begin = np.concatenate([[0], np.flatnonzero(np.diff(self.list_end)) + 1])
        at = begin[np.searchsorted(begin, asked, side="right") - 1]
        depth = np.zeros(len(asked), np.int64)
        words, others = [], []
        while len(who):
            ended = depth == self.length[at]
            done = np.flatnonzero(ended)
            if len(done):
                w = who[done]
                cell = length[w] - self.length[at[done]] + 1
                hit = done[(rows[base[w] + depth[done], cell] == 1)]
                words.append(asked[who[hit]])
                others.append(at[hit])
            step = np.flatnonzero(~ended)
            w, d = who[step], depth[step]
            old = rows[base[w] + d].astype(np.int64)
            c = self.code[self.start[at[step]] + d]
            mine = self.start[asked[w]] + d
            differs = [(self.code[np.maximum(mine + i, 0)] != c) for i in (-1, 0, 1)]
            # cells beyond the word's end stay too large
            beyond = [d + 1 > length[w], d + 2 > length[w]]
            low = np.minimum(old[:, 0] + differs[0], old[:, 1] + 1)
            same = np.minimum(np.minimum(old[:, 1] + differs[1], old[:, 2] + 1), low + 1)
            same[beyond[0]] = 2
            high = np.minimum(old[:, 2] + differs[2], same + 1)
            high[beyond[1]] = 2
            new = np.minimum(np.column_stack([low, same, high]), 2)
            rows[base[w] + d + 1] = new
            dead = new.min(axis=1) > 1
            depth[step[~dead]] += 1
            # next word: behind the one that ended, or behind all that share the dead prefix
            move = np.concatenate([done, step[dead]])
            at[move] = np.concatenate([at[done] + 1, self.until[self.start[at[step[dead]]] + d[dead]]])
            over = np.zeros(len(who), bool)
            over[move] = at[move] >= self.list_end[asked[who[move]]]
            move = move[~over[move]]
            depth[move] = self.common[at[move]]
            who, at, depth = who[~over], at[~over], depth[~over]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(words), np.concatenate(others)


def near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of every pair at one edit of the lists in ``back, entries``."""
    for batch in batches:
        sizes = batch.column(1).value_lengths().to_numpy()
        for start, end in cuts(sizes, AT_ONCE):
            part = batch.slice(start, end - start)
            flat = part.column(1).flatten()
            word, count, short = (flat.field(i) for i in range(3))
            back = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes[start:end])
            lists = Lists(word.to_pylist(), sizes[start:end])
            a, b = lists.scan(np.flatnonzero(short.to_numpy(zero_copy_only=False)))
            # a word of the longer length does not scan
            longer = lists.length[b] > lists.length[a]
            a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
            yield pa.RecordBatch.from_arrays([word.take(pa.array(a)), word.take(pa.array(b)), count.take(pa.array(a)),
                                              count.take(pa.array(b)), pa.array(back[a])],
                                             names=["word", "near", "n", "near_n", "back"])


def _roots(words: DataFrame, scratch: Scratch, files: int) -> DataFrame:
    """``word, root`` of all words with a form."""
    pointers = scratch.keep(words.where("form is not null").select("word", F.col("form").alias("root")).coalesce(files))
    while True:
        ahead = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.keep(pointers.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).coalesce(files))
        pointers = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return pointers


def variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words`` (distinct ``word`` of at least ``min_length``
    code points without U+0000, and its occurrences ``n``)."""
    scratch = Scratch(words.sparkSession)
    words = scratch.keep(words.select("word", "n"))
    files = max(1, -(-words.count() // WORDS_A_FILE))
    found = None
    for lists in _lists(words, scratch, min_length, most):
        pairs = scratch.keep(lists.coalesce(files).mapInArrow(near_pairs, PAIRS))
        found = pairs if found is None else found.unionByName(pairs)
    straight: Column = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(c)
    # a pair may share both halves, and so stand in two lists
    pairs = found.select(straight("word"), straight("near"), "n", "near_n").distinct()
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    joined = words.join(best, "word", "left").withColumn("most", -F.col("best.less"))
    formed = F.col("most") >= ratio * F.col("n")
    named = scratch.keep(joined.select(
        "word", F.when(formed, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("most")).alias("form_n")).coalesce(files))
    return named.join(_roots(named, scratch, files), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
