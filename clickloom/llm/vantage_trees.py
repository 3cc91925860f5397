"""Nearest neighbours by inner product: a vantage-point tree per shard, pruned by a relaxed triangle inequality.

Largest inner product is made a metric search: with M the largest norm, every vector x gets one more coordinate
sqrt(M^2 - |x|^2), every query is scaled to norm M and gets 0, and the squared distance is 2 M^2 - 2 q.x, smallest where
q.x is largest.  A node of a tree holds a vantage point and the range of distances of each half.  With t the distance of
a query's k-th best so far, a half is left out if its lower bound times ``factor`` exceeds t: ``factor`` 1 is exact
search, more prunes more.

1. Equal vectors become one class with its smallest k + 1 keys, found by a rank that is cut before the shuffle, so a
   vector that holds a third of the table is one entry.
2. Classes are dealt to shards of bounded size by a hash, queries to chunks; a pair (shard, chunk) is a group of rows in
   which the shard's classes come first.  A task reads its rows in order: it builds the tree, then streams the queries
   through it in slices, so it holds one shard and one slice, never all queries.
3. Every (query, shard) gives its best k + 1; these are ranked per query, and the query's own key is left out.

Scores are sums of products of the original components in double precision, from the first to the last component.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
with a null key; of rows with one key the smallest vector counts; vectors of another length are no candidates; a query
without candidates has no rows; -0.0 is 0.0.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.session import Scratch

K = 20
# Lower bounds are multiplied by this before a half is left out; the README has recall and pruning for several values.
FACTOR = 1.5
# A shard holds about this many classes, more where that makes over MANY shards, never over SHARD_BYTES.
SHARD_ROWS, MANY, SHARD_BYTES = 4096, 64, 32 << 20
CHUNK_ROWS = 4096
LEAF = 256
SLICE = 1024
FOUND = "query_id long, scores array<double>, ids array<long>"


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


class Tree:
    """A vantage-point tree over the rows of ``x``; ``first`` holds the smallest key of each row's class."""

    def __init__(self, x: np.ndarray, first: np.ndarray, leaf: int = LEAF):
        self.x, self.first = x, first
        self.scale = float(np.abs(x).max()) or 1.0
        y = x / self.scale
        square = np.einsum("ij,ij->i", y, y)
        self.norm = float(np.sqrt(square.max()))
        self.y = np.column_stack([y, np.sqrt(np.maximum(self.norm ** 2 - square, 0.0))])
        self.root = self._build(np.random.default_rng(1).permutation(len(x)), leaf)

    def _distances(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * self.norm ** 2 - 2 * (rows @ point), 0.0))

    def _build(self, at: np.ndarray, leaf: int):
        if len(at) <= leaf:
            return np.sort(at)
        vantage = self.y[at[0]]
        far = self._distances(self.y[at], vantage)
        order = np.argsort(far, kind="stable")
        half = len(at) // 2
        sides = []
        for part in (order[:half], order[half:]):
            sides.append((far[part[0]], far[part[-1]], self._build(at[part], leaf)))
        return vantage, sides

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and rows of the ``k`` best of every query, best first, ties to the smaller key; rows are -1 where there
        are fewer.  The last value is the number of (query, row) pairs that were scored."""
        return _Search(self, queries, k, factor).result()


class _Search:
    def __init__(self, tree: Tree, queries: np.ndarray, k: int, factor: float):
        self.tree, self.q, self.k, self.factor = tree, queries, k, factor
        length = np.sqrt(np.einsum("ij,ij->i", q := queries / np.abs(queries).max(axis=1, keepdims=True), q))
        self.unit = q / length[:, None] * tree.norm
        # from scores of original vectors to those of the scaled ones
        self.shrink = tree.norm / (length * np.abs(queries).max(axis=1)) / tree.scale
        self.scores = np.full((len(queries), k), -np.inf)
        self.rows = np.full((len(queries), k), -1, np.int64)
        self.pairs = 0
        self.slack = 1e-7 * tree.norm
        # rounding of a matrix product against a sum in order
        self.rounding = 1e-12 * np.abs(queries).max(axis=1) * tree.scale * queries.shape[1]

    def result(self) -> tuple[np.ndarray, np.ndarray, int]:
        self._visit(self.tree.root, np.arange(len(self.q)))
        return self.scores, self.rows, self.pairs

    def _visit(self, node, at: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, np.ndarray):
            self._score(node, at)
            return
        vantage, sides = node
        away = self.tree._distances(self.unit[at], vantage[:-1])
        least = [np.maximum(np.maximum(away - high, low - away), 0.0) for low, high, _ in sides]
        inner = least[0] <= least[1]
        self._visit(sides[0][2], at[inner])
        self._visit(sides[1][2], at[~inner])
        for side, rest in ((1, inner), (0, ~inner)):
            kth = self.scores[at, self.k - 1] * self.shrink[at]
            reach = np.sqrt(np.maximum(2 * self.tree.norm ** 2 - 2 * kth, 0.0))
            self._visit(sides[side][2], at[rest & (least[side] * self.factor <= reach + self.slack)])

    def _score(self, node: np.ndarray, at: np.ndarray) -> None:
        """Merge the rows of a leaf into the lists of the queries ``at``."""
        x, k = self.tree.x[node], self.k
        self.pairs += len(at) * len(node)
        near = self.q[at] @ x.T
        limit = self.scores[at, k - 1]
        if len(node) > k:
            limit = np.maximum(limit, np.partition(near, len(node) - k, axis=1)[:, len(node) - k])
        who, which = np.nonzero(near >= (limit - self.rounding[at])[:, None])
        if not len(who):
            return
        here = np.unique(who)
        slot = np.full(len(at), -1)
        slot[here] = np.arange(len(here))
        old = at[here]
        score = np.concatenate([self.scores[old].ravel(), in_order(self.q[at[who]], x[which])])
        row = np.concatenate([self.rows[old].ravel(), node[which]])
        owner = np.concatenate([np.repeat(np.arange(len(here)), k), slot[who]])
        order = np.lexsort((np.where(row < 0, np.iinfo(np.int64).max, self.tree.first[row]), -score, owner))
        owner, score, row = owner[order], score[order], row[order]
        start = np.searchsorted(owner, np.arange(len(here)))
        best = start[:, None] + np.arange(k)  # every query has at least the k places that it had
        self.scores[old], self.rows[old] = score[best], row[best]


def _answers(tree: Tree, ids: pa.Array, query_ids: np.ndarray, queries: np.ndarray, k: int,
             factor: float) -> pa.RecordBatch:
    """The best ``k`` keys of every query, of the classes of its best ``k`` rows."""
    scores, rows, _ = tree.search(queries, k, factor)
    offsets = ids.offsets.to_numpy()
    values = ids.values.to_numpy()
    who, place = np.nonzero(rows >= 0)
    row, score = rows[who, place], scores[who, place]
    counts = offsets[row + 1] - offsets[row]
    upto = np.cumsum(counts)
    spread = np.repeat(np.arange(len(row)), counts)
    key = values[np.repeat(offsets[row], counts) + np.arange(len(spread)) - np.repeat(upto - counts, counts)]
    who, score = who[spread], score[spread]
    order = np.lexsort((key, -score, who))
    who, score, key = who[order], score[order], key[order]
    kept = np.arange(len(who)) - np.searchsorted(who, who) < k
    who, score, key = who[kept], score[kept], key[kept]
    ends = np.searchsorted(who, np.arange(len(query_ids) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids), pa.ListArray.from_arrays(ends, pa.array(score)),
         pa.ListArray.from_arrays(ends, pa.array(key))], names=["query_id", "scores", "ids"])


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    return vectors.flatten().to_numpy().reshape(len(vectors), -1)


def _stream(k: int, factor: float):
    """A function over the rows of a partition, sorted by group, a group's classes before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, tree, ids = None, [], None, None
        for batch in batches:
            keys = np.column_stack([batch.column(i).to_numpy() for i in range(4)])  # dim, shard, chunk, is a query
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                if not end:
                    continue
                *this, is_query = keys[start].tolist()
                if this != group:
                    group, parts, tree, ids = this, [], None, None
                rows = batch.slice(start, end - start)
                if not is_query:
                    parts.append(rows)
                    continue
                if tree is None:
                    if not parts:
                        continue  # a shard without classes
                    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    ids = pa.concat_arrays([whole.column(4)])
                    first = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1]]
                    tree, parts = Tree(_matrix(whole.column(5)), first), []
                for s in range(0, len(rows), SLICE):
                    some = rows.slice(s, SLICE)
                    yield _answers(tree, ids, some.column(4).flatten().to_numpy(), _matrix(some.column(5)), k, factor)

    return run


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, x`` of the rows that take part: one per key, finite, not zero, as doubles."""
    # adding 0.0 makes -0.0 the same as 0.0
    x = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda v: v + F.lit(0.0))
    rows = rows.select(F.col(f"`{key}`").cast("long").alias("id"), x.alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull())
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    # a comparison with a null component is null, so the order matters
    rows = rows.where(F.coalesce(finite, F.lit(False))).where(F.exists("x", lambda v: v != 0))
    return rows.groupBy("id").agg(F.min("x").alias("x"))


def nearest(base: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K,
            factor: float = FACTOR) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``base`` with the largest inner product for every row of
    ``queries``, other than the one with its key; nearest first, ties to the smaller key."""
    scratch = Scratch(base.sparkSession)
    # of a vector's keys, k + 1 are enough for any query, its own included
    order = Window.partitionBy("x").orderBy("id")
    classes = scratch.keep(usable(base, key, vector).withColumn("r", F.row_number().over(order)).where(
        F.col("r") <= k + 1).groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn(
        "dim", F.size("x")))
    asked = scratch.keep(usable(queries, key, vector).withColumn("dim", F.size("x")))
    rows, q = F.col("rows"), F.col("q")
    sizes = scratch.keep(classes.groupBy("dim").agg(F.count("*").alias("rows")).join(
        asked.groupBy("dim").agg(F.count("*").alias("q")), "dim").select(
        "dim", F.greatest(F.ceil(rows * F.col("dim") * 8 / SHARD_BYTES),
                          F.least(F.lit(MANY), F.ceil(rows / SHARD_ROWS))).alias("shards"),
        F.ceil(q / CHUNK_ROWS).alias("chunks")))
    groups = sizes.agg(F.coalesce(F.sum(F.col("shards") * F.col("chunks")), F.lit(0))).first()[0]
    if not groups:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = classes.join(sizes, "dim").select(
        F.col("dim").cast("long"), F.pmod(F.xxhash64("x"), F.col("shards")).alias("shard"),
        every("chunks").alias("chunk"), F.lit(0).cast("long").alias("side"), "ids", "x")
    right = asked.join(sizes, "dim").select(
        F.col("dim").cast("long"), every("shards").alias("shard"),
        F.pmod(F.xxhash64("id"), F.col("chunks")).alias("chunk"), F.lit(1).cast("long").alias("side"),
        F.array("id").alias("ids"), "x")
    met = left.unionByName(right).repartition(int(groups), "dim", "shard", "chunk").sortWithinPartitions(
        "dim", "shard", "chunk", "side")
    found = met.mapInArrow(_stream(k + 1, factor), FOUND).select(
        "query_id", F.explode(F.arrays_zip("scores", "ids")).alias("f")).select(
        "query_id", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score")).where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
