"""Stage-wise boosting over Spark ML regression trees, one round at a time.

Every round fits one tree on the rows that are not held out, to Newton targets -g/h weighted by h, so that Spark's
variance gain is the gain of the boosted loss.  Gradient and Hessian sums of the tree's leaves, one aggregate, then decide
what stays of it: splits are taken best first up to ``num_leaves``, as long as their gain with the L1 and L2 penalties
exceeds ``min_gain_to_split``, and every leaf gets its penalised Newton value.  The held-out loss is measured after each
round, and a fold stops ``patience`` rounds behind its best one.

Features are binned once; folds and trials share the table of bin numbers, a small integer per cell.  A row's margin is a
stored value plus the trees since; every ``REWRITE`` rounds the rows are written anew with their present margin, which
bounds both the trees evaluated per pass and the lineage.  Trees leave with thresholds of the raw features, in Spark ML's
own model, so scoring, storing and importance know nothing of bins.
"""

from __future__ import annotations

import json
import math
import random
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.session import Scratch

# Rounds between two writes of the margins.
REWRITE = 32
# The smallest Hessian of a row, so that targets stay finite.
LEAST_HESSIAN = 1e-6
# Relative error of the approximate quantiles that bins are cut at.
QUANTILE_ACCURACY = 2000


@dataclass
class Tree:
    """A regression tree as flat arrays; ``feature`` is -1 at leaves, the left child takes values up to ``threshold``."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    gain: list[float] = field(default_factory=list)   # of the splits, 0 at leaves
    weight: list[float] = field(default_factory=list)  # Hessian sum

    @property
    def leaves(self) -> list[int]:
        """Node numbers of the leaves from left to right, Spark's order of leaf indices."""
        out, todo = [], [0]
        while todo:
            node = todo.pop()
            if self.feature[node] < 0:
                out.append(node)
            else:
                todo += [self.right[node], self.left[node]]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Values for the rows of a matrix; a missing value goes to the right."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right, value = np.array(self.left), np.array(self.right), np.array(self.value)
        at = np.zeros(len(x), np.int64)
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            node = at[rows]
            goes = x[rows, feature[node]] <= threshold[node]
            at[rows] = np.where(goes, left[node], right[node])
            rows = rows[feature[at[rows]] >= 0]
        return value[at]


_SPLIT = re.compile(r"\s*(If|Else) \(feature (\d+) (?:<=|>) (\S+)\)")
_LEAF = re.compile(r"\s*Predict: (\S+)")


def read_tree(text: str) -> Tree:
    """A tree from Spark's description of it, with its own leaf values."""
    tree = Tree([], [], [], [], [])
    open_nodes: list[tuple[int, bool]] = []  # splits whose next child is the left, or the right one

    def add(feature: int, threshold: float, value: float) -> int:
        node = len(tree.feature)
        for column, x in ((tree.feature, feature), (tree.threshold, threshold), (tree.left, -1), (tree.right, -1),
                          (tree.value, value)):
            column.append(x)
        if open_nodes:
            parent, is_left = open_nodes[-1]
            (tree.left if is_left else tree.right)[parent] = node
        return node

    for line in text.splitlines():
        if m := _SPLIT.fullmatch(line):
            if m[1] == "If":
                open_nodes.append((add(int(m[2]), float(m[3]), 0.0), True))
            else:
                open_nodes[-1] = (open_nodes[-1][0], False)
        elif m := _LEAF.fullmatch(line):
            add(-1, 0.0, float(m[1]))
            while open_nodes and not open_nodes[-1][1]:
                open_nodes.pop()
    return tree


def shrunk(g: float, l1: float) -> float:
    return math.copysign(max(abs(g) - l1, 0.0), g)


def refitted(tree: Tree, sums: dict[int, tuple[float, float]], num_leaves: int, min_gain: float, l1: float,
             l2: float) -> Tree:
    """The part of a tree that penalised gains keep, with Newton values in log-odds.

    ``sums`` holds gradient and Hessian sums by leaf number.  Splits are opened best first; a split that does not pay
    closes its subtree.
    """
    n = len(tree.feature)
    g, h = [0.0] * n, [0.0] * n
    for i, node in enumerate(tree.leaves):
        g[node], h[node] = sums.get(i, (0.0, 0.0))
    for node in range(n - 1, -1, -1):  # children have larger numbers than their parents
        if tree.feature[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                g[node] += g[child]
                h[node] += h[child]

    def score(node: int) -> float:
        return shrunk(g[node], l1) ** 2 / max(h[node] + l2, LEAST_HESSIAN)

    def gain(node: int) -> float:
        if tree.feature[node] < 0:
            return -math.inf
        return score(tree.left[node]) + score(tree.right[node]) - score(node)

    opened, border = set(), [0]
    while len(border) < num_leaves:
        best = max(border, key=lambda x: (gain(x), -x))
        if gain(best) <= max(min_gain, 0.0):
            break
        opened.add(best)
        border.remove(best)
        border += [tree.left[best], tree.right[best]]
    out = Tree([], [], [], [], [])

    def copy(node: int) -> int:
        here = len(out.feature)
        inner = node in opened
        out.feature.append(tree.feature[node] if inner else -1)
        out.threshold.append(tree.threshold[node] if inner else 0.0)
        out.left.append(-1)
        out.right.append(-1)
        out.value.append(0.0 if inner else -shrunk(g[node], l1) / max(h[node] + l2, LEAST_HESSIAN))
        out.gain.append(gain(node) if inner else 0.0)
        out.weight.append(h[node])
        if inner:
            out.left[here] = copy(tree.left[node])
            out.right[here] = copy(tree.right[node])
        return here

    copy(0)
    return out


def _java_tree(spark: SparkSession, tree: Tree, n_features: int, scale: float, shift: float):
    """Spark ML's model of a tree, its values times ``scale`` plus ``shift``."""
    jvm = spark.sparkContext._jvm
    gateway = spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml

    def calculator(node: int):
        stats = gateway.new_array(gateway.jvm.double, 3)
        stats[0] = float(tree.weight[node]) if tree.weight else 1.0
        return jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, 1)

    def build(node: int):
        if tree.feature[node] < 0:
            return ml.tree.LeafNode(float(tree.value[node] * scale + shift), 0.0, calculator(node))
        left, right = build(tree.left[node]), build(tree.right[node])
        # importance is a node's gain times its weight
        gain = (tree.gain[node] if tree.gain else 0.0) / max(tree.weight[node] if tree.weight else 1.0, LEAST_HESSIAN)
        split = ml.tree.ContinuousSplit(int(tree.feature[node]), float(tree.threshold[node]))
        return ml.tree.InternalNode(0.0, 0.0, float(gain), left, right, split, calculator(node))

    return ml.regression.DecisionTreeRegressionModel("tree", build(0), n_features)


def _ensemble(spark: SparkSession, trees: Sequence, weights: Sequence[float], n_features: int):
    """Java models of trees as one classifier, whose raw prediction at 1 is half the log-odds."""
    gateway = spark.sparkContext._gateway
    jvm = spark.sparkContext._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    all_trees, all_weights = gateway.new_array(kind, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights)):
        all_trees[i], all_weights[i] = t, float(w)
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel("boosted", all_trees, all_weights, n_features, 2)
    return GBTClassificationModel(made)


@dataclass
class Bins:
    """Cut points of every feature; bin b holds values below cut b, the last bin the missing ones."""

    cuts: list[list[float]]

    @classmethod
    def fit(cls, data: DataFrame, features: str, n_features: int, max_bins: int) -> "Bins":
        """Approximate quantiles of all features from one aggregate; its size is features times bins."""
        if not n_features:
            return cls([])
        shares = [i / (max_bins - 1) for i in range(max_bins)]
        x = data.select(vector_to_array(features).alias("x"))
        value = lambda i: F.nanvl(F.col("x")[i], F.lit(None).cast("double"))
        row = x.agg(*[F.percentile_approx(value(i), shares, QUANTILE_ACCURACY).alias(f"q{i}") for i in range(n_features)]).first()
        return cls([sorted(set(row[i] or []))[1:] for i in range(n_features)])

    def number(self, features: str) -> Column:
        """The bin numbers of a feature vector, as an array of small integers.  A value falls in the bin of the cuts
        that it reaches; a missing one lies beyond all of them."""
        cuts = F.array(*[F.array(*[F.lit(c) for c in cs]).cast("array<double>") for cs in self.cuts])
        x = vector_to_array(features)
        return F.zip_with(x, cuts, lambda v, cs: F.when(F.isnan(v), F.size(cs) + 1).otherwise(
            F.size(F.filter(cs, lambda c: c <= v))).cast("smallint"))

    def raw(self, feature: int, threshold: float) -> float:
        """The raw threshold of a split of bin numbers: what is below the next cut goes left."""
        cuts, b = self.cuts[feature], math.floor(threshold)
        return float(np.nextafter(cuts[b], -math.inf)) if b < len(cuts) else 1.7976931348623157e308

    def unbinned(self, tree: Tree) -> Tree:
        thresholds = [self.raw(f, t) if f >= 0 else 0.0 for f, t in zip(tree.feature, tree.threshold)]
        return Tree(tree.feature, thresholds, tree.left, tree.right, tree.value, tree.gain, tree.weight)


@dataclass
class Progress:
    """What a fold has so far: trees over bin numbers with values in log-odds, and the held-out loss after each."""

    start: float = 0.0  # log-odds before the first tree
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"start": self.start, "losses": self.losses, "trees": [vars(t) for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> "Progress":
        data = json.loads(text)
        return cls(data["start"], [Tree(**t) for t in data["trees"]], data["losses"])


def best_round(losses: Sequence[float], patience: int) -> int:
    """The number of rounds with the smallest loss, looking ``patience`` rounds beyond the best so far."""
    if not any(map(math.isfinite, losses)):
        return len(losses)  # nothing is held out
    best, at = math.inf, 0
    for i, loss in enumerate(losses):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            break
    return at + 1


def stopped(losses: Sequence[float], patience: int) -> bool:
    """Whether the best round lies ``patience`` rounds back."""
    return any(map(math.isfinite, losses)) and len(losses) - best_round(losses, patience) >= patience


class Boosting:
    """The rounds of one fold over a binned table with the columns ``key``, ``label``, ``bins`` and, where given,
    ``weight``.  ``held`` says which rows are held out.
    """

    def __init__(self, table: DataFrame, held: Column, n_features: int, params, key: str, label: str,
                 weight: str | None = None, progress: Progress | None = None):
        self.spark, self.params, self.n_features = table.sparkSession, params, n_features
        self.progress = progress or Progress()
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        self.rows = table.select(F.col(label).cast("double").alias("_t"), w.alias("_w"), F.xxhash64(key).alias("_id"),
                                 F.coalesce(held, F.lit(False)).alias("_held"), "bins")
        self.scratch: Scratch | None = None
        if not self.progress.trees:
            total = self.rows.where("not _held").agg(F.sum(F.col("_t") * F.col("_w")), F.sum("_w")).first()
            share = (total[0] or 0.0) / total[1] if total[1] else 0.5
            share = min(max(share, 1e-6), 1 - 1e-6)
            self.progress.start = math.log(share / (1 - share))
        self.rows = self.rows.withColumn("_stored", F.lit(self.progress.start))
        # Java models of the trees that the stored margin lacks, over bin numbers
        self.recent = [self._java(t) for t in self.progress.trees]

    def _java(self, tree: Tree):
        # half the log-odds, as the classifier's raw prediction is
        return _java_tree(self.spark, tree, self.n_features, 0.5, 0.0)

    def _scored(self) -> DataFrame:
        """The rows with ``features`` and ``_m``, the log-odds so far."""
        rows = self.rows.withColumn("features", array_to_vector(F.col("bins").cast("array<double>")))
        if not self.recent:
            return rows.withColumn("_m", F.col("_stored"))
        model = _ensemble(self.spark, self.recent, [self.params.learning_rate] * len(self.recent), self.n_features)
        model.setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("")
        return model.transform(rows).withColumn(
            "_m", F.col("_stored") + 2.0 * vector_to_array("_raw").getItem(1)).drop("_raw")

    def _rewrite(self) -> None:
        old, self.scratch = self.scratch, Scratch(self.spark)
        self.rows = self.scratch.keep(self._scored().select("_t", "_w", "_id", "_held", "bins", F.col("_m").alias("_stored")))
        self.recent = []
        if old:
            old.close()

    def close(self) -> None:
        if self.scratch:
            self.scratch.close()
            self.scratch = None

    def loss(self) -> float:
        """Weighted mean log-loss of the held-out rows; NaN without any."""
        m = F.when(F.col("_t") > 0.5, F.col("_m")).otherwise(-F.col("_m"))
        # log(1 + exp(-m)) without overflow
        each = F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))
        row = self._scored().where("_held").agg(F.sum(each * F.col("_w")), F.sum("_w")).first()
        return row[0] / row[1] if row[1] else math.nan

    def _features(self, at: int) -> list[int]:
        """The features that the tree of a round may use."""
        n = max(1, round(self.n_features * self.params.feature_fraction))
        return sorted(random.Random(f"{self.params.seed}|{at}").sample(range(self.n_features), min(n, self.n_features)))

    def boost(self) -> None:
        """Fit one more tree and measure the loss."""
        if len(self.recent) >= REWRITE:
            self._rewrite()
        p, at = self.params, len(self.progress.trees)
        share = 1 / (1 + F.exp(-F.col("_m")))
        rows = self._scored().where("not _held").select(
            "features", "_w", "_id", (share - F.col("_t")).alias("_g"),
            F.greatest(share * (1 - share), F.lit(LEAST_HESSIAN)).alias("_h"))
        chosen = self._features(at)
        rows = VectorSlicer(inputCol="features", outputCol="_x", indices=chosen).transform(rows)
        bag = rows
        if p.bagging_fraction < 1:
            # a bag is drawn by a hash of the row key and stays for bagging_freq rounds
            drawn = F.xxhash64("_id", F.lit(p.seed), F.lit(at // max(p.bagging_freq, 1)))
            bag = rows.where(F.pmod(drawn, F.lit(1 << 30)) < int(p.bagging_fraction * (1 << 30)))
        fit = bag.select("_x", (-F.col("_g") / F.col("_h")).alias("_z"), (F.col("_w") * F.col("_h")).alias("_wh"))
        forest = RandomForestRegressor(
            numTrees=1, bootstrap=False, featuresCol="_x", labelCol="_z", weightCol="_wh", maxDepth=p.max_depth,
            minInstancesPerNode=p.min_data_in_leaf, maxBins=p.max_bins + 2, featureSubsetStrategy="all",
            seed=p.seed + at)
        model = forest.fit(fit).trees[0]
        model.setLeafCol("_leaf").setPredictionCol("_p")
        sums = model.transform(rows).groupBy(F.col("_leaf").cast("int").alias("leaf")).agg(
            F.sum(F.col("_w") * F.col("_g")).alias("g"), F.sum(F.col("_w") * F.col("_h")).alias("h")).collect()
        grown = read_tree(model.toDebugString)
        grown.feature = [chosen[f] if f >= 0 else f for f in grown.feature]
        tree = refitted(grown, {r["leaf"]: (r["g"], r["h"]) for r in sums}, p.num_leaves, p.min_gain_to_split,
                        p.lambda_l1, p.lambda_l2)
        self.progress.trees.append(tree)
        self.recent.append(self._java(tree))
        self.progress.losses.append(self.loss())

    def run(self, rounds: int) -> Progress:
        """Go on up to ``rounds`` in all, or until the best round lies ``patience`` back."""
        try:
            while len(self.progress.trees) < rounds and not stopped(self.progress.losses, self.params.patience):
                self.boost()
        finally:
            self.close()
        return self.progress


def classifier(spark: SparkSession, progress: Progress, bins: Bins, params, binned: bool = False) -> GBTClassificationModel:
    """The trees up to the best round, over raw features (``binned``: over bin numbers).  The first tree, of weight one,
    holds the start value."""
    keep = progress.trees[:best_round(progress.losses, params.patience)]
    n, rate = len(bins.cuts), params.learning_rate
    trees = [_java_tree(spark, t if binned else bins.unbinned(t), n, 0.5 if i else 0.5 * rate,
                        0.0 if i else 0.5 * progress.start) for i, t in enumerate(keep)]
    return _ensemble(spark, trees, [1.0] + [rate] * (len(keep) - 1), n)
