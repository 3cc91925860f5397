"""Stage-wise boosting: trees and leaf values against NumPy, stopping, resuming, successive halving."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import boosting
from clickloom.operators import train as T
from clickloom.operators.boosting import Bins, Progress, Tree, read_tree, refitted

PARAMS = T.BoostParams(learning_rate=0.3, max_depth=3, min_data_in_leaf=5, rounds=6, max_bins=16, bagging_fraction=1.0,
                       feature_fraction=1.0, patience=50)


@pytest.fixture(scope="module")
def rows(spark):
    """Labels that depend on x and z, with noise, holes in z, and a weight."""
    i = F.col("row_idx")
    noise = F.pmod(F.xxhash64(i, F.lit(1)), F.lit(100))
    x, z = F.pmod(F.xxhash64(i, F.lit(2)), F.lit(40)).cast("double"), F.pmod(F.xxhash64(i, F.lit(3)), F.lit(9)).cast("double")
    return spark.range(1500).withColumnRenamed("id", "row_idx").select(
        "row_idx", ((x + 3 * z + noise / 3 > 50) | (noise > 95)).cast("int").alias("clicked"), x.alias("x"),
        F.when(i % 7 != 0, z).alias("z"), (1 + i % 3).cast("double").alias("w"), (i % 3).cast("int").alias("part")).persist()


@pytest.fixture(scope="module")
def data(rows):
    return T.binned(rows, "part", 16, weight="w")


def collected(data):
    got = data.table.orderBy("row_idx").collect()
    return (np.array([r["bins"] for r in got], float), np.array([r["clicked"] for r in got], float),
            np.array([r["w"] for r in got]), np.array([r["part"] for r in got]))


def newton(g, h, l1, l2):
    return -math.copysign(max(abs(g) - l1, 0), g) / (h + l2)


def test_bins_follow_the_raw_values(rows, data):
    bins = data.bins
    assert bins.cuts[0] == sorted(set(bins.cuts[0])) and len(bins.cuts[0]) <= 15 and bins.cuts[1] == [float(i) for i in range(1, 9)]
    raw = data.assembler.transform(rows, ["row_idx"]).orderBy("row_idx").collect()
    x = np.array([r["features"].toArray() for r in raw])
    numbers = collected(data)[0]
    for f, cuts in enumerate(bins.cuts):
        assert (np.searchsorted(cuts, x[:, f], side="right") == numbers[:, f]).all()
        for b in range(len(cuts)):
            assert ((x[:, f] <= bins.raw(f, b + 0.5)) == (numbers[:, f] <= b)).all()


def test_missing_values_are_the_last_bin(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([v]),) for v in (1.0, 2.0, float("nan"))], ["features"])
    bins = Bins.fit(df, "features", 1, 8)
    got = [r[0][0] for r in df.select(bins.number("features").alias("b")).collect()]
    assert bins.cuts == [[2.0]] and got == [0, 1, 2]
    tree = bins.unbinned(Tree([0, -1, -1], [1.5, 0, 0], [1, -1, -1], [2, -1, -1], [0, 1.0, 2.0]))
    assert tree.predict(np.array([[1.0], [1e300], [math.nan]])).tolist() == [1.0, 1.0, 2.0]


@pytest.mark.parametrize("l1, l2, leaves", [(0.0, 0.0, 64), (2.0, 5.0, 64), (0.0, 1.0, 3)])
def test_every_round_equals_a_numpy_recomputation(data, l1, l2, leaves):
    params = replace(PARAMS, lambda_l1=l1, lambda_l2=l2, num_leaves=leaves)
    made = data.boost(params, [1])[0]
    x, y, w, part = collected(data)
    held = part == 1
    share = (y * w)[~held].sum() / w[~held].sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    assert made.start == pytest.approx(margin[0]) and len(made.trees) == 6
    for tree, loss in zip(made.trees, made.losses):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        # which leaf a row is in, by a tree whose values are its node numbers
        at = Tree(tree.feature, tree.threshold, tree.left, tree.right, list(range(len(tree.value)))).predict(x)
        assert len(tree.leaves) <= leaves
        for leaf in tree.leaves:
            mine = ~held & (at == leaf)
            assert mine.sum() >= params.min_data_in_leaf
            assert tree.value[leaf] == pytest.approx(newton(g[mine].sum(), h[mine].sum(), l1, l2), abs=1e-9)
        if leaves > 8:  # the first split is the best one of all bins
            score = lambda s: max(abs(g[s].sum()) - l1, 0) ** 2 / (h[s].sum() + l2)  # noqa: E731, B023
            if l1 == l2 == 0:
                best = max(score(~held & (x[:, f] <= b)) + score(~held & (x[:, f] > b)) for f in range(x.shape[1])
                           for b in range(16) if min((~held & (x[:, f] <= b)).sum(), (~held & (x[:, f] > b)).sum()) >= 5)
                assert tree.gain[0] == pytest.approx(best - score(~held), rel=1e-6)
        margin = margin + params.learning_rate * tree.predict(x)
        p = 1 / (1 + np.exp(-margin[held]))
        each = -np.where(y[held] == 1, np.log(p), np.log(1 - p))
        assert loss == pytest.approx((each * w[held]).sum() / w[held].sum(), abs=1e-9)


def test_raw_model_and_binned_model_score_alike(rows, data, monkeypatch):
    monkeypatch.setattr(boosting, "REWRITE", 2)  # margins are written anew along the way
    made = data.boost(PARAMS, [0, 1, 2])
    whole = T.FoldModels(data.models(made, PARAMS), data.assembler)
    raw = {r["row_idx"]: r["raw_pred"] for r in T.FoldModels(whole.models[:1], data.assembler).score(rows, ["row_idx"]).collect()}
    held = {r["row_idx"]: r["raw_pred"] for r in data.held_scores(made, PARAMS).where("fold = 0").collect()}
    assert held and held == pytest.approx({k: raw[k] for k in held})
    x, _, _, part = collected(data)
    margin = made[0].start + 0.3 * sum(t.predict(x) for t in made[0].trees[:T.best_round(made[0].losses, 50)])
    assert [held[i] for i in np.flatnonzero(part == 0)] == pytest.approx(list(1 / (1 + np.exp(-margin[part == 0]))))
    # with fewer trees between the writes the same trees come out
    monkeypatch.setattr(boosting, "REWRITE", 100)
    again = data.boost(PARAMS, [0])[0]
    assert again.losses == pytest.approx(made[0].losses) and again.trees[-1].feature == made[0].trees[-1].feature


def test_a_fold_stops_patience_rounds_behind_its_best(data):
    fast = replace(PARAMS, learning_rate=0.9, rounds=40, patience=2, max_depth=4)
    made = data.boost(fast, [0, 1])
    for p in made:
        best = T.best_round(p.losses, 2)
        assert len(p.trees) == len(p.losses) == best + 2 < 40
    # the rounds that were not run would not have changed the model
    longer = data.boost(replace(fast, patience=100), [0], rounds=len(made[0].trees) + 2)[0]
    assert T.best_round(longer.losses, 2) == T.best_round(made[0].losses, 2)
    assert [vars(t) for t in longer.trees[:len(made[0].trees)]] == [vars(t) for t in made[0].trees]
    assert [m.getNumTrees for m in data.models(made, fast)] == [len(p.trees) - 2 for p in made]


def test_going_on_equals_one_run(data):
    bagged = replace(PARAMS, bagging_fraction=0.7, bagging_freq=2, feature_fraction=0.5)
    whole = data.boost(bagged, [2])[0]
    half = data.boost(bagged, [2], rounds=3)[0]
    rest = data.boost(bagged, [2], progress=[Progress.from_json(half.to_json())])[0]
    assert len(rest.trees) == 6
    assert rest.losses == pytest.approx(whole.losses)
    assert [t.feature for t in rest.trees] == [t.feature for t in whole.trees]


def test_nothing_held_out_and_one_class(spark, rows):
    one = rows.select("row_idx", F.lit(0).alias("clicked"), "x", F.lit(9).alias("part"))
    data = T.binned(one, "part", 16)
    made = data.boost(replace(PARAMS, rounds=2), [0])[0]
    assert len(made.trees) == 2 and all(math.isnan(x) for x in made.losses)
    model = data.models([made], PARAMS)[0]
    assert 0 <= model.transform(data.assembler.transform(one)).first()["probability"][1] < 1e-3


def test_trees_as_text_and_their_pruning():
    text = """DecisionTreeRegressionModel: uid=t, depth=2, numNodes=5, numFeatures=2
  If (feature 0 <= 3.5)
   If (feature 1 <= 1.0E-4)
    Predict: 1.0
   Else (feature 1 > 1.0E-4)
    Predict: -2.5
  Else (feature 0 > 3.5)
   Predict: 4.0
"""
    tree = read_tree(text)
    x = np.array([[0.0, 0.0], [0.0, 1.0], [9.0, 0.0]])
    assert tree.predict(x).tolist() == [1.0, -2.5, 4.0] and [tree.value[i] for i in tree.leaves] == [1.0, -2.5, 4.0]
    sums = {0: (-6.0, 2.0), 1: (-5.0, 2.0), 2: (8.0, 4.0)}
    assert refitted(tree, sums, 64, 0.0, 0.0, 0.0).predict(x).tolist() == [3.0, 2.5, -2.0]
    assert refitted(tree, sums, 64, 1.0, 0.0, 0.0).predict(x).tolist() == [2.75, 2.75, -2.0]  # a gain of 0.25 only
    assert refitted(tree, sums, 2, 0.0, 1.0, 1.0).predict(x).tolist() == [2.0, 2.0, -1.4]
    assert refitted(tree, sums, 64, 0.0, 20.0, 0.0).predict(x).tolist() == [0.0, 0.0, 0.0]


def test_search_halves_and_resumes(rows, tmp_path, monkeypatch):
    space = {"learning_rate": ("log", 0.05, 0.6), "lambda_l1": ("log", 1e-3, 1.0), "lambda_l2": ("log", 1e-3, 10.0)}
    base = replace(PARAMS, rounds=4)
    run = []
    plain = boosting.Boosting.boost
    monkeypatch.setattr(boosting.Boosting, "boost", lambda self: (run.append(1), plain(self))[1])
    search = T.Search(str(tmp_path / "a"), trials=4, base=base, folds=2, space=space, eta=2)
    assert search.rungs() == [(4, 1), (2, 2), (1, 4)]
    best = search.run(rows)
    assert len(run) * 2 <= 4 * 2 * 4
    history = search.history(rows.sparkSession).orderBy("rounds", "trial").collect()
    assert [(r["trial"], r["rounds"]) for r in history][:4] == [(i, 1) for i in range(4)] and len(history) == 7
    assert {"lambda_l1", "lambda_l2"} <= set(history[0]["params"])
    last = next(r for r in history if r["rounds"] == 4)
    assert best == T.trial_params(base, last["trial"], space=space)
    # a search that was stopped behind the first rung, and one trial of the second
    some = rows.sparkSession.createDataFrame(history[:5], search._SCHEMA)
    some.write.parquet(str(tmp_path / "b"))
    run.clear()
    again = T.Search(str(tmp_path / "b"), trials=4, base=base, folds=2, space=space, eta=2)
    assert again.run(rows) == best and len(run) == 2 * 1 + 2 * 2
    run.clear()
    assert again.run(rows) == best and not run


def test_the_search_space_has_nine_dimensions():
    drawn = [T.trial_params(T.BoostParams(), i) for i in range(50)]
    assert len(T.SEARCH_SPACE) == 9
    assert {p.num_leaves % 32 for p in drawn} == {0} and {p.min_data_in_leaf % 100 for p in drawn} == {0}
    assert all(2 ** p.max_depth >= p.num_leaves and 1 <= p.bagging_freq <= 7 for p in drawn)
