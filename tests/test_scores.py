"""Metrics, calibration and training."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import metrics
from clickloom.operators import train as T
from clickloom.operators.calibrate import Calibrator, isotonic_levels, temperature
from clickloom.sources.files import write_text  # noqa: F401


def table(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "clicked int, score double")


def brute_ap(y, p):
    y, p = np.asarray(y), np.asarray(p)
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp, n = y[p >= t].sum(), (p >= t).sum()
        recall = tp / y.sum()
        ap += (recall - last) * tp / n
        last = recall
    return ap


def test_tied_scores_count_together(spark):
    df = table(spark, [1, 0, 1, 0], [.9, .9, .4, .1])
    assert metrics.average_precision(df).first()["ap"] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_average_precision_on_skewed_scores(spark, limit):
    rng = np.random.default_rng(0)
    p = np.round(rng.beta(1, 30, 4000), 4)
    p[::3] = 0.02  # a third of the rows has one score
    y = rng.random(4000) < p * 3
    df = table(spark, y, p)
    for parts in (1, 13):
        got = metrics.average_precision(df.repartition(parts), one_task_rows=limit).first()["ap"]
        assert got == pytest.approx(brute_ap(y, p), abs=1e-12)
    stages = df.withColumn("stage", F.lit("a")).unionByName(
        df.withColumn("stage", F.lit("b")).withColumn("score", 1 - F.col("score")))
    got = {r["stage"]: r["ap"] for r in metrics.average_precision(stages, groups=["stage"], one_task_rows=limit).collect()}
    assert got == pytest.approx({"a": brute_ap(y, p), "b": brute_ap(y, 1 - p)}, abs=1e-12)


def test_losses(spark):
    y, p = [1, 0, 0, 0], [0.0, 0.5, 0.25, 1.0]
    row = metrics.log_losses(table(spark, y, p)).first()
    clip = np.clip(p, 1e-15, 1 - 1e-15)
    each = -np.where(np.array(y) == 1, np.log(clip), np.log(1 - clip))
    assert row["logloss"] == pytest.approx(each.mean())
    w = np.where(np.array(y) == 1, 3.0, 1.0)
    assert row["wll"] == pytest.approx((each * w).sum() / w.sum())
    # equal class weights give the same number
    half = np.where(np.array(y) == 1, 0.5 / 0.25, 0.5 / 0.75)
    assert row["wll"] == pytest.approx((each * half).sum() / half.sum())


def test_no_positives(spark):
    row = metrics.metric_bundle(table(spark, [0, 0], [0.1, 0.2])).first()
    assert row["ap"] is None and row["wll"] == pytest.approx(-(math.log(0.9) + math.log(0.8)) / 2)


def test_blended_score_of_a_published_run(spark):
    df = spark.range(1).select(metrics.blend(F.lit(0.0595474505), F.lit(1.8488106372)).alias("b"))
    assert df.first()["b"] == pytest.approx(0.2052855664, abs=1e-9)


def test_temperature(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.5,), (1.0,)], "s double")
    got = [r[0] for r in df.select(temperature(F.col("s"), 1.75)).collect()]
    assert got == pytest.approx([0.0, 1 / (1 + math.exp(math.log(4) / 1.75)), 0.5, 1.0])


def pav(x, y):
    """Pool adjacent violators over points sorted by x, ties averaged first."""
    xs = sorted(set(x))
    blocks = [[np.mean([b for a, b in zip(x, y) if a == v]), sum(a == v for a in x), [v]] for v in xs]
    i = 0
    while i < len(blocks) - 1:
        if blocks[i][0] > blocks[i + 1][0]:
            a, b = blocks[i], blocks[i + 1]
            blocks[i:i + 2] = [[(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]]]
            i = max(i - 1, 0)
        else:
            i += 1
    return {v: m for m, _, vs in blocks for v in vs}


def test_calibration(spark):
    rng = np.random.default_rng(1)
    p = np.round(rng.random(600), 2)
    y = (rng.random(600) < p ** 2).astype(int)
    df = table(spark, y, p)
    model = Calibrator().fit(df)
    # penalised logistic regression by Newton steps: unit L2 penalty on the slope, none on the intercept
    w = np.zeros(2)
    X = np.c_[p, np.ones_like(p)]
    for _ in range(50):
        q = 1 / (1 + np.exp(-X @ w))
        g = X.T @ (q - y) + np.array([w[0], 0])
        h = (X * (q * (1 - q))[:, None]).T @ X + np.diag([1.0, 0.0])
        w -= np.linalg.solve(h, g)
    s = model.summary()
    assert (s["platt_coef"][0], s["platt_intercept"][0]) == pytest.approx(tuple(w), abs=1e-4)
    iso = pav(list(p), list(y))
    out = model.transform(df.select("score").distinct()).orderBy("score").collect()
    assert [r["isotonic_pred"] for r in out] == pytest.approx([iso[r["score"]] for r in out])
    assert (s["isotonic_x_min"], s["isotonic_x_max"]) == (p.min(), p.max())
    wide = spark.createDataFrame([(-1.0,), (2.0,)], "score double")
    clipped = [r["isotonic_pred"] for r in model.transform(wide).collect()]
    assert clipped == pytest.approx([iso[p.min()], iso[p.max()]])
    stages = {r["stage"]: r for r in model.stages(df).collect()}
    assert set(stages) == {"raw", "platt", "isotonic"}
    assert stages["raw"]["ap"] == pytest.approx(stages["platt"]["ap"])


@pytest.mark.parametrize("limit, fan_in", [(10**6, 16), (100, 2), (7, 3)])
def test_isotonic_levels_from_ranges(spark, limit, fan_in):
    rng = np.random.default_rng(4)
    p = np.round(rng.random(3000), 3)
    y = (rng.random(3000) < p ** 3).astype(int)
    p[:200], y[:50] = 0.5, 1  # one heavy score
    cells = table(spark, y, p).groupBy(F.col("score").alias("_s")).agg(F.sum("clicked").alias("_y"), F.count("*").alias("_w"))
    rows = isotonic_levels(cells, limit, fan_in).orderBy("low").collect()
    want = pav(list(p), list(y))
    got = {s: r["level"] for r in rows for s in want if r["low"] <= s <= r["high"]}
    assert got == pytest.approx(want) and sum(r["low"] <= s <= r["high"] for r in rows for s in want) == len(want)
    levels = [r["level"] for r in rows]
    assert levels == sorted(set(levels)) and all(a["high"] < b["low"] for a, b in zip(rows, rows[1:]))


def test_isotonic_of_one_score_and_of_falling_labels(spark):
    one = spark.createDataFrame([(0.5, 3, 4)], "_s double, _y long, _w long")
    assert [tuple(r) for r in isotonic_levels(one).collect()] == [(0.5, 0.5, 0.75)]
    fall = spark.createDataFrame([(float(i), 9 - i, 10) for i in range(10)], "_s double, _y long, _w long")
    assert [tuple(r) for r in isotonic_levels(fall, 3, 2).collect()] == [(0.0, 9.0, 0.45)]


PARAMS = T.BoostParams(learning_rate=0.3, max_depth=3, min_data_in_leaf=2, rounds=4, max_bins=16, bagging_fraction=1.0)


@pytest.fixture(scope="module")
def learnable(spark):
    i = F.col("row_idx")
    return spark.range(1200).withColumnRenamed("id", "row_idx").select(
        "row_idx", ((i * 37) % 100 > 60).cast("int").alias("clicked"),
        F.when(i % 11 != 0, ((i * 37) % 100).cast("double")).alias("x"), (i % 13).cast("int").alias("noise"),
        F.lit("text").alias("t")).persist()


@pytest.fixture(scope="module")
def fitted(learnable):
    return T.train_folds(learnable, PARAMS, folds=3)


def test_held_out_scores(fitted, learnable):
    oof = fitted.oof.collect()
    assert sorted(r["row_idx"] for r in oof) == list(range(1200))
    assert all(0 <= r["raw_pred"] <= 1 for r in oof)
    table = {r["stage"]: r for r in T.oof_metrics(fitted.oof).collect()}
    assert set(table) == {"fold_1", "fold_2", "fold_3", "overall"} and table["overall"]["ap"] > 0.85
    again = T.train_folds(learnable, PARAMS, folds=3).oof
    assert {r["row_idx"]: r["raw_pred"] for r in again.collect()} == {r["row_idx"]: r["raw_pred"] for r in oof}


def test_ensemble_is_the_mean_and_aligns_by_name(fitted, learnable):
    test = learnable.select("noise", "x", F.col("row_idx").cast("string").alias("ID")).limit(50)
    out = T.submission(fitted, test)
    assert out.columns == ["ID", "clicked"] and out.count() == 50
    one = T.FoldModels(fitted.models[:1], fitted.assembler).score(test, ["ID"]).collect()
    singles = [T.FoldModels([m], fitted.assembler).score(test, ["ID"]).collect() for m in fitted.models]
    mean = {s[0]["ID"]: None for s in singles}
    mean = {r["ID"]: sum(x["raw_pred"] for s in singles for x in s if x["ID"] == r["ID"]) / 3 for r in one}
    assert {r["ID"]: r["clicked"] for r in out.collect()} == pytest.approx(mean)
    assert T.submission(fitted, test.drop("ID", "x")).columns == ["clicked"]


def test_best_round():
    assert T.best_round([3.0, 2.0, 2.5, 1.0, 4.0], 2) == 4
    assert T.best_round([3.0, 2.0, 2.5, 2.6, 1.0], 2) == 2
    assert T.best_round([float("nan")] * 3, 2) == 3 and T.best_round([1.0, 0.5], 9) == 2


def test_boosting_keeps_many_trees_and_cuts_behind_the_best(learnable):
    slow = T.BoostParams(learning_rate=0.05, max_depth=2, min_data_in_leaf=5, rounds=25, max_bins=16, patience=5,
                         bagging_fraction=1.0)
    many, scores = T.train_holdout(learnable, slow)
    assert many.models[0].getNumTrees > 10
    few = T.FoldModels([T.first_trees(many.models[0], 1)], many.assembler)
    assert few.models[0].getNumTrees == 1 and few.models[0].treeWeights == many.models[0].treeWeights[:1]
    held = learnable.join(scores.select("row_idx"), "row_idx", "left_semi")
    loss = {n: m.score(held, ["clicked"]).agg(F.avg(-F.log(F.when(F.col("clicked") == 1, F.col("raw_pred")).otherwise(
        1 - F.col("raw_pred"))))).first()[0] for n, m in (("many", many), ("few", few))}
    assert loss["many"] < loss["few"]
    assert T.importance(few, 1).first()["feature"] == "x"  # the cut model still knows its features
    many.release()
    assert many.kept.storageLevel.useMemory is False


def test_given_folds_are_used(learnable):
    folded = learnable.withColumn("part", (F.col("row_idx") % 2).cast("int"))
    fitted = T.train_folds(folded, PARAMS, folds=2, fold="part")
    assert {(r["row_idx"] % 2, r["fold"]) for r in fitted.oof.collect()} == {(0, 0), (1, 1)}
    fitted.release()


def test_models_round_trip(spark, fitted, learnable, tmp_path):
    fitted.save(str(tmp_path / "m"))
    again = T.load_models(spark, str(tmp_path / "m"), 3)
    a, b = (m.score(learnable, ["row_idx"]).orderBy("row_idx").collect() for m in (fitted, again))
    assert a == b


def test_importances(fitted, learnable):
    top = T.importance(fitted, 1).first()
    assert top["feature"] == "x"
    drops = {r["feature"]: r["mean_importance"] for r in T.permutation_importance(fitted, learnable, ["x", "noise"]).collect()}
    assert drops["x"] > 0.1 > abs(drops["noise"])


def test_the_importance_query_names_the_best_feature(spark, sf):
    """The query names the feature of the largest gain, and its SQL finds that name from the rows."""
    from checks import analysis
    from checks.compare import connect
    from checks.registry import ORACLES

    top = T.importance(T.train_holdout(analysis.learnable(spark, sf)[0], analysis.SMALL)[0], 1).first()["feature"]
    assert analysis.feature_importance(spark, sf).first()["best"] == top
    found = connect(sf).execute(ORACLES["feature_importance"])
    assert dict(zip([c[0] for c in found.description], found.fetchone()))["best"] == top


def test_permutation_importance_equals_numpy(fitted, learnable):
    """One scan per repeat; the drops follow from the trees and the ring of successors."""
    got = {r["feature"]: (r["mean_importance"], r["std_importance"])
           for r in T.permutation_importance(fitted, learnable, repeats=2).collect()}
    assert set(got) == {"x", "noise"}
    names = fitted.assembler.feature_names
    rows = {r["row_idx"]: (r["clicked"], r["features"].toArray()) for r in
            fitted.assembler.transform(learnable, ["row_idx", "clicked"]).collect()}
    keys = sorted(rows)
    y = np.array([rows[k][0] for k in keys])
    x = np.array([rows[k][1] for k in keys])
    forests = T._margins(fitted.models)

    def blended(x):
        p = np.mean([1 / (1 + np.exp(-2 * sum(w * t.predict(x) for w, t in f))) for f in forests], axis=0)
        clip = np.clip(p, 1e-15, 1 - 1e-15)
        each = -np.where(y == 1, np.log(clip), np.log(1 - clip))
        weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
        return 0.5 * brute_ap(y, p) + 0.5 / (1 + (each * weight).sum() / weight.sum())

    drops = {c: [] for c in got}
    for r in range(2):
        moved = {v["row_idx"]: v["other"] for v in T.shuffled(learnable.withColumn("other", F.col("row_idx")), "other",
                                                               seed=42 + 2 * r).collect()}
        at = [keys.index(moved[k]) for k in keys]
        for c in drops:
            swapped = x.copy()
            for i, n in enumerate(names):
                if n in (c, f"{c}_isnull"):
                    swapped[:, i] = x[at, i]
            drops[c].append(blended(x) - blended(swapped))
    for c, values in drops.items():
        assert got[c] == pytest.approx((np.mean(values), np.std(values)), abs=1e-9)


def test_all_columns_are_permuted_in_one_scan(spark, fitted, learnable, tmp_path):
    learnable.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = T.permuted_scores(fitted, rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("FileScan") == 1


def test_shuffling_keeps_the_values(learnable):
    for slot_rows in (100, 10**6):
        out = T.shuffled(learnable, "x", slot_rows=slot_rows)
        a, b = (sorted((r["x"] is None, r["x"] or 0.0) for r in t.select("x").collect()) for t in (learnable, out))
        assert a == b and out.columns == learnable.columns
        moved = out.join(learnable.select("row_idx", F.col("x").alias("x0")), "row_idx").where("not x <=> x0").count()
        assert moved > 1000


def test_assembler(spark):
    df = spark.createDataFrame([(1.0, None, None), (3.0, 2.0, None), (float("nan"), 4.0, None)], "a double, b double, c double")
    model = T.FeatureAssembler(()).fit(df)
    assert model.feature_names == ["a", "b", "c", "a_isnull", "b_isnull", "c_isnull"]
    first = model.transform(df).first()["features"].toArray().tolist()
    assert first == [1.0, 2.0, 0.0, 0.0, 1.0, 1.0]
    with pytest.raises(ValueError, match="numeric"):
        T.FeatureAssembler(()).fit(df.select(F.lit("s").alias("s")))


def test_search_resumes(learnable, tmp_path):
    space = {"learning_rate": ("log", 0.05, 0.4), "max_depth": ("int", 1, 2)}
    path = str(tmp_path / "trials")
    search = T.Search(path, trials=1, base=PARAMS, folds=2, space=space)
    search.run(learnable)
    best = T.Search(path, trials=2, base=PARAMS, folds=2, space=space).run(learnable)
    history = search.history(learnable.sparkSession).orderBy("trial").collect()
    assert [r["trial"] for r in history] == [0, 1]
    top = max(history, key=lambda r: r["score"])
    assert best == T.trial_params(PARAMS, top["trial"], space=space)
    assert T.trial_params(PARAMS, 3) == T.trial_params(PARAMS, 3) != T.trial_params(PARAMS, 4)
