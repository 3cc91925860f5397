"""Correlation tables, feature selection and profile tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.operators import correlation as C
from clickloom.operators import eda
from clickloom.sources import impressions as imp


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 400
    a = rng.normal(size=n)
    pdf = pd.DataFrame({"a": a + 1e6, "b": a * 2 + rng.normal(size=n), "c": rng.normal(size=n), "flat": 3.25,
                        "d": -a + 0.01 * rng.normal(size=n)})
    pdf.loc[::3, "c"] = np.nan
    pdf.loc[::7, "b"] = np.nan
    pdf["none"] = np.nan
    rows = [[None if pd.isna(v) else float(v) for v in r] for r in pdf.to_numpy()]
    return pdf, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))


@pytest.mark.parametrize("parts", [1, 9, 100])
def test_pairs_equal_pandas(frame, parts):
    pdf, df = frame
    out = C.correlation_pairs(df.repartition(parts), list(pdf.columns)).collect()
    want = pdf.corr()
    assert len(out) == 15
    for r in out:
        w = want.loc[r["feature1"], r["feature2"]]
        if np.isnan(w):
            assert r["correlation"] is None, r
        else:
            assert r["correlation"] == pytest.approx(w, abs=1e-7), r


def test_targets_equal_pandas(frame):
    pdf, df = frame
    out = {r["feature"]: r["correlation"] for r in C.target_correlations(df, ["a", "c", "flat"], "d").collect()}
    assert out["flat"] is None
    assert (out["a"], out["c"]) == pytest.approx((pdf.a.corr(pdf.d), pdf.c.corr(pdf.d)), abs=1e-7)
    t = C.correlation_tables(df, ["a", "b", "c", "d"], "d")
    assert t.pairs.count() == 3 and t.targets.count() == 3
    t.release()


@pytest.mark.parametrize("tile", [1, 8])
def test_tiles_change_nothing(spark, tile):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 19)) + 1e6 * np.arange(19)
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(19)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [*names]).repartition(3)
    whole, tiled = (C.correlation_pairs(df, names, t).collect() for t in (64, tile))
    got = {(r["feature1"], r["feature2"]): r["correlation"] for r in tiled}
    assert len(got) == len(tiled) == 19 * 18 // 2
    assert got == pytest.approx({(r["feature1"], r["feature2"]): r["correlation"] for r in whole}, abs=1e-12)
    to_one = {r["feature"]: r["correlation"] for r in C.target_correlations(df, names, "c7", tile).collect()}
    assert to_one == pytest.approx({c: got[(c, "c7")] if (c, "c7") in got else got[("c7", c)] for c in names if c != "c7"})
    assert C.correlation_pairs(df, []).count() == C.target_correlations(df, ["c7"], "c7").count() == 0


def test_null_pairs_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, None), (4.0, 1.0)], "a double, b double")
    assert C.correlation_pairs(df, ["a", "b"]).first()["correlation"] == pytest.approx(-1.0)


def test_nan_offsets_and_leading_nulls(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    a = rng.normal(size=n)
    pdf = pd.DataFrame({"a": a, "b": a * 0.2 + rng.normal(size=n), "far": 1.7e9 + a + 0.03 * rng.normal(size=n),
                        "c": rng.normal(size=n), "far_flat": 1.7e9 + 0.1})
    pdf.loc[:1999, "far"] = np.nan
    pdf.loc[rng.random(n) < 0.02, "b"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("far", F.when(~F.isnan("far"), F.col("far"))).repartition(5)
    want = pdf.corr()
    few = {(r[0], r[1]): r[2] for c in (["a", "b"], ["b", "c"], ["a", "far"], ["a", "far_flat"])
           for r in C.correlation_pairs(df, c).collect()}
    many = {(r[0], r[1]): r[2] for r in C.correlation_pairs(df, list(pdf.columns)).collect()}
    assert few["a", "far_flat"] is None and many["c", "far_flat"] is None
    for pair, value in few.items():
        assert many[pair] == (None if value is None else pytest.approx(value, abs=1e-9))
        if value is not None:
            assert value == pytest.approx(want.loc[pair], abs=1e-6)


def test_offsets_cost_no_digits_between_tasks(spark):
    x = np.random.default_rng(4).integers(0, 100, size=(500, 2)).astype(float)
    for offset in (0.0, 2.0 ** 40):
        df = spark.createDataFrame([tuple(map(float, r)) for r in x + offset], "a double, b double").repartition(7)
        want = pytest.approx(np.corrcoef(x.T)[0, 1], abs=1e-12)
        assert C.correlation_pairs(df, ["a", "b"]).first()["correlation"] == want
        assert C.target_correlations(df, ["a"], "b").first()["correlation"] == want


def test_infinite_and_empty_columns_are_undefined(spark):
    df = spark.createDataFrame([(1.0, float("inf"), None), (2.0, 1.0, None), (3.0, 2.0, None)], "a double, b double, c double")
    assert [r["correlation"] for r in C.correlation_pairs(df, ["a", "b", "c"]).collect()] == [None] * 3
    assert [r["correlation"] for r in C.correlation_pairs(df.limit(0), ["a", "b"]).collect()] == [None]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "feature1 string, feature2 string, correlation double")


def targets(spark, rows):
    return spark.createDataFrame(rows, "feature string, correlation double").withColumn("abs_correlation", F.abs("correlation"))


def test_redundancy_is_by_component(spark):
    p = pairs(spark, [("x1", "x2", 1.0), ("x2", "x3", -1.0), ("x4", "x5", 1.0), ("x1", "x4", 0.2)])
    t = targets(spark, [("x1", .1), ("x2", -.3), ("x3", .2), ("x4", .1), ("x5", .1)])
    out = {r["feature"]: (r["component"], r["keep"]) for r in C.redundancy_groups(p, t).collect()}
    assert out == {"x1": ("x1", False), "x2": ("x1", True), "x3": ("x1", False), "x4": ("x4", True), "x5": ("x4", False)}


def test_long_chain_is_one_component(spark):
    names = [f"n{i:03d}" for i in np.random.default_rng(0).permutation(60)]
    chain = spark.createDataFrame(list(zip(names, names[1:])) + [("y1", "y2")], "feature1 string, feature2 string")
    out = C.components(chain).collect()
    assert len(out) == 62
    assert {r["component"] for r in out} == {"n000", "y1"}


def test_no_edges(spark):
    assert C.components(pairs(spark, []).drop("correlation")).count() == 0


def test_selection_tables(spark):
    p = pairs(spark, [("feat_a_1", "feat_b_1", 0.1), ("feat_a_1", "feat_a_2", 0.95), ("feat_b_1", "feat_a_2", 0.6)])
    t = targets(spark, [("feat_a_1", .4), ("feat_b_1", -.2), ("feat_a_2", .3)])
    assert [r["feature2"] for r in C.strong_pairs(p, 0.5, 0.7).collect()] == ["feat_a_2"]
    assert {r["band"]: r["pairs"] for r in C.band_counts(p).collect()} == {"0.5-0.7": 1, "0.7-0.9": 0, "0.9-0.99": 1, ">=0.99": 0}
    cand = C.interaction_candidates(p, t)
    row = cand.first()
    assert cand.count() == 1 and row["interaction_score"] == pytest.approx(0.6 * 0.9)
    cross = C.cross_group_candidates(cand).first()
    assert (cross["group1"], cross["group2"]) == ("feat_a", "feat_b")
    named = {r["feature1"]: r for r in C.named_pairs(p, t, [("feat_b_1", "feat_a_1"), ("gone", "feat_a_1")]).collect()}
    assert named["feat_b_1"]["correlation"] == 0.1 and named["gone"]["missing"] == "gone"
    assert C.group_pairs(p).select("feature1", "group").collect() == [("feat_a_1", "feat_a")]
    assert [r["feature2"] for r in C.top_partners(p, ["feat_a_2"], 1).collect()] == ["feat_a_1"]
    check = C.post_drop_check(p, ["feat_a_2"], 4).first()
    assert (check["pairs_ge_0_7"], check["features_left"], check["reduction_pct"]) == (0, 3, 25.0)
    gap = C.top_bottom_gap(t, 1).first()
    assert (gap["top_mean"], gap["rest_mean"], gap["uplift_pct"]) == pytest.approx((0.4, 0.25, 60.0))
    assert C.drop_justification(t, ["feat_b_1"]).first()["justified"] is True
    assert {r["class"]: r["names"] for r in C.target_classes(t, .35, .25).collect()} == {
        "high": "feat_a_1", "medium": "feat_a_2", "low": "feat_b_1"}
    assert [r["rank"] for r in C.extremes(t, 1).orderBy("rank").collect()] == [1, 3]
    assert C.top_pair_submatrix(p, 1).count() == 1
    assert C.subset_summary(p, ["feat_a_1", "feat_a_2"]).first()["mean_correlation"] == pytest.approx(0.95)
    assert {r["feature"]: r["number"] for r in C.group_counts(spark, ["feat_a_3"]).collect()} == {"feat_a_3": 3}


def test_histogram_and_distribution_equal_numpy(spark):
    v = np.random.default_rng(2).normal(size=97)
    t = targets(spark, [(f"f{i}", float(x)) for i, x in enumerate(v)])
    counts, _ = np.histogram(v, bins=30)
    got = {r["bin"]: r["features"] for r in C.histogram(t).collect()}
    assert [got.get(i, 0) for i in range(30)] == list(counts)
    d = C.distribution(t).first()
    a = np.abs(v)
    assert (d["mean"], d["median"], d["std"], d["cv"]) == pytest.approx((a.mean(), np.median(a), a.std(), a.std() / a.mean()))
    assert (d["p90"], d["p95"], d["p99"]) == pytest.approx(tuple(np.percentile(a, [90, 95, 99])))


def test_chi_square_equals_the_ml_test(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = imp.impressions(spark, sf).withColumn("h", F.col("hour").cast("int")).where("gender is not null")
    ours = {r["feature"]: (r["statistic"], r["degrees"], r["p_value"]) for r in C.chi_square(df, ["gender", "h"]).collect()}
    x = VectorAssembler(inputCols=["gender", "h"], outputCol="v").transform(df)
    ml = ChiSquareTest.test(x, "v", "clicked").first()
    assert [ours["gender"][0], ours["h"][0]] == pytest.approx(list(ml["statistics"]))
    assert [ours["gender"][1], ours["h"][1]] == list(ml["degreesOfFreedom"])
    assert [ours["gender"][2], ours["h"][2]] == pytest.approx(list(ml["pValues"]), abs=1e-9)


def test_report(spark, sf):
    train = imp.train_part(imp.impressions(spark, sf, True))
    text = eda.report(train, source="here", generated="now")
    rows = train.count()
    assert f"| rows | {rows:,} |" in text
    days = {r["day_of_week"]: r for r in eda.rates_by(train, ["day_of_week"]).collect()}
    for day, r in days.items():
        assert f"| {day} | {r['rows']} | {r['clicks']} | {r['click_rate']:.6f} |" in text
    assert eda.to_markdown(train.where("false")) == "_no data_"
    assert text.count("| --- |") >= 7
