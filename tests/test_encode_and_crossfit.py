"""Encoders and cross-fit deltas against brute force over the folds."""

import pytest
from pyspark.sql import functions as F

from clickloom.functions.keys import hash_fold
from clickloom.operators.crossfit import SliceDelta, SliceDeltaModel, SliceDeltas, slice_full_outer, slice_means
from clickloom.operators.encode import DictionaryEncoder, DictionaryModel, RateEncoder, RateModel


def rows(spark, n=3000):
    """A third of all rows shares one key; some keys are null."""
    i = F.col("row_idx")
    return spark.range(n).withColumnRenamed("id", "row_idx").select(
        "row_idx", ((i * 7919) % 11 < 3).cast("int").alias("clicked"),
        F.when(i % 17 == 0, None).when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i % 40).cast("string"))).alias("a"),
        (i % 5).cast("string").alias("b"), (i % 7 + 1).cast("string").alias("day_of_week"), hash_fold().alias("f"))


def test_target_encoding_leaves_out_the_fold(spark):
    df = rows(spark)
    data = [r.asDict() for r in df.collect()]
    model = RateEncoder(frequency=["a"], target=[("a", "b")]).fit(df)
    prior = sum(r["clicked"] for r in data) / len(data)
    assert model.prior == pytest.approx(prior)
    got = {r["row_idx"]: r for r in model.transform_train(model.transform_frequency(df)).collect()}
    assert len(got) == len(data)
    for r in data[::37]:
        others = [x["clicked"] for x in data if x["f"] != r["f"] and x["a"] == r["a"] and x["b"] == r["b"] and r["a"]]
        want = (sum(others) + 50 * prior) / (len(others) + 50)
        assert got[r["row_idx"]]["a__X__b_te"] == pytest.approx(want)
        share = sum(x["a"] == r["a"] for x in data) / len(data) if r["a"] else 0.0
        assert got[r["row_idx"]]["a_freq"] == pytest.approx(share)


def test_single_fold_key_and_unseen_key(spark):
    df = rows(spark)
    lone = df.where("f = 2").limit(3).withColumns({"a": F.lit("lone"), "row_idx": F.col("row_idx")})
    both = df.join(lone.select("row_idx"), "row_idx", "left_anti").unionByName(lone.select(*df.columns))
    model = RateEncoder(frequency=["a"], target=[("a",)]).fit(both)
    own = model.transform_train(both).where("a = 'lone'").select("a_te").distinct().collect()
    assert [r[0] for r in own] == pytest.approx([model.prior])
    new = spark.createDataFrame([(1, "lone"), (2, "never")], "row_idx long, a string")
    out = {r["a"]: r for r in model.transform_new(model.transform_frequency(new)).collect()}
    s = lone.agg(F.sum("clicked")).first()[0]
    assert out["lone"]["a_te"] == pytest.approx((s + 50 * model.prior) / 53)
    assert out["never"]["a_te"] == pytest.approx(model.prior) and out["never"]["a_freq"] == 0.0


def test_folds_add_up_to_the_total(spark):
    df = rows(spark)
    model = RateEncoder(frequency=[], target=[("a", "b")]).fit(df)
    cells = model.cells.of(0)
    assert cells.agg(F.sum("_n")).first()[0] == df.count()


@pytest.mark.parametrize("limit", [10**6, 0])
def test_dictionary_is_shared_and_dense(spark, limit):
    tr = spark.createDataFrame([(1, "b", 2), (2, "a", 1), (3, None, 2)], "row_idx long, x string, y int")
    te = spark.createDataFrame([(4, "c", 3), (5, "a", 2)], "row_idx long, x string, y int")
    model = DictionaryEncoder(["x", "y", "absent"], one_task_rows=limit).fit(tr, te)
    a = {r["row_idx"]: (r["x_cat"], r["y_cat"]) for r in model.transform(tr).collect()}
    b = {r["row_idx"]: (r["x_cat"], r["y_cat"]) for r in model.transform(te).collect()}
    assert a == {1: (1, 1), 2: (0, 0), 3: (None, 1)} and b == {4: (2, 2), 5: (0, 1)}
    assert "x" not in model.transform(tr).columns and "x" in model.transform(tr, drop=False).columns
    assert dict(model.transform(te).dtypes)["x_cat"] == "int"


def test_distributed_codes_equal_small_codes(spark):
    df = rows(spark, 2000).select("row_idx", F.concat("a", F.col("row_idx").cast("string")).alias("x"), "b")
    small, large = (DictionaryEncoder(["x", "b"], one_task_rows=n).fit(df).transform(df) for n in (10**6, 0))
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)


def brute(data, row, keys, delta, strict=False):
    pool = [x for x in data if x["f"] != row["f"]]
    base = pool if strict else data
    mean = lambda xs: sum(x["clicked"] for x in xs) / len(xs)
    m1, m0 = mean([x for x in base if x["day_of_week"] == "7"]), mean([x for x in base if x["day_of_week"] != "7"])
    same = [x for x in pool if all(x[k] == row[k] and row[k] is not None for k in keys)]
    s1, s0 = [x for x in same if x["day_of_week"] == "7"], [x for x in same if x["day_of_week"] != "7"]
    if delta.alpha is None:
        if delta.one_sided:
            return ((mean(s1) if s1 else m1) - (mean(s0) if s0 else m0)) if same else m1 - m0
        return mean(s1) - mean(s0) if s1 and s0 else m1 - m0
    side = lambda s, m: (sum(x["clicked"] for x in s) + delta.alpha * m) / (len(s) + delta.alpha) if len(s) >= delta.min_count else m
    return side(s1, m1) - side(s0, m0)


@pytest.mark.parametrize("strict", [False, True])
def test_deltas_equal_brute_force(spark, strict):
    df = rows(spark)
    data = [r.asDict() for r in df.collect()]
    specs = [SliceDelta("plain", ("a",)), SliceDelta("sided", ("a", "b"), one_sided=True),
             SliceDelta("smooth", ("a", "b"), alpha=100.0, min_count=4)]
    model = SliceDeltas(specs, share_key="a", strict_oof=strict).fit(df)
    got = {r["row_idx"]: r for r in model.transform_train(df).collect()}
    assert len(got) == len(data)
    for row in data[::41]:
        for spec in specs:
            want = brute(data, row, spec.keys, spec, strict)
            assert got[row["row_idx"]][spec.name] == pytest.approx(want), (spec.name, row)
        same = [x for x in data if row["a"] is not None and x["a"] == row["a"]]
        n7 = sum(x["day_of_week"] == "7" for x in same)
        share = (n7 + 1) / (len(same) + 2) if same else sum(x["day_of_week"] == "7" for x in data) / len(data)
        assert got[row["row_idx"]]["day7_freq_ratio_inv"] == pytest.approx(share)


def test_given_folds(spark):
    df = rows(spark, 900)
    spec = SliceDelta("x", ("a",), alpha=5.0)
    drawn = SliceDeltas([spec]).fit(df).transform_train(df).select("row_idx", "x")
    given = df.withColumn("f", hash_fold())
    same = SliceDeltas([spec], fold="f").fit(given).transform_train(given).select("row_idx", "x")
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, same.collect()))
    # with all rows in one fold nothing is left to estimate from but the overall rates
    one = df.withColumn("f", F.lit(0))
    model = SliceDeltas([spec], fold="f").fit(one)
    assert {round(r["x"], 12) for r in model.transform_train(one).collect()} == {round(model.overall[0] - model.overall[1], 12)}


def test_one_sided_keys(spark):
    def many(key, day, n, clicks):
        return [(key, day, 1 if i < clicks else 0) for i in range(n)]

    data = many("a", "7", 10, 5) + many("b", "1", 20, 4) + many("c", "7", 10, 2) + many("c", "1", 10, 1)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "row_idx long, k string, day_of_week string, clicked int")
    plain, smooth = SliceDelta("p", ("k",)), SliceDelta("s", ("k",), alpha=10.0)
    model = SliceDeltas([plain, smooth]).fit(df)
    out = {r["k"]: r for r in model.transform_new(df.select("row_idx", "k").dropDuplicates(["k"])).collect()}
    m1, m0 = 7 / 20, 5 / 30
    assert model.overall == pytest.approx((m1, m0))
    assert out["a"]["p"] == pytest.approx(m1 - m0) and out["b"]["p"] == pytest.approx(m1 - m0)
    assert out["c"]["p"] == pytest.approx(0.2 - 0.1)
    assert out["a"]["s"] == pytest.approx((5 + 10 * m1) / 20 - m0)
    assert out["b"]["s"] == pytest.approx(m1 - (4 + 10 * m0) / 30)


def test_empty_slice_falls_back_to_the_overall_mean(spark):
    df = rows(spark, 300).where("day_of_week <> '7'")
    mean = df.agg(F.avg("clicked")).first()[0]
    row = slice_means(df).first()
    assert row["day7_mean"] == pytest.approx(mean) and row["delta"] == pytest.approx(0.0)
    assert SliceDeltas([SliceDelta("x", ("a",))]).fit(df).overall == pytest.approx((mean, mean))


def test_smoothed_share_of_a_rest_only_key(spark):
    df = spark.createDataFrame([(1, "k", "1", 0), (2, "k", "2", 0), (3, "k", "3", 1), (4, "z", "7", 1)],
                               "row_idx long, k string, day_of_week string, clicked int")
    model = SliceDeltas([], share_key="k").fit(df)
    new = spark.createDataFrame([(9, "k"), (10, "new")], "row_idx long, k string")
    got = {r["k"]: r["day7_freq_ratio_inv"] for r in model.transform_new(new).collect()}
    assert got == pytest.approx({"k": 0.2, "new": 0.25})


def test_full_outer_keeps_missing_sides(spark):
    df = spark.createDataFrame([("a", "7", 1), ("b", "1", 0)], "k string, day_of_week string, clicked int")
    got = {r["k"]: (r["day7_ctr"], r["day7_cnt"], r["rest_ctr"], r["rest_cnt"]) for r in slice_full_outer(df, ["k"]).collect()}
    assert got == {"a": (1.0, 1, None, None), "b": (None, None, 0.0, 1)}


def test_result_does_not_depend_on_partitioning(spark):
    df = rows(spark, 1500)
    specs = [SliceDelta("x", ("a",), alpha=5.0, min_count=2)]
    runs = []
    for parts in (1, 4, 13):
        part = df.repartition(parts)
        out = SliceDeltas(specs).fit(part).transform_train(part).select("row_idx", F.round("x", 12)).collect()
        runs.append(sorted(map(tuple, out)))
    assert runs[0] == runs[1] == runs[2]


def table_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_rate_models_merge_and_persist(spark, tmp_path):
    df = rows(spark, 1200)
    encoder = RateEncoder(frequency=["a"], target=[("a", "b"), ("b",)], weight=3.0)
    whole = encoder.fit(df)
    parts = [encoder.fit(df.where(F.col("row_idx") % 3 == 0)), encoder.fit(df.where(F.col("row_idx") % 3 != 0))]
    parts[0].save(str(tmp_path / "one"))
    both = RateModel.load(spark, str(tmp_path / "one")).merge(parts[1])
    names = ["row_idx", "a_freq", "a__X__b_te", "b_te"]
    assert (both.prior, both.rows) == (whole.prior, whole.rows)
    for way in ("transform_train", "transform_new"):
        a, b = (table_of(getattr(m, way)(m.transform_frequency(df)), *names) for m in (whole, both))
        assert a == b and len(a) == 1200
    both.save(str(tmp_path / "both"))
    again = RateModel.load(spark, str(tmp_path / "both"))
    assert table_of(again.transform_train(again.transform_frequency(df)), *names) == table_of(
        whole.transform_train(whole.transform_frequency(df)), *names)
    with pytest.raises(ValueError, match="merged"):
        both.merge(RateEncoder(frequency=["b"], target=[]).fit(df))


def test_delta_models_merge_and_persist(spark, tmp_path):
    df = rows(spark, 1200)
    specs = [SliceDelta("p", ("a",)), SliceDelta("s", ("a", "b"), alpha=20.0, min_count=3)]
    spec = SliceDeltas(specs, share_key="b", strict_oof=True)
    whole = spec.fit(df)
    first, second = (spec.fit(df.where(F.col("day_of_week").isin(days) == inside)) for days, inside in (
        (["1", "7"], True), (["1", "7"], False)))
    first.save(str(tmp_path / "d"))
    both = SliceDeltaModel.load(spark, str(tmp_path / "d")).merge(second)
    names = ["row_idx", "p", "s", spec.share_name]
    assert both.overall == whole.overall and both.by_fold == whole.by_fold
    for way in ("transform_train", "transform_new"):
        assert table_of(getattr(both, way)(df), *names) == table_of(getattr(whole, way)(df), *names)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_dictionaries_extend_and_persist(spark, tmp_path, limit):
    old = spark.createDataFrame([(1, "b", 1), (2, "d", None), (3, "b", 2)], "row_idx long, x string, y int")
    new = spark.createDataFrame([(4, "a", 2), (5, "d", 9), (6, "c", 9), (7, None, 10)], "row_idx long, x string, y int")
    encoder = DictionaryEncoder(["x", "y"], one_task_rows=limit)
    encoder.fit(old).save(str(tmp_path / "codes"))
    model = DictionaryModel.load(spark, str(tmp_path / "codes"))
    assert table_of(model.transform(old), "row_idx", "x_cat", "y_cat") == [(1, 0, 0), (2, 1, None), (3, 0, 1)]
    both = model.merge(encoder.fit(new))
    assert table_of(both.transform(old), "row_idx", "x_cat", "y_cat") == [(1, 0, 0), (2, 1, None), (3, 0, 1)]
    # new values follow in their sort order as text
    assert table_of(both.transform(new), "row_idx", "x_cat", "y_cat") == [(4, 2, 1), (5, 1, 3), (6, 3, 3), (7, None, 2)]
    seen = {(r["column"], r["value"]): r["_w"] for r in both.codes.df.collect()}
    assert seen[("x", "d")] == 2 and seen[("y", "2")] == 2 and len(seen) == 8
    both.save(str(tmp_path / "more"))
    again = DictionaryModel.load(spark, str(tmp_path / "more"))
    assert table_of(again.transform(new), "row_idx", "x_cat", "y_cat") == table_of(both.transform(new), "row_idx", "x_cat", "y_cat")
