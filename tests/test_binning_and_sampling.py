"""Quantile bins and downsampling, with hand-made cases and invariants."""

import json

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from clickloom.functions.keys import draw
from clickloom.operators import sampling
from clickloom.operators.binning import BinModel, QuantileBinner, digitize, inner_edges
from clickloom.operators.hash_order import hash_parts


def test_degenerate_edges(spark):
    df = spark.createDataFrame([(3.0, 0.0, None)] * 9 + [(3.0, 0.0, None), (3.0, 0.0, None), (3.0, 1.0, None)],
                               "same double, two double, none double")
    model = QuantileBinner(["same", "two", "none"], 2).fit(df)
    assert model.edges["same"] == [3.0]
    assert model.edges["two"] == pytest.approx([1 / 12])
    assert model.edges["none"] == [0.0] and "none" not in model.fills
    assert {r[0] for r in model.transform(df).select("same_bin").collect()} == {1}
    assert inner_edges([0.0, 0.0, 1.0], 0.25) == [0.25]


def test_digitize_edges(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(digitize(F.col("x"), [1.0, 2.0])).collect()] == [0, 1, 2, 2, None]


@pytest.mark.parametrize("ranges", [None, 8])
def test_bins_equal_numpy(spark, ranges):
    rng = np.random.default_rng(3)
    x = np.round(rng.exponential(10, 5000), 1)
    x[::3] = 4.0  # a third of the rows shares one value
    y = rng.normal(size=5000)
    holes = [None if i % 50 == 0 else float(v) for i, v in enumerate(y)]
    df = spark.createDataFrame([(i, float(a), b) for i, (a, b) in enumerate(zip(x, holes))], "row_idx long, x double, y double")
    model = QuantileBinner(["x", "y"], 24, ranges=ranges).fit(df)
    med = float(np.median([v for v in holes if v is not None]))
    filled = np.array([med if v is None else v for v in holes])
    assert model.fills["y"] == pytest.approx(med)
    out = model.transform(df).withColumn("g", model.grid("x", "y")).orderBy("row_idx").collect()
    for name, data in (("x", x), ("y", filled)):
        edges = np.unique(np.quantile(data, np.linspace(0, 1, 25), method="nearest"))
        assert model.edges[name] == pytest.approx(list(edges[1:-1]))
        assert [r[f"{name}_bin"] for r in out] == list(np.digitize(data, edges[1:-1]))
    n = model.bin_count("y")
    assert all(r["g"] == r["x_bin"] * n + r["y_bin"] for r in out)
    again = BinModel.from_json_dict(json.loads(json.dumps(model.to_json_dict(), allow_nan=False)))
    assert again == model


def strata(spark):
    rows = [(s, 0) for s, n in (("a", 1), ("b", 2), ("c", 5), ("d", 25)) for _ in range(n)] + [("a", 1)] * 33
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_idx long, s string, clicked int")


@pytest.mark.parametrize("slot_rows", [3, 10**6])
def test_quotas_round_half_to_even_with_a_minimum_of_one(spark, slot_rows):
    df = strata(spark)  # 33 negatives, ratio 0.1 of 33 positives -> target 3, fraction 1/11
    got = sampling.sample_negatives(df, ["s"], 0.1, slot_rows=slot_rows)
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 1, "b": 1, "c": 1, "d": 2}
    half = df.where("clicked = 0 and s = 'd'").unionByName(df.where("clicked = 1").limit(5))
    got = sampling.sample_negatives(half, ["s"], 0.5, slot_rows=slot_rows)  # target int(2.5) = 2 of 25
    assert got.count() == 2


def test_null_strata(spark):
    rows = [(i, None if i % 2 else "x", "y" if i % 2 else None, 0) for i in range(100)] + [(1000 + i, "p", "p", 1) for i in range(10)]
    df = spark.createDataFrame(rows, "row_idx long, a string, b string, clicked int")
    own = sampling.sample_negatives(df, ["a", "b"], 1.0)
    assert own.groupBy("a", "b").count().select("count").collect() == [(5,), (5,)]
    together = sampling.sample_negatives(df, ["a", "b"], 1.0, parity=True)
    assert together.count() == 10 and together.columns == df.columns


def test_downsample_is_whole_and_stable(spark):
    df = spark.range(4000).withColumnRenamed("id", "row_idx").withColumns({
        "clicked": (F.col("row_idx") % 50 == 0).cast("int"), "h": F.when(F.col("row_idx") % 3 == 0, 0).otherwise(F.col("row_idx") % 24)})
    runs = [{r[0] for r in sampling.stratified_downsample(df.repartition(p), ["h"], 4.0, slot_rows=s).select("row_idx").collect()}
            for p, s in ((1, 10**6), (13, 100))]
    assert runs[0] == runs[1]
    out = df.where(F.col("row_idx").isin(list(runs[0])))
    assert out.where("clicked = 1").count() == 80
    stats = sampling.downsample_stats(df, out).first()
    assert (stats["total_pos"], stats["total_neg"], stats["target_neg"]) == (80, 3920, 320)
    assert stats["ratio"] == pytest.approx(stats["actual_neg"] / 80)
    for h, kept, n in [(r["h"], r["k"], r["n"]) for r in df.where("clicked = 0").groupBy("h").agg(
            F.count("*").alias("n"), F.count_if(F.col("row_idx").isin(list(runs[0]))).alias("k")).collect()]:
        assert kept == max(1, round(n * 320 / 3920)), h


def test_exact_sizes(spark):
    df = spark.range(3000).withColumnRenamed("id", "row_idx").withColumn("clicked", (F.col("row_idx") % 100 == 0).cast("int"))
    for slot_rows in (70, 10**6):
        out = sampling.random_downsample(df, 2.0, slot_rows=slot_rows)
        assert (out.count(), out.where("clicked = 1").count()) == (90, 30)
        assert sampling.sample_rows(df, 123, slot_rows=slot_rows).count() == 123
    assert sampling.sample_rows(df, 10**6).count() == 3000
    assert sampling.first_by_key(df, 10).agg(F.max("row_idx")).first()[0] == 9
    assert sampling.first_by_key(df, 10**6).count() == 3000 and sampling.first_by_key(df, 0).count() == 0


@pytest.mark.parametrize("slot_rows, parts", [(7, 5), (1000, 5), (7, 3), (20, 1)])
def test_hash_parts_equal_one_window(spark, slot_rows, parts):
    # groups of many sizes, one smaller than the number of parts
    df = spark.range(700).select(F.col("id").alias("row_idx"), F.when(F.col("id") < 3, "tiny").when(
        F.col("id") < 40, F.lit(None).cast("string")).when(F.col("id") % 9 == 0, "b").otherwise("a").alias("g"))
    whole = Window.partitionBy("g")
    order = whole.orderBy(draw("row_idx", 42), "row_idx")
    want = df.withColumn("part", F.expr("0") + F.floor((F.row_number().over(order) * parts - 1) / F.count("*").over(whole)).cast("int"))
    got = hash_parts(df, ["g"], parts, slot_rows=slot_rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert hash_parts(df.limit(0), ["g"], parts).count() == 0


def test_folds_leave_the_rows_where_they_are(spark, tmp_path):
    spark.range(500).select(F.col("id").alias("row_idx"), (F.col("id") % 4 == 0).cast("int").alias("clicked"),
                            F.lit(1.5).alias("feature")).write.parquet(str(tmp_path / "t"))
    plan = sampling.stratified_folds(spark.read.parquet(str(tmp_path / "t")), 5)._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.split("\n") if "Exchange" in x and "feature" in x]
    assert "feature" in plan and not wide and "SortMergeJoin" not in plan.split("InMemoryRelation")[0]


def test_folds_are_balanced_per_class(spark):
    df = spark.range(1003).withColumnRenamed("id", "row_idx").withColumn("clicked", (F.col("row_idx") % 9 == 0).cast("int"))
    counts = sampling.stratified_folds(df, slot_rows=50).groupBy("clicked", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in counts if r["clicked"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_bad_inputs(spark):
    df = spark.createDataFrame([(1, 0)], "row_idx long, clicked int")
    with pytest.raises(ValueError, match="both classes"):
        sampling.random_downsample(df)
    with pytest.raises(ValueError, match="stratum"):
        sampling.strata_columns(df)
