"""Joins of statistics, exact order statistics, and hash order, on skewed data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from clickloom.operators import binning, lookup, order_stats, sampling
from clickloom.operators.hash_order import first_by_hash, group_sizes, hash_ordinal
from clickloom.functions.keys import draw
from clickloom.session import Measured, measure


def skewed(spark, n=6000):
    """A third of the rows has key 0, a tenth has no key."""
    i = F.col("row_idx")
    key = F.when(i % 10 == 9, F.lit(None)).when(i % 3 == 0, F.lit(0)).otherwise(i % 500)
    return spark.range(n).withColumnRenamed("id", "row_idx").withColumn("k", key.cast("long"))


@pytest.mark.parametrize("limit", [0, 10**6])
def test_attach_both_ways_with_a_hot_key(spark, limit):
    rows = skewed(spark)
    stats = measure(rows.groupBy("k").agg(F.count("*").alias("w"), F.max("row_idx").alias("m")))
    got = lookup.attach(rows, stats, ["k"], "w", broadcast_rows=limit)
    assert got.columns == ["k", "row_idx", "m"]
    want = {r["k"]: r["m"] for r in stats.df.collect() if r["k"] is not None}
    out = got.collect()
    assert len(out) == 6000
    assert all(r["m"] == want.get(r["k"]) for r in out)


def test_the_hot_key_is_spread(spark):
    rows = skewed(spark)
    stats = measure(rows.groupBy("k").agg(F.count("*").alias("w"), F.max("row_idx").alias("m")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup.attach(rows, stats, ["k"], "w", broadcast_rows=0)
        largest = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest < 6000 / 3


def test_small_statistics_leave_the_rows_in_place(spark):
    rows = skewed(spark)
    stats = measure(rows.groupBy("k").agg(F.count("*").alias("w")))
    plan = lookup.attach(rows, stats, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_row_key_is_required(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="row key"):
        lookup.attach_by_row(df, df)


VALUES = [float(v) for v in ([3] * 400 + list(range(300)) + [-7.5, 2.25, 1e9])]


@pytest.mark.parametrize("ranges", [1, 2, 16, 64, None])
@pytest.mark.parametrize("parts", [1, 13])
def test_order_statistics_are_exact(spark, ranges, parts):
    rng = random.Random(5)
    shuffled = VALUES[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame([(v, -v if i % 4 else None) for i, v in enumerate(shuffled)], "a double, b double").repartition(parts)
    b = np.array([-v for i, v in enumerate(shuffled) if i % 4])
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for kind in ("nearest", "linear"):
        out = order_stats.order_statistics(df, {"a": probs, "b": probs}, kind, ranges=ranges).collect()
        got = {(r["column"], r["q"]): r["value"] for r in out}
        for name, data in (("a", np.array(VALUES)), ("b", b)):
            want = np.quantile(data, probs, method=kind)
            assert [got[name, q] for q in probs] == pytest.approx(list(want)), (name, kind)


def test_half_ranks_go_to_the_even_one(spark):
    for n, want in ((4, 2.0), (2, 0.0)):
        df = spark.range(n).select(F.col("id").cast("double").alias("x"))
        assert order_stats.order_statistics(df, {"x": [0.5]}).first()["value"] == want


def test_weighted_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 5, None), (2.0, 1, None), (9.0, 2, None)], "x double, n int, e double")
    out = order_stats.order_statistics(df, {"x": [0.5, 1.0], "e": [0.5]}, "linear", weight="n").collect()
    assert {(r["column"], r["q"]): r["value"] for r in out} == {("x", 0.5): 1.0, ("x", 1.0): 9.0}


def test_running_sums_equal_one_window(spark):
    df = spark.createDataFrame([(g, float(v), v % 3) for g in "ab" for v in range(200)], "g string, s double, n int")
    cut = order_stats.with_range(df, order_stats.cut_points(df, ["s"], 8))
    got = order_stats.running_sums(cut, "s_range", [F.col("s").desc()], {"up": "n"}, ["g"], descending=True)
    w = Window.partitionBy("g").orderBy(F.col("s").desc())
    want = df.withColumn("up", F.sum("n").over(w))
    assert sorted(map(tuple, got.select("g", "s", "up").collect())) == sorted(map(tuple, want.select("g", "s", "up").collect()))


@pytest.mark.parametrize("slot_rows", [50, 700, 10**6])
def test_first_by_hash_takes_exactly_the_quota(spark, slot_rows):
    df = skewed(spark)
    quotas = group_sizes(df, ["k"]).withColumn("_quota", F.least("_n", F.greatest(F.lit(1), F.floor(F.col("_n") / 7))))
    got = first_by_hash(df, quotas, ["k"], slot_rows=slot_rows)
    w = Window.partitionBy("k").orderBy(draw(), "row_idx")
    whole = df.withColumns({"rn": F.row_number().over(w), "n": F.count("*").over(Window.partitionBy("k"))})
    want = whole.where(F.col("rn") <= F.least("n", F.greatest(F.lit(1), F.floor(F.col("n") / 7))))
    a, b = ({r["row_idx"] for r in x.select("row_idx").collect()} for x in (got, want))
    assert a == b and got.count() == len(a)


@pytest.mark.parametrize("slot_rows", [60, 10**6])
def test_hash_ordinal_equals_one_window(spark, slot_rows):
    df = skewed(spark)
    got = hash_ordinal(df, ["k"], slot_rows=slot_rows)
    w = Window.partitionBy("k").orderBy(draw(), "row_idx")
    want = df.withColumn("ordinal", F.row_number().over(w) - 1)
    key = lambda x: {r["row_idx"]: r["ordinal"] for r in x.collect()}
    assert key(got) == key(want)


def test_measured_counts(spark):
    m = measure(spark.range(5))
    assert isinstance(m, Measured) and m.rows == 5
    m.release()


@pytest.mark.parametrize("one_task", [100, 10**6])
def test_values_at_any_rank_in_two_scans(spark, monkeypatch, one_task):
    monkeypatch.setattr(order_stats, "ONE_TASK_ROWS", one_task)
    rng = np.random.default_rng(2)
    cols = {"u": rng.random(9000), "heavy": np.where(rng.random(9000) < 0.4, 1.0, rng.normal(size=9000)),
            "odd": np.where(np.arange(9000) % 3 == 0, np.nan, np.round(rng.normal(size=9000), 2))}
    cols["odd"][:5] = [math.inf, -math.inf, math.inf, -0.0, 0.0]
    rows = [(float(a), float(b), None if i % 5 == 4 else float(c)) for i, (a, b, c) in enumerate(zip(*cols.values()))]
    df = spark.createDataFrame(rows, "u double, heavy double, odd double")
    want = {"u": sorted(cols["u"]), "heavy": sorted(cols["heavy"]), "odd": sorted(
        (r[2] for r in rows if r[2] is not None), key=lambda v: (math.isnan(v), v))}
    summary = order_stats.summarise(df, list(cols))
    assert summary.rows == 9000 and summary.counts["odd"] == len(want["odd"])
    ranks = {c: sorted({0, len(v) - 1, *rng.integers(0, len(v), 12).tolist()}) for c, v in want.items()}
    got = order_stats.values_at(df, ranks, summary)
    for c, at in ranks.items():
        assert [str(got[c][r] + 0.0) for r in at] == [str(want[c][r] + 0.0) for r in at], c
    # a sketch that errs costs another scan, not the result
    monkeypatch.setattr(order_stats.Summary, "brackets", lambda self, ranks, always=False: {
        c: [(0.1, 0.2), (0.5, 0.5)] for c in ranks})
    again = order_stats.values_at(df, ranks, summary)
    for c, at in ranks.items():
        assert [str(again[c][r] + 0.0) for r in at] == [str(want[c][r] + 0.0) for r in at], c


def test_binning_reads_the_data_twice(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(order_stats, "ONE_TASK_ROWS", 100)
    spark.range(3000).select((F.col("id") % 977).cast("double").alias("x"), F.when(F.col("id") % 7 != 0, F.sqrt("id")).alias(
        "y")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    read = []
    for name in ("summarise", "values_at"):
        monkeypatch.setattr(binning, name, lambda *a, f=getattr(order_stats, name), **k: (read.append(1), f(*a, **k))[1])
    model = binning.QuantileBinner(["x", "y"], 8).fit(df)
    assert len(read) == 2
    x = sorted(i % 977 for i in range(3000))
    y = [math.sqrt(i) for i in range(3000) if i % 7]
    y = sorted(y + [float(np.median(y))] * (3000 - len(y)))
    for c, v in (("x", x), ("y", y)):
        assert model.edges[c] == sorted({float(v[order_stats.nearest_rank(3000, q)]) for q in model_quantiles(8)})[1:-1]


def model_quantiles(bins):
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def test_first_by_key_refuses_a_key_that_repeats(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 50)
    df = spark.range(300).select((F.col("id") % 2).alias("row_idx"))
    with pytest.raises(ValueError, match="not unique"):
        sampling.first_by_key(df, 20)


def test_several_large_tables_move_the_rows_once(spark, tmp_path):
    """Lookups by row key and keys, then one join of the wide rows."""
    spark.range(400).select(F.col("id").alias("row_idx"), (F.col("id") % 7).alias("a"), F.when(
        F.col("id") % 5 != 0, (F.col("id") % 11).cast("string")).alias("b"), F.lit(2.5).alias("wide")).write.parquet(
        str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    one = spark.createDataFrame([(i, i * 0.5, 3) for i in range(6)], "a long, fa double, _w long")
    two = spark.createDataFrame([(i, str(j), i + j, 3) for i in range(7) for j in range(9)], "a long, b string, fb int, _w long")
    three = spark.createDataFrame([(str(j), j, 3) for j in range(11)], "_t string, fc int, _w long")
    lookups = [lookup.Lookup(Measured(one, 6), ["a"], defaults={"fa": F.lit(-1.0)}), lookup.Lookup(Measured(two, 63), ["a", "b"]),
               lookup.Lookup(Measured(three, 11), ["_t"], {"_t": F.col("b")})]
    small = lookup.attach_all(rows, lookups)
    large = lookup.attach_all(rows, lookups, broadcast_rows=0)
    # of all exchanges only one carries the wide column
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    blocks = large._jdf.queryExecution().explainString(mode).split("\n\n")
    assert len([b for b in blocks if ") Exchange" in b and "wide#" in b.split("Arguments")[0]]) == 1
    assert small.columns == large.columns == ["row_idx", "a", "b", "wide", "fa", "fb", "fc"]
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
    got = {r["row_idx"]: r for r in large.collect()}
    assert len(got) == 400 and got[13]["fa"] == -1.0 and got[8]["fb"] == 1 + 8 and got[5]["fc"] is None
