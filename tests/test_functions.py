"""Column expressions on literal edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from clickloom import defaults as d
from clickloom.functions import calendar, columns, keys, missing, sequence


def one(df):
    return [tuple(r) for r in df.collect()]


def test_sequence_edges(spark):
    long5, long10 = ",".join(["1"] * 5000), ",".join(["1"] * 10000)
    rows = [(0, None), (1, ""), (2, "5"), (3, "5,6"), (4, "7,x"), (5, ",".join(["1"] * 10)), (6, long5), (7, long10)]
    df = spark.createDataFrame(rows, "i int, seq string")
    out = sequence.add_seq_features(df).withColumn(
        "r", sequence.seq_report_bucket(sequence.seq_length(null_as_zero=True))).orderBy("i")
    got = one(out.select("seq_len", "seq_first", "seq_last", "seq_available", "seq_len_bucket", "r"))
    assert got == [
        (None, None, None, 1, "5000+", "0-9"),
        (1, None, None, 1, "0-9", "0-9"),
        (1, 5, 5, 1, "0-9", "0-9"),
        (2, 5, 6, 1, "0-9", "0-9"),
        (2, 7, None, 1, "0-9", "0-9"),
        (10, 1, 1, 1, "10-24", "10-24"),
        (5000, 1, 1, 1, "5000+", "5000-9999"),
        (10000, 1, 1, 1, "5000+", "10000+"),
    ]


def test_last_token_needs_the_true_end(spark):
    df = spark.createDataFrame([("5,6\n",)], "seq string")
    assert sequence.add_seq_features(df).first()["seq_last"] is None


def test_sequence_statistics_of_bad_and_odd_input(spark):
    zeros = (0.0,) * 7
    five_six = (5.5, 0.5, 5.0, 6.0, 2.0, 11.0, 5.5)
    cases = [("7,x", zeros), ("5,,6", zeros), ("5,6,", five_six), (" 5 , 6", five_six), (None, zeros), ("", zeros),
             ("5d,6", zeros), ("4", (4.0, 0.0, 4.0, 4.0, 1.0, 4.0, 4.0)), ("3,1,2", (2.0, math.sqrt(2 / 3), 1.0, 3.0, 3.0, 6.0, 2.0))]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, seq string")
    out = sequence.add_seq_stats(df).orderBy("i").select(
        "seq_mean", "seq_std", "seq_min", "seq_max", "seq_len", "seq_sum", "seq_median").collect()
    for (text, want), got in zip(cases, out):
        assert tuple(got) == pytest.approx(want), text


def test_statistics_leave_other_columns_alone(spark):
    df = spark.createDataFrame([("1,2", 7)], "seq string, keep int")
    assert sequence.add_seq_stats(df).first()["keep"] == 7


def test_diversity_and_clipping(spark):
    df = spark.createDataFrame([("1,1,2,2",)], "seq string")
    row = df.select(sequence.unique_count().alias("u"), sequence.diversity_ratio().alias("r"),
                    sequence.clip_length(sequence.seq_length(), 3).alias("c")).first()
    assert (row["u"], row["r"], row["c"]) == (2, 0.5, 3)


def test_hours_and_unknown_values(spark):
    hours = ["00", "04", "05", "16", "17", "23", "Unknown", None]
    df = spark.createDataFrame([(i, h, "2") for i, h in enumerate(hours)], "i int, hour string, day_of_week string")
    got = one(calendar.cyclical(calendar.add_time_period(df)).orderBy("i").select("time_period", "hour_sin", "dow_hour"))
    assert [g[0] for g in got] == ["late_night", "late_night", "early_morning", "daytime", "evening", "late_evening", "other", "other"]
    assert got[6][1] is None and got[7][2] is None
    assert got[1][1] == pytest.approx(math.sin(2 * math.pi * 4 / 24))


def test_days_of_both_cyclical_variants(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(1, 8)], "i int, day_of_week string")
    out = calendar.cyclical(df).withColumn("p", F.sin(calendar.report_phase("day_of_week", 7, 1))).orderBy("i").collect()
    # fixed values of the published day table
    assert [round(r["p"], 6) + 0.0 for r in out] == [0.0, 0.781831, 0.974928, 0.433884, -0.433884, -0.974928, -0.781831]
    assert [r["is_weekend"] for r in out] == [1, 0, 0, 0, 0, 0, 1]
    assert out[0]["dow_sin"] == pytest.approx(math.sin(2 * math.pi / 7))


def test_overlapping_periods_later_wins(spark):
    df = spark.createDataFrame([("5",)], "hour string")
    assert df.select(calendar.time_period(periods=[(0, 9, "a"), (5, 6, "b")])).first()[0] == "b"


def test_sample_weights(spark):
    df = spark.createDataFrame([("7", "03", 0), ("7", "10", 0), ("2", "03", 1), ("Unknown", "03", 0)],
                               "day_of_week string, hour string, clicked int")
    got = [r[0] for r in df.select(calendar.sample_weight(2, 3, 5)).collect()]
    assert got == [6.0, 2.0, 1.0, 1.0]
    assert [r[0] for r in df.select(calendar.sample_weight(positive_weight=4)).collect()] == [1.0, 1.0, 4.0, 1.0]


def test_missing_flags_and_fills(spark):
    df = spark.createDataFrame([(None, None, None), (1.0, None, None), (1.0, "a", 2)], "x double, y string, g int")
    out = missing.missing_flags(df, {"all": ["x", "y", "zz"], "only": ["g"], "none": ["zz"]})
    assert one(out.select("all", "only")) == [(1, 1), (0, 1), (0, 0)] and "none" not in out.columns
    filled = missing.fill_categories(df, ["y", "g", "zz"])
    assert one(filled.select("y", "g")) == [("Unknown", -1), ("Unknown", -1), ("a", 2)]
    assert dict(filled.dtypes)["g"] == "int"


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2.0, "s")], "a int, b double, c string").withColumn("t", F.lit(1).cast("byte"))
    assert columns.numeric_columns(df) == ["a", "b", "t"]
    assert columns.numeric_columns(df, ["a"], parity=True) == ["b"]
    assert columns.present(df, ["z", "b", "a"]) == ["b", "a"]
    with pytest.raises(ValueError, match="'z'"):
        columns.present(df, ["z"], on_missing="error")
    assert columns.feature_columns(df.withColumnRenamed("a", "clicked").withColumnRenamed("c", "seq")) == ["b", "t"]
    aligned = columns.align(df, ["b", "zz", "a"])
    assert aligned.columns == ["b", "zz", "a"] and one(aligned) == [(2.0, 0.0, 1.0)]
    assert one(df.select(columns.cast_fill("c"), columns.cast_fill("a"))) == [(0.0, 1.0)]
    assert columns.drop_columns(df, ["a", "none"]).columns == ["b", "c", "t"]


def test_feature_names(spark):
    names = ["history_a_7", "l_feat_12", "gender", "seq_len", "feat_b_1"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = one(df.select(columns.feature_group(F.col("n")), columns.trailing_index(F.col("n"))))
    assert got == [("history_a", 7), ("l_feat", 12), ("others", None), ("seq", None), ("feat_b", 1)]


def test_draws_do_not_depend_on_partitioning(spark):
    base = spark.range(2000).withColumnRenamed("id", "row_idx")
    cols = ["row_idx", keys.hash_fold(), keys.draw(), keys.hash_split()]
    first = sorted(one(base.select(*cols)))
    for parts in (1, 4, 13):
        assert sorted(one(base.repartition(parts).select(*cols))) == first
    folds = [r[1] for r in first]
    assert set(folds) == set(range(5)) and min(folds.count(k) for k in range(5)) > 320
    assert 0.17 < sum(r[3] for r in first) / 2000 < 0.23


def test_buckets_of_draws_are_monotone(spark):
    df = spark.range(500).withColumnRenamed("id", "row_idx").withColumn("u", keys.draw())
    out = df.select("u", keys.draw_bucket(F.col("u"), F.lit(7)).alias("b")).orderBy("u").collect()
    b = [r["b"] for r in out]
    assert b == sorted(b) and set(b) == set(range(7))


def test_row_functions_run_on_a_stream(spark, sf, tmp_path):
    schema = "row_idx long, seq string, day_of_week string, hour string"
    spark.createDataFrame([(1, "4,5,6", "7", "03")], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = calendar.cyclical(sequence.add_seq_features(stream)).select("seq_len", "is_weekend")
    q = out.writeStream.format("memory").queryName("scalars").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert one(spark.sql("select * from scalars")) == [(3, 1)]


def test_defaults_are_consistent():
    assert len(d.SEQ_BUCKETS) == 9 and len(d.SEQ_BUCKETS_REPORT) == 10
    assert len(d.MISSING_FLAGS["feat_a_all_missing"]) == 18 and len(d.COLLINEAR) == 11
