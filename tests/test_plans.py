"""Physical plans: pruned scans, pushed filters, no shuffle of rows where statistics are small."""

import os

import pytest
from pyspark.sql import functions as F

from clickloom.functions import calendar
from clickloom.operators import correlation, eda, encode, lookup, sampling
from clickloom.operators.crossfit import SliceDelta, SliceDeltas
from clickloom.session import measure
from clickloom.sources import impressions as imp


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def table(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t.parquet")
    imp.train_part(imp.public(imp.impressions(spark, sf))).write.parquet(path)
    return spark.read.parquet(path)


def test_report_tables_read_two_columns(table):
    text = plan(eda.rates_by(table, ["hour"]))
    assert "ReadSchema: struct<clicked:int,hour:string>" in text


def test_head_limit_is_a_pushed_filter(table):
    text = plan(sampling.first_by_key(table, 100).select("clicked"))
    assert "LessThanOrEqual(row_idx,99)" in text and "ReadSchema: struct<row_idx:bigint,clicked:int>" in text
    assert "Exchange" not in text and "TakeOrdered" not in text


def test_label_filter_is_pushed(table):
    assert "EqualTo(clicked,1)" in plan(table.where(F.col("clicked") == 1).select("row_idx"))


def test_row_features_are_one_stage(table):
    text = plan(calendar.cyclical(calendar.add_time_period(table)))
    assert "Exchange" not in text and "Join" not in text


def test_downsample_reads_the_rows_once(table):
    text = plan(sampling.stratified_downsample(table, ["inventory_id", "hour"], 1.0))
    scans = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    # the sizes and limits, kept in memory, come from scans of the strata, label and key
    assert sum("feat_e_3" in line for line in scans) == 1
    assert "BroadcastHashJoin" in text.split("InMemoryTableScan")[0]


def test_encoding_broadcasts_counted_tables(table):
    model = encode.RateEncoder().fit(table)
    text = plan(model.transform_train(model.transform_frequency(table)))
    assert text.count("BroadcastHashJoin") >= 6 and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_scan_fits_all_deltas(table):
    df = table.withColumn("k", F.col("inventory_id"))
    model = SliceDeltas([SliceDelta("a", ("k",)), SliceDelta("b", ("gender", "hour"))], share_key="k").fit(df)
    assert "Expand" in plan(model.cells.df)
    assert "SortMergeJoin" not in plan(model.transform_new(df))


def test_pairs_come_from_one_scan(table):
    columns = ["feat_e_3", "history_a_6", "history_b_11", "history_b_22", "history_b_23"]
    text = plan(correlation.correlation_pairs(table, columns))
    assert text.count("\nScan") + text.count("Scan parquet") <= 3 and "MapInPandas" in text
    assert "ReadSchema: struct<feat_e_3:double" in text and "inventory_id" not in text


def test_attach_beyond_the_limit_spreads_hot_keys(spark):
    """Two thirds of the rows have one key, which the statistics do not know; half of the others one that they do."""
    rows = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("row_idx"), F.when(F.col("id") % 3 < 2, -1).when(F.col("id") % 2 == 0, 7).otherwise(
            F.when(F.col("id") % 5 > 0, F.col("id"))).alias("k"))
    stats = measure(spark.range(0, 30_000, 1, 4).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("w")))
    out = lookup.attach(rows, stats, ["k"], "w", broadcast_rows=0)
    assert out.columns == ["k", "row_idx", "v"] and out.count() == 30_000
    got = {r["k"]: (r["n"], r["v"]) for r in out.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v")).where(
        "k is null or k in (-1, 7)").collect()}
    assert got[-1] == (20_000, None) and got[7] == (5_000, 5_000) and got[None][1] is None
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup.attach(rows, stats, ["k"], "w", broadcast_rows=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the key that is hot is spread with its salt; the list of hot keys is broadcast
    assert "SortMergeJoin" in text and "_salt" in text and "BroadcastHashJoin" in text
    stats.release()


def test_long_text_keys_are_not_broadcast(spark, monkeypatch):
    stats = measure(spark.range(100).select(F.concat(F.repeat(F.lit("x"), 48), F.lpad(F.col("id").cast("string"), 2, "0")).alias("k"), F.lit(1).alias("v")))
    assert (stats.rows, stats.bytes) == (100, 5000)
    rows = spark.range(5).select(F.col("id").cast("string").alias("k"), F.col("id").alias("row_idx"))
    assert "BroadcastHashJoin" in plan(lookup.attach(rows, stats, ["k"]))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 4000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(lookup.attach(rows, stats, ["k"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stats.release()


def test_no_folders_or_tables_are_left(spark, tmp_path):
    from clickloom.session import Scratch, use_checkpoint_dir

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "feature1 string, feature2 string")
    folder = use_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = correlation.components(edges).collect()
    assert {(r["node"], r["component"]) for r in found} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    assert len([n for n in set(os.listdir(folder)) - before if n.startswith("clickloom-")]) == 1  # the result's own
    scratch = Scratch(spark)
    scratch.keep(edges)
    scratch.close()
    assert not os.path.exists(scratch.path.removeprefix("file:"))


@pytest.fixture
def a_task_per_file(spark):
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "128m")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("files", [5, 20])
def test_correlations_scan_in_as_many_tasks_as_the_table_has_parts(spark, sf, tmp_path, a_task_per_file, files):
    """The moments are merged behind a shuffle; one task reads neither the table nor the moments of many tasks."""
    columns = ["feat_a_1", "feat_e_3", "history_b_1"]
    imp.feature_table(spark, sf).select("clicked", *columns).repartition(files).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    for name, df in (("pairs", correlation.correlation_pairs(table, columns)),
                     ("targets", correlation.target_correlations(table, columns))):
        spark.sparkContext.setJobGroup(f"{name} {files}", name)
        try:
            assert df.count() == 3
        finally:
            spark.sparkContext.setJobGroup("", "")
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(f"{name} {files}")
                 for s in tracker.getJobInfo(j).stageIds]
        assert max(tasks) == files
        # beyond 16 tasks, their moments are merged in two levels
        assert (4 in tasks) == (files == 20)
