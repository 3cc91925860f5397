"""The batch jobs end to end on derived impressions; files round-trip."""

import json

import pytest
from pyspark.sql import functions as F

from clickloom import __main__ as cli
from clickloom.operators.train import BoostParams
from clickloom.plans import jobs
from clickloom.sources import impressions as imp
from clickloom.sources import sinks, tables

PARAMS = BoostParams(learning_rate=0.3, max_depth=2, min_data_in_leaf=2, rounds=2, max_bins=8)


@pytest.fixture(scope="module")
def paths(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("data")
    df = imp.public(imp.impressions(spark, sf, True))
    out = {"base": str(base), "train": f"{base}/train.parquet", "test": f"{base}/test.parquet"}
    imp.train_part(df).write.parquet(out["train"])
    imp.test_part(df).write.parquet(out["test"])
    return out


@pytest.fixture(scope="module")
def processed(spark, paths):
    out = f"{paths['base']}/processed"
    meta = jobs.preprocess(spark, paths["train"], paths["test"], out)
    return {"train": f"{out}/train_processed.parquet", "test": f"{out}/test_processed.parquet",
            "meta": f"{out}/preprocess_metadata.json", "info": meta}


def test_preprocess(spark, paths, processed):
    raw, done = spark.read.parquet(paths["train"]), spark.read.parquet(processed["train"])
    assert done.count() == raw.count() == processed["info"]["train_rows"]
    new = spark.read.parquet(processed["test"])
    assert set(done.columns) - set(new.columns) == {"clicked"}
    assert set(new.columns) - set(done.columns) == {"ID"}
    assert not {"seq", "gender", "inventory_id", "time_period", "_fold", "gender__X__age_group"} & set(done.columns)
    stored = tables.read_json_object(spark, processed["meta"])
    assert stored["feature_columns"] == [c for c in done.columns if c not in ("clicked", "row_idx")]
    assert stored["config"]["folds"] == 5
    assert done.where("inventory_id__X__gender_te is null or gender_freq is null or inventory_id_cat is null").count() == 0


def test_preprocess_with_embeddings_and_a_sample(spark, paths, tmp_path):
    for name in ("train", "test"):
        keys = spark.read.parquet(paths[name]).select("row_idx").where("row_idx % 2 = 0")
        keys.withColumn("e0", F.lit(1.5)).write.parquet(str(tmp_path / "emb" / f"{name}_seq_embeddings.parquet"))
    jobs.preprocess(spark, paths["train"], paths["test"], str(tmp_path / "out"), str(tmp_path / "emb"), sample_size=100)
    out = spark.read.parquet(str(tmp_path / "out/train_processed.parquet"))
    assert out.count() == 100 and out.where("e0 is null").count() == 50


def test_feature_jobs(spark, processed, tmp_path):
    train = spark.read.parquet(processed["train"])
    steps = [
        (jobs.day7_features, {}, ["day7_ctr_delta_inv_hour", "day7_ctr_delta_seq_bucket", "day7_freq_ratio_inv"]),
        (jobs.seq_bucket_delta, {}, ["day7_seq_bucket_delta"]),
        (jobs.history_features, {"extra_keys": ["gender_cat"], "bins": 3, "min_count": 2},
         ["day7_hist_a6_b11_delta", "day7_hist_a6_b22_delta", "day7_hist_a6_b23_delta"]),
        (jobs.day7_flags, {"threshold": 5}, ["day7_early_hour_flag"]),
    ]
    at = dict(processed)
    for i, (job, options, names) in enumerate(steps):
        out = str(tmp_path / str(i))
        before = spark.read.parquet(at["train"]).columns
        meta = job(spark, at["train"], at["test"], out, at["meta"], **options)
        at = {"train": f"{out}/train_processed.parquet", "test": f"{out}/test_processed.parquet",
              "meta": f"{out}/preprocess_metadata.json"}
        done = spark.read.parquet(at["train"])
        assert set(done.columns) == {*before, *names} and done.count() == train.count()
        assert set(names) <= set(spark.read.parquet(at["test"]).columns)
        assert meta["feature_columns"][-len(names):] == names
        assert done.where(" or ".join(f"{n} is null" for n in names)).count() == 0
    same = spark.read.parquet(at["train"]).select(*train.columns)
    assert sorted(map(str, same.select("row_idx", "history_a_6").collect())) == sorted(map(str, train.select("row_idx", "history_a_6").collect()))
    info = tables.read_json_object(spark, str(tmp_path / "2/history_feature_metadata.json"))
    assert info["extra_keys"] == ["gender_cat"] and set(info["inner_edges"]) == {
        "history_a_6", "history_b_11", "history_b_22", "history_b_23"}


def test_required_columns(spark, paths, tmp_path):
    with pytest.raises(ValueError, match="seq_len_bucket_cat"):
        jobs.seq_bucket_delta(spark, paths["train"], paths["test"], str(tmp_path), "none")
    with pytest.raises(ValueError, match="row key"):
        tables.with_row_key(spark.range(3))


def test_downsample(spark, paths, tmp_path):
    info = jobs.downsample(spark, paths["train"], str(tmp_path / "d.parquet"), str(tmp_path / "d.json"), ratio=1.0)
    out = spark.read.parquet(str(tmp_path / "d.parquet"))
    assert info["strat_columns"] == ["inventory_id", "day_of_week", "hour"]
    assert out.where("clicked = 1").count() == info["total_pos"] and out.where("clicked = 0").count() == info["actual_neg"]
    assert json.loads((tmp_path / "d.json").read_text()) == info


def test_training_jobs(spark, processed, tmp_path):
    metrics = jobs.baseline(spark, processed["train"], processed["test"], str(tmp_path / "b"), PARAMS, sample_size=500, folds=2)
    assert set(metrics) == {"fold_1", "fold_2", "overall"}
    csv = spark.read.option("header", True).csv(str(tmp_path / "b/submission"))
    test_rows = spark.read.parquet(processed["test"]).count()
    assert csv.columns == ["ID", "clicked"] and csv.count() == test_rows

    out = str(tmp_path / "t")
    summary = jobs.train_and_calibrate(spark, processed["train"], processed["test"], out, PARAMS, folds=2,
                                       day_weight=2.0, early_weight=3.0, early_hour=5, positive_weight=1.5)
    assert set(summary["stages"]) == {"raw", "platt", "isotonic"}
    assert summary["weights"]["max"] >= 6.0 and summary["weights"]["min"] == 1.0
    oof = spark.read.parquet(f"{out}/oof.parquet")
    assert oof.columns == ["row_idx", "clicked", "raw_pred", "platt_pred", "isotonic_pred"]
    assert oof.count() == spark.read.parquet(processed["train"]).count()
    log = spark.read.option("header", True).csv(f"{out}/metrics_log")
    assert {r["stage"] for r in log.collect()} == {"calibrated_raw", "calibrated_platt", "calibrated_isotonic"}
    for name in ("raw", "platt", "isotonic"):
        assert spark.read.option("header", True).csv(f"{out}/submission_{name}").count() == test_rows

    scored = jobs.score_table(spark, processed["train"], f"{out}/models", f"{out}/scored.parquet", folds=2)
    assert scored.columns == ["row_idx", "clicked", "raw_pred"] and scored.count() == oof.count()
    with pytest.raises(ValueError, match="slice"):
        jobs.weighted(spark.read.parquet(processed["train"]).where("day_of_week <> '7'"), 2.0, 1.0, -1, 1.0)
    best = jobs.tune(spark, processed["train"], str(tmp_path / "s"), trials=1, folds=2, base=PARAMS)
    assert best.rounds == PARAMS.rounds


def test_report_and_command_line(spark, paths, tmp_path, capsys, monkeypatch):
    cli.main(["eda-report", "--train-path", paths["train"], "--output", str(tmp_path / "r.md"), "--sample-size", "200"])
    assert "## Clicks by hour" in (tmp_path / "r.md").read_text()
    monkeypatch.setenv("DATA_ROOT", paths["base"])
    cli.main(["check-data"])
    rows = spark.read.parquet(paths["train"]).count()
    assert str(rows) in capsys.readouterr().out
    found = tables.data_paths("x", {"TRAIN_PATH": "t"})
    assert found == {"DATA_ROOT": "x", "TRAIN_PATH": "t", "TEST_PATH": "x/test.parquet"}
    for job in cli.JOBS:
        with pytest.raises(SystemExit) as stop:
            cli.main([job, "--help"])
        assert stop.value.code == 0


def test_small_files(spark, tmp_path):
    meta = sinks.append_features({"feature_columns": ["a", "b"]}, ["b", "c", "c"])
    assert meta["feature_columns"] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        sinks.write_json(spark, str(tmp_path / "x.json"), {"v": float("inf")})
    (tmp_path / "sample.csv").write_text("ID,clicked\nt2,0\nt1,0\nt3,0\n")
    scores = spark.createDataFrame([("t1", 0.1), ("t2", 0.2)], "ID string, clicked double")
    got = {r["ID"]: r["clicked"] for r in tables.fill_sample_submission(spark, str(tmp_path / "sample.csv"), scores).collect()}
    assert got == {"t1": 0.1, "t2": 0.2, "t3": None}


@pytest.mark.parametrize("suffix", ["top30", "all"])
def test_importance_files(spark, tmp_path, suffix):
    data = {"sample_size": 3, "base_metrics": {"ap": 0.5, "wll": 0.4, "score": 0.6},
            f"shap_{suffix}": [{"feature": "a", "mean_abs_shap": 0.2}, {"feature": "b", "mean_abs_shap": 0.1}],
            f"permutation_{suffix}": [{"feature": "b", "mean_importance": 0.3, "std_importance": 0.01}]}
    (tmp_path / "i.json").write_text(json.dumps(data))
    got = tables.read_importances(spark, str(tmp_path / "i.json"), 1).collect()
    assert [(r["kind"], r["feature"], r["value"], r["std"]) for r in got] == [("shap", "a", 0.2, None), ("permutation", "b", 0.3, 0.01)]
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(KeyError):
        tables.read_importances(spark, str(tmp_path / "bad.json"))


def test_boosting_options_reach_the_job():
    args = vars(cli.parser().parse_args(["train", "--train-path", "a", "--test-path", "b", "--output", "c", "--rounds", "7",
                                         "--learning-rate", "0.2", "--patience", "3"]))
    made = cli.job_arguments({k: v for k, v in args.items() if k != "job"})
    assert made["params"] == BoostParams(rounds=7, learning_rate=0.2, patience=3)
    plain = vars(cli.parser().parse_args(["tune", "--train-path", "a", "--output", "c"]))
    assert cli.job_arguments({k: v for k, v in plain.items() if k != "job"}).get("base") is None
