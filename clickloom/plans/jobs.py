"""Batch jobs: each reads tables, runs operators and writes its results (the command line is ``python -m clickloom``)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import defaults as d
from clickloom.functions.calendar import early_flag, in_slice, sample_weight
from clickloom.functions.columns import require_columns
from clickloom.operators import eda
from clickloom.operators.binning import BinModel, QuantileBinner, grid_columns
from clickloom.operators.calibrate import CalibrationModel, Calibrator
from clickloom.operators.crossfit import SliceDelta, SliceDeltaModel, SliceDeltas
from clickloom.operators.metrics import by_stage, metric_bundle
from clickloom.operators.sampling import (
    downsample_stats, first_by_key, sample_rows, strata_columns, stratified_downsample, stratified_folds,
)
from clickloom.operators.train import (
    BoostParams, FoldModels, Search, importance, load_frames, load_models, oof_metrics, submission, train_folds,
)
from clickloom.plans.preprocess import PreprocessConfig, Preprocessor
from clickloom.session import Scratch
from clickloom.sources import sinks, tables

DAY7_DELTAS = (
    SliceDelta("day7_ctr_delta_inv_hour", ("inventory_id_cat", "hour")),
    SliceDelta("day7_ctr_delta_seq_bucket", ("seq_len_bucket_cat",)),
)
SEQ_BUCKET_DELTA = (SliceDelta("day7_seq_bucket_delta", ("seq_len_bucket_cat",)),)
FOLD = "_delta_fold"


def _ints(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("int") for c in columns})


def preprocess(spark: SparkSession, train_path: str, test_path: str, output: str, embeddings_dir: str | None = None,
               sample_size: int | None = None, config: PreprocessConfig | None = None) -> dict:
    """F24 with A6 and A9: ``train_processed.parquet``, ``test_processed.parquet``, metadata.

    ``sample_size`` limits the training rows to the smallest keys, for trials; the test table is always whole.
    """
    config = config or PreprocessConfig()
    train = tables.with_row_key(spark.read.parquet(train_path), config.row_key)
    test = tables.with_row_key(spark.read.parquet(test_path), config.row_key)
    if sample_size:
        train = first_by_key(train, sample_size, config.row_key)
    emb = [None, None]
    if embeddings_dir:
        emb = [spark.read.parquet(f"{embeddings_dir}/{n}_seq_embeddings.parquet") for n in ("train", "test")]
    recipe = Preprocessor(config)
    # the sequence text is read once, here; everything after works on the narrow rows
    scratch = Scratch(spark)
    train, test = (scratch.keep(recipe.prepare(x)) for x in (train, test))
    model = recipe.fit(train, test, prepared=True)
    out = [f"{output}/train_processed.parquet", f"{output}/test_processed.parquet"]
    sinks.write_parquet(model.transform_train(train, emb[0], keep_key=True, prepared=True), out[0])
    sinks.write_parquet(model.transform_new(test, emb[1], keep_key=True, prepared=True), out[1])
    model.release()
    scratch.close()
    written = [spark.read.parquet(p) for p in out]
    meta = sinks.feature_metadata(written[0].drop(config.row_key), written[1], config.to_dict(), config.label)
    sinks.write_json(spark, f"{output}/preprocess_metadata.json", meta)
    return meta


def _augment(spark: SparkSession, frames: Sequence[DataFrame], output: str, metadata: str, names: Sequence[str]) -> dict:
    """Write both augmented frames and add the new names to the metadata (A10)."""
    for frame, name in zip(frames, ("train", "test")):
        sinks.write_parquet(frame, f"{output}/{name}_processed.parquet")
    meta = sinks.append_features(tables.read_json_object(spark, metadata), names)
    sinks.write_json(spark, f"{output}/preprocess_metadata.json", meta)
    return meta


def _deltas(spark, train_path, test_path, output, metadata, spec: SliceDeltas, needed) -> dict:
    train, test = spark.read.parquet(train_path), spark.read.parquet(test_path)
    require_columns(train, [*needed, d.LABEL], "train")
    require_columns(test, needed, "test")
    # click rates are left out by folds with equal shares of clicks
    train = stratified_folds(train, spec.folds, name=FOLD)
    model: SliceDeltaModel = replace(spec, fold=FOLD).fit(train)
    meta = _augment(spark, [model.transform_train(train).drop(FOLD), model.transform_new(test)], output, metadata,
                    model.names)
    model.release()
    return meta


def day7_features(spark: SparkSession, train_path: str, test_path: str, output: str, metadata: str,
                  folds: int = d.FOLDS) -> dict:
    """F14 for two key sets and the slice share D6; the frames keep all their columns, so nothing is re-joined."""
    spec = SliceDeltas(DAY7_DELTAS, share_key="inventory_id_cat", folds=folds)
    needed = [d.ROW_KEY, "day_of_week", "hour", "inventory_id_cat", "seq_len_bucket_cat"]
    return _deltas(spark, train_path, test_path, output, metadata, spec, needed)


def seq_bucket_delta(spark: SparkSession, train_path: str, test_path: str, output: str, metadata: str,
                     folds: int = d.FOLDS) -> dict:
    """F15."""
    needed = [d.ROW_KEY, "day_of_week", "seq_len_bucket_cat"]
    return _deltas(spark, train_path, test_path, output, metadata, SliceDeltas(SEQ_BUCKET_DELTA, folds=folds), needed)


def history_model(train: DataFrame, extra_keys: Sequence[str] = (), bins: int = d.HISTORY_BINS,
                  alpha: float = d.SMOOTHING_ALPHA, min_count: int = d.MIN_COUNT,
                  folds: int = d.FOLDS, fold: str | None = None) -> tuple[BinModel, SliceDeltaModel]:
    """Bin the history columns, then fit smoothed deltas per sequence bucket and grid cell.

    ``fold`` names a column with fold numbers; without it they are drawn by a hash of the row key.
    """
    extra = list(dict.fromkeys(extra_keys))
    columns = sorted({c for a, b, _ in d.HISTORY_PAIRS for c in (a, b)})
    require_columns(train, [d.ROW_KEY, d.LABEL, "day_of_week", "seq_len_bucket_cat", *extra, *columns], "train")
    binner = QuantileBinner(columns, bins).fit(train)
    deltas = [SliceDelta(name, ("seq_len_bucket_cat", *extra, f"{a}_{b}_bin_idx"), alpha, min_count)
              for a, b, name in d.HISTORY_PAIRS]
    gridded = with_grid(_ints(train, ["seq_len_bucket_cat", *extra]), binner)
    return binner, SliceDeltas(deltas, folds=folds, fold=fold).fit(gridded)


def with_grid(df: DataFrame, binner: BinModel) -> DataFrame:
    binned = binner.transform(df)
    return binned.withColumns(grid_columns(binner, [(a, b) for a, b, _ in d.HISTORY_PAIRS]))


def history_features(spark: SparkSession, train_path: str, test_path: str, output: str, metadata: str,
                     extra_keys: Sequence[str] = (), bins: int = d.HISTORY_BINS, alpha: float = d.SMOOTHING_ALPHA,
                     min_count: int = d.MIN_COUNT, folds: int = d.FOLDS) -> dict:
    """F17-F20 as a job; the frames keep their unfilled history columns."""
    train, test = spark.read.parquet(train_path), spark.read.parquet(test_path)
    train = stratified_folds(train, folds, name=FOLD)
    binner, model = history_model(train, extra_keys, bins, alpha, min_count, folds, FOLD)

    def augmented(df: DataFrame, add) -> DataFrame:
        raw = {f"_raw_{c}": F.col(c) for c in binner.columns}
        done = add(with_grid(df.withColumns(raw), binner))
        helpers = [f"{c}_bin" for c in binner.columns] + [f"{a}_{b}_bin_idx" for a, b, _ in d.HISTORY_PAIRS]
        return done.withColumns({c: F.col(f"_raw_{c}") for c in binner.columns}).drop(*helpers, *raw, FOLD)

    meta = _augment(spark, [augmented(train, model.transform_train), augmented(test, model.transform_new)],
                    output, metadata, model.names)
    info = {**binner.to_json_dict(), "pairs": model.names, "extra_keys": list(extra_keys),
            "smoothing_alpha": alpha, "min_count": min_count}
    sinks.write_json(spark, f"{output}/history_feature_metadata.json", info)
    model.release()
    return meta


def day7_flags(spark: SparkSession, train_path: str, test_path: str, output: str, metadata: str,
               threshold: int = d.EARLY_HOUR) -> dict:
    """F21."""
    frames = [spark.read.parquet(p) for p in (train_path, test_path)]
    for frame in frames:
        require_columns(frame, ["day_of_week", "hour"])
    name = "day7_early_hour_flag"
    return _augment(spark, [f.withColumn(name, early_flag(threshold)) for f in frames], output, metadata, [name])


def downsample(spark: SparkSession, train_path: str, output: str, metadata: str, ratio: float = d.NEGATIVE_RATIO,
               strata: Sequence[str] | None = None, seed: int = d.SEED) -> dict:
    """G1-G4."""
    train = tables.with_row_key(spark.read.parquet(train_path))
    columns = strata_columns(train, strata or d.STRATA)
    sinks.write_parquet(stratified_downsample(train, columns, ratio, seed=seed), output)
    stats = downsample_stats(train, spark.read.parquet(output), ratio).first().asDict()
    info = {"train_path": train_path, "output_path": output, "metadata_path": metadata, "negative_ratio": ratio,
            "strat_columns": columns, "random_seed": seed, **stats}
    sinks.write_json(spark, metadata, info)
    return info


def weighted(train: DataFrame, day_weight: float, early_weight: float, early_hour: int,
             positive_weight: float) -> tuple[DataFrame, str | None, dict]:
    """Weight column with its checks and a report of minimum, maximum and mean."""
    by_day = day_weight != 1.0
    by_hour = early_hour >= 0 and early_weight != 1.0
    if not (by_day or by_hour or positive_weight != 1.0):
        return train, None, {}
    needed = (["day_of_week"] if by_day or by_hour else []) + (["hour"] if by_hour else [])
    require_columns(train, needed, "train")
    value = sample_weight(day_weight if by_day else 1.0, early_weight if by_hour else 1.0,
                          early_hour if by_hour else -1, positive_weight) if needed else (
        F.when(F.col(d.LABEL) == 1, F.lit(float(positive_weight))).otherwise(1.0))
    out = train.withColumn("_weight", value)
    days = F.count_if(in_slice()) if needed else F.lit(1)
    row = out.agg(F.min("_weight").alias("min"), F.max("_weight").alias("max"), F.avg("_weight").alias("mean"),
                  days.alias("slice_rows")).first()
    if needed and row["slice_rows"] == 0:
        raise ValueError("no row lies in the slice, so the weights would have no effect")
    return out, "_weight", {k: row[k] for k in ("min", "max", "mean")}


def _run_id(name: str) -> str:
    return datetime.now(timezone.utc).strftime(f"%Y%m%d_%H%M%S_{name}")


def _write_stages(spark, path: str, run_id: str, dataset: str, stages, prefix: str, notes: str) -> None:
    sinks.write_metrics_log(spark, path, [
        {"run_id": run_id, "stage": f"{prefix}_{r['stage']}", "dataset": dataset, "ap": r["ap"],
         "logloss": r["logloss"], "wll": r["wll"], "competition_score": r["score"], "notes": notes} for r in stages])


def baseline(spark: SparkSession, train_path: str, test_path: str, output: str, params: BoostParams | None = None,
             sample_size: int | None = 500_000, folds: int = d.FOLDS, drop: Sequence[str] = ()) -> dict:
    """Fold models, held-out metrics and a submission.

    The models are fitted on at most ``sample_size`` rows, drawn by a hash of the row key (0 or less: all rows); the
    submission scores the whole test table.
    """
    params = params or BoostParams(min_data_in_leaf=200)
    train, test = load_frames(tables.with_row_key(spark.read.parquet(train_path)), spark.read.parquet(test_path), drop)
    if sample_size and sample_size > 0:
        train = sample_rows(train, sample_size)
    fitted = train_folds(stratified_folds(train, folds), params, folds, fold="fold")
    fitted.save(f"{output}/models")
    metrics = {r["stage"]: {k: r[k] for k in ("ap", "logloss", "wll", "score")} for r in oof_metrics(fitted.oof).collect()}
    sinks.write_json(spark, f"{output}/metrics.json", metrics)
    sinks.write_csv(submission(fitted, test), f"{output}/submission")
    fitted.release()
    return metrics


def train_and_calibrate(spark: SparkSession, train_path: str, test_path: str, output: str,
                        params: BoostParams | None = None, folds: int = d.FOLDS, day_weight: float = 1.0,
                        early_weight: float = 1.0, early_hour: int = -1, positive_weight: float = 1.0) -> dict:
    """The whole training chain: weights, fold models, calibration, three submissions, logs."""
    train, test = load_frames(tables.with_row_key(spark.read.parquet(train_path)), spark.read.parquet(test_path))
    train, weight, report = weighted(train, day_weight, early_weight, early_hour, positive_weight)
    fitted = train_folds(stratified_folds(train, folds), params or BoostParams(), folds, weight=weight, fold="fold")
    fitted.save(f"{output}/models")
    # the held-out scores are read several times below: write them once, uncalibrated
    sinks.write_parquet(fitted.oof, f"{output}/oof_raw.parquet")
    fitted.release()
    oof = spark.read.parquet(f"{output}/oof_raw.parquet")
    model: CalibrationModel = Calibrator(score="raw_pred").fit(oof)
    calibrated = model.transform(oof)
    sinks.write_oof(calibrated, f"{output}/oof.parquet")
    long = by_stage(spark.read.parquet(f"{output}/oof.parquet"),
                    {"raw": "raw_pred", "platt": "platt_pred", "isotonic": "isotonic_pred"})
    stages = metric_bundle(long, groups=["stage"]).collect()
    scores = fitted.score(test, [d.TEST_ID], "raw_pred")
    every = model.transform(scores)
    for name in ("raw", "platt", "isotonic"):
        ids = [d.TEST_ID] if d.TEST_ID in every.columns else []
        sinks.write_csv(every.select(*ids, F.col(f"{name}_pred").alias(d.LABEL)), f"{output}/submission_{name}")
    run_id = _run_id("calibrated")
    _write_stages(spark, f"{output}/metrics_log", run_id, train_path, stages, "calibrated", "boosted trees, calibrated")
    folds_table = {r["stage"]: r["score"] for r in oof_metrics(oof).collect()}
    summary = {"run_id": run_id, "calibration": model.summary(), "weights": report, "fold_scores": folds_table,
               "stages": {r["stage"]: {k: r[k] for k in ("ap", "logloss", "wll", "score")} for r in stages}}
    sinks.write_json(spark, f"{output}/metrics.json", summary)
    return summary


def tune(spark: SparkSession, train_path: str, output: str, trials: int = 10, folds: int = d.FOLDS,
         base: BoostParams | None = None, study: str = "search", test_path: str | None = None) -> BoostParams:
    """The best of several trials; with a test table it is refitted, calibrated and scored below ``output/best``."""
    train = spark.read.parquet(train_path).drop("seq")
    search = Search(f"{output}/trials.parquet", study, trials, base or BoostParams(), folds)
    best = search.run(stratified_folds(tables.with_row_key(train), folds), fold="fold")
    if test_path:
        train_and_calibrate(spark, train_path, test_path, f"{output}/best", best, folds)
    return best


def score_table(spark: SparkSession, data_path: str, models_path: str, output: str, folds: int = d.FOLDS) -> DataFrame:
    """Stored fold models over a whole table in one pass, written as ``row_idx, clicked, raw_pred``."""
    models = load_models(spark, models_path, folds)
    data = spark.read.parquet(data_path)
    require_columns(data, models.assembler.columns, "data")
    sinks.write_parquet(models.score(data, [d.ROW_KEY, d.LABEL]), output)
    return spark.read.parquet(output)


def feature_importance(models: FoldModels, top: int = 20) -> DataFrame:
    """J20."""
    return importance(models, top)


def eda_report(spark: SparkSession, train_path: str, output: str, sample_size: int = 0) -> str:
    """The report over all rows; ``sample_size`` limits the sequence sections to the smallest row keys."""
    train = spark.read.parquet(train_path)
    sample = train
    if sample_size > 0:
        require_columns(train, [d.ROW_KEY], "train")
        sample = first_by_key(train, sample_size)
    when = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")
    text = eda.report(train, sample, train_path, when)
    sinks.write_text(spark, output, text)
    return text
