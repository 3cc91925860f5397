"""Writing tables and small artefacts."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import defaults as d
from clickloom.sources.files import write_text

METRIC_COLUMNS = ("run_id string, stage string, dataset string, ap double, logloss double, wll double, "
                  "competition_score double, notes string")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Zstd-compressed Parquet, one file per task."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(spark: SparkSession, path: str, data: dict) -> None:
    write_text(spark, path, json.dumps(data, indent=2, ensure_ascii=False, allow_nan=False))


def feature_metadata(train: DataFrame, test: DataFrame, config: dict, label: str = d.LABEL) -> dict:
    """Row counts, feature columns in order, and the configuration."""
    return {
        "train_rows": train.count(),
        "test_rows": test.count(),
        "feature_columns": [c for c in train.columns if c != label],
        "config": config,
    }


def append_features(metadata: dict, names: Iterable[str]) -> dict:
    """A10: feature names added at the end, each at most once."""
    have = metadata.get("feature_columns", [])
    return {**metadata, "feature_columns": list(dict.fromkeys([*have, *names]))}


def write_metrics_log(spark: SparkSession, path: str, rows: Sequence[dict]) -> None:
    """One row per stage with the fixed metric columns, appended as CSV."""
    names = [part.split()[0] for part in METRIC_COLUMNS.split(", ")]
    table = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], METRIC_COLUMNS)
    table.coalesce(1).write.mode("append").option("header", True).csv(path)


def write_oof(df: DataFrame, path: str, label: str = d.LABEL, key: str = d.ROW_KEY) -> None:
    """Held-out scores with their calibrated versions, keyed by row."""
    write_parquet(df.select(key, F.col(label), "raw_pred", "platt_pred", "isotonic_pred"), path)
