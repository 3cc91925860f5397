"""Reading tables and small artefacts."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import defaults as d
from clickloom.functions.columns import require_columns
from clickloom.operators.eda import table_summary
from clickloom.sources.files import read_text


def data_paths(root: str = "data", env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Data root, train and test path; DATA_ROOT, TRAIN_PATH and TEST_PATH override the defaults."""
    env = os.environ if env is None else env
    base = env.get("DATA_ROOT", root)
    return {
        "DATA_ROOT": base,
        "TRAIN_PATH": env.get("TRAIN_PATH", f"{base}/train.parquet"),
        "TEST_PATH": env.get("TEST_PATH", f"{base}/test.parquet"),
    }


def read_parquet(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A1-A3: a lazy scan, restricted to the listed columns, all of which must exist."""
    df = spark.read.parquet(path)
    if columns is None:
        return df
    columns = list(dict.fromkeys(columns))
    require_columns(df, columns, path)
    return df.select(*columns)


def with_row_key(df: DataFrame, key: str = d.ROW_KEY) -> DataFrame:
    """Insist on a stored unique key.

    Positions are not stable between Spark scans, so a missing key is an error and not generated.
    """
    require_columns(df, [key], "table (a stored unique row key is needed)")
    return df


def check_data(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows and columns of each readable table."""
    result = None
    for name, path in paths.items():
        if name == "DATA_ROOT":
            continue
        part = table_summary(spark.read.parquet(path)).select(F.lit(name).alias("table"), "num_rows", "num_columns")
        result = part if result is None else result.unionByName(part)
    return result


def fill_sample_submission(spark: SparkSession, csv_path: str, predictions: DataFrame, row_id: str = d.TEST_ID,
                           value: str = d.LABEL) -> DataFrame:
    """The ids of a sample submission with predicted values, matched by id and not by position."""
    ids = spark.read.option("header", True).csv(csv_path).select(row_id)
    scores = predictions.select(F.col(row_id).cast("string").alias(row_id), value)
    return ids.join(scores, row_id, "left")


def read_json_object(spark: SparkSession, path: str) -> dict:
    """A small metadata file."""
    return json.loads(read_text(spark, path))


def read_importances(spark: SparkSession, path: str, top: int | None = None) -> DataFrame:
    """Recorded importances as rows ``(kind, feature, value, std, position)``.

    Each kind is stored under ``<kind>_top30`` or ``<kind>_all``; the recorded order is kept.
    """
    raw = spark.read.option("multiLine", True).json(path)
    parts = []
    for kind, value in (("shap", "mean_abs_shap"), ("permutation", "mean_importance")):
        stored = [c for c in (f"{kind}_top30", f"{kind}_all") if c in raw.columns]
        if not stored:
            raise KeyError(f"no {kind} list in {path}")
        name = stored[0]
        fields = raw.schema[name].dataType.elementType.fieldNames()
        rows = raw.select(F.posexplode(name).alias("position", "r"))
        number = value if value in fields else next(f for f in fields if f != "feature")
        std = F.col("r.std_importance") if "std_importance" in fields else F.lit(None)
        parts.append(rows.select(
            F.lit(kind).alias("kind"), F.col("r.feature").alias("feature"),
            F.col(f"r.{number}").cast("double").alias("value"), std.cast("double").alias("std"), "position"))
    table = parts[0].unionByName(parts[1])
    return table if top is None else table.where(F.col("position") < top)
