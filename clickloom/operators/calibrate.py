"""Probability calibration of a score column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom import defaults as d
from clickloom.operators.metrics import by_stage, metric_bundle
from clickloom.operators.order_stats import MOST_RANGES, cut_points, running_sums, with_range
from clickloom.session import ONE_TASK_ROWS, Scratch, measure


def temperature(score: Column, t: float = d.TEMPERATURE) -> Column:
    """M5: logit divided by ``t``; 0 and 1 stay as they are."""
    inner = F.when((score > 0) & (score < 1), score)
    return F.coalesce(1 / (1 + F.exp(-F.ln(inner / (1 - inner)) / F.lit(float(t)))), score)


def lower_hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The places of the vertices of the lower convex hull of points sorted by x, without points on its edges."""
    kept: list[int] = []
    for i in range(len(x)):
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            # the middle point stays only if it lies below the line between its neighbours
            if (y[b] - y[a]) * (x[i] - x[b]) < (y[i] - y[b]) * (x[b] - x[a]):
                break
            kept.pop()
        kept.append(i)
    return np.array(kept, np.int64)


def _hull_of(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("x", ignore_index=True)
    return group.iloc[lower_hull(group["x"].to_numpy(), group["y"].to_numpy())]


def isotonic_levels(cells: DataFrame, one_task_rows: int = ONE_TASK_ROWS, fan_in: int = 16) -> DataFrame:
    """The levels of the isotonic fit, as rows ``low, high, level`` (scores from low to high).

    ``cells`` has distinct ``_s`` with the sum of their labels ``_y`` and their rows ``_w``.  The fit is the slopes of
    the lower convex hull of the cumulative sums (rows, labels).  Each range of scores keeps its own hull; hulls of
    ``fan_in`` neighbouring ranges merge, level by level, into the hull of all.  With integer labels a hull of n rows has
    at most about n^(2/3) vertices, so the last merge is small whatever the scores are; a range holds about
    ``one_task_rows`` scores.
    """
    scratch = Scratch(cells.sparkSession)
    points = scratch.keep(cells.select(F.col("_s").alias("s"), F.col("_y").cast("double").alias("c"),
                                       F.col("_w").cast("double").alias("n")))
    count, groups = points.count(), 1
    cut = points.withColumn("s_range", F.lit(0))
    if count > one_task_rows:
        cuts = cut_points(points, ["s"], max(2, min(MOST_RANGES, -(-count // one_task_rows))))
        cut, groups = with_range(points, cuts), len(cuts["s"]) + 1
    upto = scratch.keep(running_sums(cut, "s_range", [F.col("s").asc()], {"x": "n", "y": "c"}))
    # every point ends the scores up to it; the hull begins before the smallest one
    schema = "g int, x double, y double, s double"
    hull = upto.select(F.col("s_range").alias("g"), "x", "y", "s").unionByName(
        cells.sparkSession.createDataFrame([(0, 0.0, 0.0, None)], schema))
    while True:
        hull = scratch.keep(hull.groupBy("g").applyInPandas(_hull_of, schema))
        if groups == 1:
            break
        groups = -(-groups // fan_in)
        hull = hull.withColumn("g", F.floor(F.col("g") / fan_in).cast("int"))
    order = Window.partitionBy("g").orderBy("x")  # the vertices of one hull
    edges = hull.withColumns({"px": F.lag("x").over(order), "py": F.lag("y").over(order)}).where("px is not null")
    # a level begins with the score that has as many rows before it as the vertex
    starts = upto.select((F.col("x") - F.col("n")).alias("px"), F.col("s").alias("low"))
    return edges.join(starts, "px").select("low", F.col("s").alias("high"), (
        (F.col("y") - F.col("py")) / (F.col("x") - F.col("px"))).alias("level"))


def _isotonic_model(spark, levels: DataFrame) -> IsotonicRegressionModel:
    """Spark ML's model of the levels: two boundaries per level, one where it covers a single score."""
    rows = levels.orderBy("low").collect()
    bounds = [(x, r["level"]) for r in rows for x in dict.fromkeys((r["low"], r["high"]))]
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    x, y = (gateway.new_array(gateway.jvm.double, len(bounds)) for _ in range(2))
    for i, (a, b) in enumerate(bounds):
        x[i], y[i] = float(a), float(b)
    old = jvm.org.apache.spark.mllib.regression.IsotonicRegressionModel(x, y, True)
    model = IsotonicRegressionModel(jvm.org.apache.spark.ml.regression.IsotonicRegressionModel("isotonic", old))
    return model.setFeaturesCol("_s")


@dataclass
class Calibrator:
    """Platt and isotonic calibration, fitted on distinct (score, label) cells instead of rows."""

    label: str = d.LABEL
    score: str = "score"
    max_iter: int = 1000

    def fit(self, df: DataFrame) -> "CalibrationModel":
        s, y = F.col(self.score).cast("double"), F.col(self.label).cast("double")
        cells = measure(df.groupBy(s.alias("_s"), y.alias("_y")).agg(F.count("*").cast("double").alias("_w")))
        n = cells.df.agg(F.sum("_w")).first()[0]
        assembled = VectorAssembler(inputCols=["_s"], outputCol="_x").transform(cells.df)
        # Spark minimises the mean loss, so the unit L2 penalty of a summed loss is 1/n here
        platt = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_w", regParam=1.0 / n,
                                   elasticNetParam=0.0, standardization=False, maxIter=self.max_iter,
                                   tol=1e-10).fit(assembled)
        # ties are one point, as isotonic regression needs one target per score
        points = cells.df.groupBy("_s").agg(F.sum(F.col("_y") * F.col("_w")).alias("_y"), F.sum("_w").alias("_w"))
        isotonic = _isotonic_model(df.sparkSession, isotonic_levels(points))
        cells.release()
        return CalibrationModel(self, platt, isotonic)


@dataclass
class CalibrationModel:
    spec: Calibrator
    platt: LogisticRegressionModel
    isotonic: IsotonicRegressionModel

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Add ``platt_pred`` and ``isotonic_pred``; isotonic scores outside the fitted range are clipped."""
        coef, intercept = float(self.platt.coefficients[0]), float(self.platt.intercept)
        s = F.col(self.spec.score).cast("double")
        df = df.withColumn(f"{prefix}platt_pred", 1 / (1 + F.exp(-(s * F.lit(coef) + F.lit(intercept)))))
        keyed = df.withColumn("_s", s)
        model = self.isotonic.copy()
        model.setPredictionCol(f"{prefix}isotonic_pred")
        return model.transform(keyed).drop("_s")

    def summary(self) -> dict:
        """J17."""
        bounds = self.isotonic.boundaries
        return {
            "platt_coef": [float(c) for c in self.platt.coefficients],
            "platt_intercept": [float(self.platt.intercept)],
            "isotonic_x_min": float(bounds[0]),
            "isotonic_x_max": float(bounds[-1]),
        }

    def stages(self, df: DataFrame) -> DataFrame:
        """Metric bundle of the raw, Platt and isotonic scores."""
        scored = self.transform(df)
        long = by_stage(scored, {"raw": self.spec.score, "platt": "platt_pred", "isotonic": "isotonic_pred"},
                        self.spec.label)
        return metric_bundle(long, self.spec.label, "score", ["stage"])


def probability(column: str = "probability") -> Column:
    """Positive-class probability out of a Spark ML probability vector."""
    return vector_to_array(F.col(column)).getItem(1)
