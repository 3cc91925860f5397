"""Ranking and probability metrics of a score column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom import defaults as d
from clickloom.operators.order_stats import cut_points, ranges_for, running_sums, with_range
from clickloom.session import ONE_TASK_ROWS, measure

CLIP = 1e-15


def _losses(label: str, score: str) -> tuple[Column, Column]:
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(CLIP)), F.lit(1 - CLIP))
    return F.when(F.col(label) == 1, -F.ln(p)), F.when(F.col(label) == 0, -F.ln(1 - p))


def blend(ap: Column, wll: Column) -> Column:
    """Half average precision, half inverse weighted log-loss."""
    return F.lit(0.5) * ap + F.lit(0.5) / (F.lit(1.0) + wll)


def log_losses(df: DataFrame, label: str = d.LABEL, score: str = "score",
               groups: Iterable[str] = ()) -> DataFrame:
    """Log-loss, and log-loss with both classes weighted equally, in one pass.

    With pos_weight = n0 / max(n1, 1) the weighted loss is (pos_weight * L1 + L0) / (pos_weight * n1 + n0).
    """
    pos, neg = _losses(label, score)
    sums = df.groupBy(*groups).agg(
        F.coalesce(F.sum(pos), F.lit(0.0)).alias("_l1"), F.coalesce(F.sum(neg), F.lit(0.0)).alias("_l0"),
        F.count_if(F.col(label) == 1).cast("double").alias("_n1"),
        F.count_if(F.col(label) == 0).cast("double").alias("_n0"))
    pos_weight = F.col("_n0") / F.greatest(F.col("_n1"), F.lit(1.0))
    return sums.select(
        *groups,
        F.try_divide(F.col("_l1") + F.col("_l0"), F.col("_n1") + F.col("_n0")).alias("logloss"),
        F.try_divide(pos_weight * F.col("_l1") + F.col("_l0"), pos_weight * F.col("_n1") + F.col("_n0")).alias("wll"))


def average_precision(df: DataFrame, label: str = d.LABEL, score: str = "score", groups: Iterable[str] = (),
                      one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Sum over distinct scores, best first, of (recall gained) x (precision so far).

    Rows collapse to distinct scores in the partial aggregation.  If these are too many for one task, the
    cumulative counts are taken per score range with the totals of the better ranges added.
    """
    groups = list(groups)
    y = F.col(label).cast("bigint")
    counts = measure(df.groupBy(*groups, F.col(score).cast("double").alias("_s")).agg(
        F.sum(y).alias("_pos"), F.count("*").alias("_all")))
    best_first = [F.col("_s").desc()]
    if counts.rows <= one_task_rows:
        w = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(*best_first).rowsBetween(
            Window.unboundedPreceding, 0)
        ranked = counts.df.withColumns({"_tp": F.sum("_pos").over(w), "_seen": F.sum("_all").over(w)})
    else:
        cut = with_range(counts.df, cut_points(counts.df, ["_s"], ranges_for(counts.rows)))
        ranked = running_sums(cut, "_s_range", best_first, {"_tp": "_pos", "_seen": "_all"}, groups, descending=True)
    return ranked.groupBy(*groups).agg(
        F.try_divide(F.sum(F.col("_pos") * F.col("_tp") / F.col("_seen")), F.sum("_pos")).alias("ap"))


def metric_bundle(df: DataFrame, label: str = d.LABEL, score: str = "score",
                  groups: Iterable[str] = ()) -> DataFrame:
    """Ap, logloss, wll and blended score, one row per group (a short list such as stages)."""
    groups = list(groups)
    ap = average_precision(df, label, score, groups)
    ll = log_losses(df, label, score, groups)
    if groups:
        both = ll.join(F.broadcast(ap), groups, "left")
    else:
        both = ll.withColumn("ap", ap.scalar())
    return both.select(*groups, "ap", "logloss", "wll", blend(F.col("ap"), F.col("wll")).alias("score"))


def by_stage(df: DataFrame, stages: Mapping[str, str], label: str = d.LABEL) -> DataFrame:
    """Stack several prediction columns into rows ``(stage, label, score)``."""
    return df.select(label, F.inline(F.array(*[
        F.struct(F.lit(name).alias("stage"), F.col(c).cast("double").alias("score")) for name, c in stages.items()])))


def score_range(df: DataFrame, score: str = "score") -> DataFrame:
    """J22."""
    return df.agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"))
