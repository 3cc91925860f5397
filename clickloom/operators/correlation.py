"""Correlation tables and the feature-selection analyses on top of them.

One scan builds the table of all pairs.  What follows works on tables with one row per feature or per
feature pair, so their size depends on the number of columns only.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom import defaults as d
from clickloom.functions.columns import feature_group, trailing_index
from clickloom.functions.special import chi_square_tail
from clickloom.session import Scratch

def _within_one(r: Column) -> Column:
    # least and greatest skip nulls, and an undefined correlation has to stay null
    return F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))


# Columns of a tile.  A task holds the moments of one pair of tiles.
TILE = 512
PAIRS = "feature1 string, feature2 string, correlation double"


# Shifts of the left and of the right columns, and six matrices of moments.
Moments = tuple[np.ndarray, np.ndarray, np.ndarray]


def _shifted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns less their medians (0 where missing), where they are present, and the medians (NaN of an empty column).

    Shifted before they are squared, offsets cost no digits and constants leave exact zeros.
    """
    there = ~np.isnan(values)
    shift = np.array([np.median(v[ok]) if ok.any() else np.nan for v, ok in zip(values.T, there.T)])
    with np.errstate(all="ignore"):
        return np.where(there, values - shift, 0.0), there.astype(np.float64), shift


def _batch_moments(left: np.ndarray, right: np.ndarray) -> Moments:
    """n, means, squared deviations and co-deviations of all pairs of a left and a right column of a batch, over the rows
    where both are present.

    Six matrices, a row per left and a column per right column: the second and fourth are about the left, the third and
    fifth about the right column, in the rows of the pair.  Means are those of the shifted columns.
    """
    x, in_x, shift_x = _shifted(left)
    y, in_y, shift_y = (x, in_x, shift_x) if right is left else _shifted(right)
    with np.errstate(all="ignore"):
        n, sx, sy = in_x.T @ in_y, x.T @ in_y, in_x.T @ y
        safe = np.maximum(n, 1)
        mean_x, mean_y = sx / safe, sy / safe
        return shift_x, shift_y, np.stack((
            n, mean_x, mean_y, np.maximum((x * x).T @ in_y - sx * mean_x, 0.0),
            np.maximum(in_x.T @ (y * y) - sy * mean_y, 0.0), x.T @ y - sx * mean_y))


def _no_moments(left: int, right: int) -> Moments:
    return np.full(left, np.nan), np.full(right, np.nan), np.zeros((6, left, right))


def _merged(one: Moments, two: Moments) -> Moments:
    """The moments of two sets of rows together, by the pairwise update of means and deviations.

    Shifts are kept apart from the means, which would lose the digits of large offsets with every update.
    """
    (*shifts, a), (*others, b) = one, two
    n = a[0] + b[0]
    with np.errstate(all="ignore"):
        shift_x, shift_y = (np.where(np.isnan(s), t, s) for s, t in zip(shifts, others))
        share = np.where(n > 0, b[0] / np.maximum(n, 1), 0.0)
        weight = a[0] * share
        near = (b[1] + (others[0] - shift_x)[:, None], b[2] + (others[1] - shift_y)[None])
        # the mean of an empty side is no value
        dx, dy = (np.where((a[0] > 0) & (b[0] > 0), m - a[k], 0.0) for k, m in zip((1, 2), near))
        mean = [np.where(a[0] > 0, a[k] + d * share, np.where(b[0] > 0, m, 0.0)) for k, d, m in zip((1, 2), (dx, dy), near)]
        return shift_x, shift_y, np.stack((n, *mean, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight,
                                           a[5] + b[5] + dx * dy * weight))


def _to_bytes(moments: Moments) -> bytes:
    return b"".join(part.tobytes() for part in moments)


def _from_bytes(raw: bytes, left: int, right: int) -> Moments:
    shift_x, shift_y, m = np.split(np.frombuffer(raw), (left, left + right))
    return shift_x, shift_y, m.reshape(6, left, right)


def _moments(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """One row ``m``: the merged moments of all pairs of a left and a right column.

    Every task adds up its batches to one row of shifts and six matrices; these are merged in two levels, so no task
    reads more than about the square root of their number.  Both levels are behind a shuffle: ``coalesce`` would pull
    the scan itself into its one task.
    """
    same = list(left) == list(right)
    n_left, n_right = len(left), len(right)
    columns = list(left) if same else [*left, *right]
    numbers = df.select([F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = _no_moments(n_left, n_right)
        for batch in batches:
            if len(batch):
                values = batch.to_numpy(dtype=np.float64, na_value=np.nan)
                x = values[:, :n_left]
                total = _merged(total, _batch_moments(x, x if same else values[:, n_left:]))
        yield pd.DataFrame({"m": [_to_bytes(total)]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = _no_moments(n_left, n_right)
        for batch in batches:
            for raw in batch["m"]:
                total = _merged(total, _from_bytes(raw, n_left, n_right))
        yield pd.DataFrame({"m": [_to_bytes(total)]})

    parts = numbers.mapInPandas(scan, "m binary")
    tasks = parts.rdd.getNumPartitions()
    if tasks > 16:
        parts = parts.repartition(math.isqrt(tasks)).mapInPandas(add, "m binary")
    return parts.repartition(1).mapInPandas(add, "m binary")


def _tile_pairs(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Correlations of one pair of tiles; of a tile with itself those above the diagonal."""
    same = left == right

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["m"]:
                n, _, _, vx, vy, co = _from_bytes(raw, len(left), len(right))[2]
                i, j = np.triu_indices(len(left), k=1) if same else (x.ravel() for x in np.indices(n.shape))
                if not len(i):
                    continue
                with np.errstate(all="ignore"):
                    r = np.where((n > 1) & (vx > 0) & (vy > 0), co / np.sqrt(vx) / np.sqrt(vy), np.nan)[i, j]
                yield pd.DataFrame({"feature1": [left[k] for k in i], "feature2": [right[k] for k in j],
                                    "correlation": pd.array([None if np.isnan(v) else v for v in r], "Float64")})

    return _moments(df, left, right).mapInPandas(pairs, PAIRS)


def _by_moments(df: DataFrame, columns: Sequence[str], tile: int) -> DataFrame:
    """All pairs: a scan per pair of tiles, of the columns of these two only."""
    columns = list(columns)
    tiles = [columns[i:i + tile] for i in range(0, len(columns), tile)]
    if not tiles:
        return df.sparkSession.createDataFrame([], PAIRS)
    rows = reduce(DataFrame.unionByName, [_tile_pairs(df, a, b) for i, a in enumerate(tiles) for b in tiles[i:]])
    return rows.withColumn("correlation", _within_one(F.col("correlation")))


def correlation_pairs(df: DataFrame, columns: Sequence[str], tile: int = TILE) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both are present; one scan up to ``tile`` columns.

    More columns are cut into tiles.  Every pair of tiles is a scan of its own columns, so that a task's memory is
    bounded by the tile and not by the number of columns.

    Rows ``(feature1, feature2, correlation)`` for the upper triangle in list order.  Nulls and NaN are missing; the
    correlation is null when a column is constant in the rows of the pair, infinite, or present in fewer than two.
    """
    return _by_moments(df, columns, tile)


def target_correlations(df: DataFrame, columns: Sequence[str], target: str = d.LABEL, tile: int = TILE) -> DataFrame:
    """K6: ``(feature, correlation, abs_correlation)`` with the target; only pairs with the target are computed."""
    others = [c for c in columns if c != target]
    if not others:
        return _with_target(df.sparkSession.createDataFrame([], PAIRS), target)
    rows = reduce(DataFrame.unionByName, [
        _tile_pairs(df, others[i:i + tile], [target]) for i in range(0, len(others), tile)])
    return _with_target(rows.withColumn("correlation", _within_one(F.col("correlation"))), target)


def _with_target(pairs: DataFrame, target: str) -> DataFrame:
    own = pairs.where(F.col("feature2") == target)
    return own.select(F.col("feature1").alias("feature"), "correlation", F.abs("correlation").alias("abs_correlation"))


@dataclass
class CorrelationTables:
    """Feature pairs and target correlations from one scan, kept: a row per pair is small and read often."""

    pairs: DataFrame
    targets: DataFrame
    kept: DataFrame

    def release(self) -> None:
        self.kept.unpersist()


def correlation_tables(df: DataFrame, columns: Sequence[str], target: str = d.LABEL) -> CorrelationTables:
    columns = [c for c in columns if c != target]
    kept = correlation_pairs(df, [*columns, target]).persist()
    return CorrelationTables(kept.where(F.col("feature2") != target), _with_target(kept, target), kept)


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair in both directions."""
    return pairs.unionByName(pairs.select(
        F.col("feature2").alias("feature1"), F.col("feature1").alias("feature2"), "correlation"))


def strong_pairs(pairs: DataFrame, threshold: float = 0.7, below: float | None = None) -> DataFrame:
    """K2/K3: pairs with ``threshold <= abs(r)`` (and ``abs(r) < below``), strongest first."""
    size = F.abs("correlation")
    kept = pairs.where(size >= threshold)
    if below is not None:
        kept = kept.where(size < below)
    return kept.orderBy(F.desc(size), "feature1", "feature2")


def band_counts(pairs: DataFrame, edges: Sequence[float] = (0.5, 0.7, 0.9, 0.99)) -> DataFrame:
    """K3: number of pairs per band of ``abs(r)``; the last band is open."""
    size = F.abs("correlation")
    bands = []
    for low, high in zip(edges, [*edges[1:], None]):
        test = size >= low if high is None else (size >= low) & (size < high)
        name = f">={low}" if high is None else f"{low}-{high}"
        bands.append(F.struct(F.lit(name).alias("band"), F.count_if(test).alias("pairs")))
    return pairs.agg(F.array(*bands).alias("b")).select(F.inline("b"))


def subset_summary(pairs: DataFrame, features: Sequence[str]) -> DataFrame:
    """K4: pair count and mean correlation inside a feature list."""
    inside = F.col("feature1").isin(*features) & F.col("feature2").isin(*features)
    return pairs.where(inside).agg(F.count("*").alias("pairs"), F.avg("correlation").alias("mean_correlation"))


def subset_pairs(pairs: DataFrame, features: Sequence[str]) -> DataFrame:
    return pairs.where(F.col("feature1").isin(*features) & F.col("feature2").isin(*features))


def group_pairs(pairs: DataFrame, threshold: float = 0.6, groups: Sequence[str] = d.FEATURE_GROUPS) -> DataFrame:
    """K5: strong pairs whose two features share a prefix group."""
    labelled = pairs.withColumns({"group": feature_group(F.col("feature1"), groups),
                                  "_other": feature_group(F.col("feature2"), groups)})
    return labelled.where((F.col("group") == F.col("_other")) & (F.abs("correlation") >= threshold)).drop("_other")


def top_partners(pairs: DataFrame, features: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` strongest partners of each listed feature outside the list."""
    w = Window.partitionBy("feature1").orderBy(F.desc(F.abs("correlation")), "feature2")
    wanted = both_ways(pairs).where(F.col("feature1").isin(*features) & ~F.col("feature2").isin(*features))
    return wanted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked_targets(targets: DataFrame) -> DataFrame:
    """Rank of every feature by ``abs(r)`` with the target; one row per feature."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("abs_correlation"), "feature")
    return targets.withColumn("rank", F.row_number().over(w))


def extremes(targets: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` strongest and the ``n`` weakest features."""
    ranked = ranked_targets(targets).withColumn("_last", F.count("*").over(Window.partitionBy(F.lit(0))))
    return ranked.select("feature", "correlation", "rank", (F.col("rank") <= n).alias("is_top"),
                         (F.col("rank") > F.col("_last") - n).alias("is_bottom")).where("is_top or is_bottom")


def interaction_candidates(pairs: DataFrame, targets: DataFrame, top: int = 20, min_target: float = 0.01,
                           max_pair: float = 0.3, min_each: float = 0.005) -> DataFrame:
    """K7: weakly correlated pairs among the features that correlate best with the target."""
    strong = ranked_targets(targets.where(F.col("abs_correlation") > min_target)).where(F.col("rank") <= top)
    side = strong.where(F.col("abs_correlation") > min_each)
    one = side.select(F.col("feature").alias("feature1"), F.col("abs_correlation").alias("feat1_target_corr"))
    two = side.select(F.col("feature").alias("feature2"), F.col("abs_correlation").alias("feat2_target_corr"))
    size = F.abs("correlation")
    return (
        pairs.where(size < max_pair).join(one, "feature1").join(two, "feature2")
        .select("feature1", "feature2", size.alias("feature_correlation"), "feat1_target_corr", "feat2_target_corr",
                ((F.col("feat1_target_corr") + F.col("feat2_target_corr")) * (1 - size)).alias("interaction_score"))
    )


def cross_group_candidates(candidates: DataFrame, among: int = 20, n: int = 10,
                           groups: Sequence[str] = d.FEATURE_GROUPS) -> DataFrame:
    """K8: of the ``among`` best candidates, the first ``n`` that join two different groups."""
    order = [F.desc("interaction_score"), F.asc("feature1"), F.asc("feature2")]
    best = candidates.orderBy(*order).limit(among)
    return best.withColumns({
        "group1": feature_group(F.col("feature1"), groups), "group2": feature_group(F.col("feature2"), groups),
    }).where(F.col("group1") != F.col("group2")).orderBy(*order).limit(n).select(
        "feature1", "group1", "feature2", "group2", "interaction_score")


def named_pairs(pairs: DataFrame, targets: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """K9: correlation and target correlations of given pairs, with the names that are absent."""
    spark = pairs.sparkSession
    names = spark.createDataFrame(list(wanted), "feature1 string, feature2 string")
    known = targets.select("feature", F.col("correlation").alias("_t"))
    found = (
        names.join(both_ways(pairs), ["feature1", "feature2"], "left")
        .join(known.select(F.col("feature").alias("feature1"), F.col("_t").alias("target_corr1"),
                           F.lit(True).alias("_has1")), "feature1", "left")
        .join(known.select(F.col("feature").alias("feature2"), F.col("_t").alias("target_corr2"),
                           F.lit(True).alias("_has2")), "feature2", "left")
    )
    absent = F.concat_ws(",", F.when(F.col("_has1").isNull(), F.col("feature1")),
                         F.when(F.col("_has2").isNull(), F.col("feature2")))
    return found.select("feature1", "feature2", "correlation", "target_corr1", "target_corr2",
                        absent.alias("missing"))


def components(edges: DataFrame, a: str = "feature1", b: str = "feature2") -> DataFrame:
    """Connected components as ``(node, component)``; a component is named by its smallest node.

    Every round takes the smallest label among the neighbours and then the label of that label, so chains
    shrink fast; each round is written out, which keeps the plan short.
    """
    spark = edges.sparkSession
    fixed, last = Scratch(spark), Scratch(spark)
    one = edges.select(F.col(a).alias("node"), F.col(b).alias("near"))
    links = fixed.keep(one.unionByName(one.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct())
    labels = last.keep(links.groupBy("node").agg(F.least("node", F.min("near")).alias("label")))
    while True:
        seen = links.join(labels.select(F.col("node").alias("near"), "label"), "near").groupBy("node").agg(
            F.min("label").alias("around"))
        moved = labels.join(seen, "node").select("node", "label", F.least("label", "around").alias("via"))
        # the label is itself a node: take the label that node has by now
        jump = moved.select(F.col("node").alias("via"), F.col("via").alias("far"))
        now = Scratch(spark)
        moved = now.keep(moved.join(jump, "via").select("node", "label", F.least("via", "far").alias("next")))
        labels = moved.select("node", F.col("next").alias("label"))
        last.close()
        last = now
        if moved.where(F.col("next") != F.col("label")).isEmpty():
            fixed.close()
            return labels.withColumnRenamed("label", "component")


def redundancy_groups(pairs: DataFrame, targets: DataFrame, threshold: float = 0.99) -> DataFrame:
    """Groups of nearly equal features; the one closest to the target is kept, the rest dropped.

    Groups are connected components, so a feature is in one group whatever the order of the pairs.
    """
    members = components(pairs.where(F.abs("correlation") >= threshold))
    w = Window.partitionBy("component").orderBy(F.desc("_abs"), "feature")
    return (
        members.select(F.col("node").alias("feature"), "component").join(targets, "feature", "left")
        .withColumn("_abs", F.coalesce("abs_correlation", F.lit(0.0)))
        .withColumn("keep", F.row_number().over(w) == 1)
        .select("component", "feature", F.coalesce("correlation", F.lit(0.0)).alias("correlation"), "keep")
    )


def target_classes(targets: DataFrame, high: float = 0.11, low: float = 0.105) -> DataFrame:
    """Features per strength class, names in order of strength."""
    size = F.col("abs_correlation")
    name = F.when(size >= high, "high").when(size >= low, "medium").when(size < low, "low")
    items = F.array_sort(F.collect_list(F.struct((-size).alias("s"), F.col("feature").alias("f"))))
    return targets.withColumn("class", name).where(F.col("class").isNotNull()).groupBy("class").agg(
        F.count("*").alias("features"), F.array_join(F.transform(items, lambda t: t["f"]), ",").alias("names"))


def distribution(values: DataFrame, column: str = "correlation") -> DataFrame:
    """Spread of ``abs(r)``; std is the population one, cv its ratio to the mean."""
    table = values.select(F.abs(column).alias("v")).where(F.col("v").isNotNull())
    p = F.percentile("v", F.array(*[F.lit(q) for q in (0.9, 0.95, 0.99)]))
    return table.agg(
        F.avg("v").alias("mean"), F.percentile("v", F.lit(0.5)).alias("median"), F.stddev_pop("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"), p.alias("_p"),
    ).select("mean", "median", "std", "min", "max", F.try_divide("std", "mean").alias("cv"),
             F.col("_p")[0].alias("p90"), F.col("_p")[1].alias("p95"), F.col("_p")[2].alias("p99"))


def top_bottom_gap(targets: DataFrame, top: int = 5) -> DataFrame:
    """Mean strength of the ``top`` features against all others, and the uplift in percent."""
    ranked = ranked_targets(targets)
    means = ranked.agg(F.avg(F.when(F.col("rank") <= top, F.col("abs_correlation"))).alias("top_mean"),
                       F.avg(F.when(F.col("rank") > top, F.col("abs_correlation"))).alias("rest_mean"))
    gap = F.col("top_mean") - F.col("rest_mean")
    return means.select("top_mean", "rest_mean", gap.alias("difference"),
                        (F.try_divide(gap, F.col("rest_mean")) * 100).alias("uplift_pct"))


def post_drop_check(pairs: DataFrame, dropped: Sequence[str], total: int,
                    thresholds: Sequence[float] = (0.7, 0.99)) -> DataFrame:
    """Strong pairs left once the listed features are gone, and the reduction of the list."""
    kept = ~F.col("feature1").isin(*dropped) & ~F.col("feature2").isin(*dropped)
    counts = [F.count_if(kept & (F.abs("correlation") >= t)).alias(f"pairs_ge_{str(t).replace('.', '_')}")
              for t in thresholds]
    left = total - len(set(dropped))
    return pairs.agg(*counts).withColumns({
        "features_left": F.lit(left), "reduction_pct": F.lit((total - left) / total * 100)})


def drop_justification(targets: DataFrame, dropped: Sequence[str]) -> DataFrame:
    """Are the dropped features weaker than the average feature?"""
    means = targets.agg(
        F.avg(F.when(F.col("feature").isin(*dropped), F.col("abs_correlation"))).alias("dropped_mean"),
        F.avg("abs_correlation").alias("overall_mean"))
    return means.withColumn("justified", F.col("dropped_mean") < F.col("overall_mean"))


def histogram(targets: DataFrame, bins: int = 30, column: str = "correlation") -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum belongs to the last bin."""
    everything = Window.partitionBy(F.lit(0))  # one row per feature
    spread = targets.where(F.col(column).isNotNull()).select(
        F.col(column).alias("v"), F.min(column).over(everything).alias("lo"), F.max(column).over(everything).alias("hi"))
    place = F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")) * bins).cast("int")
    return spread.groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("features"))


def top_pair_submatrix(pairs: DataFrame, n: int = 20) -> DataFrame:
    """All correlations among the features of the ``n`` strongest pairs."""
    top = pairs.orderBy(F.desc(F.abs("correlation")), "feature1", "feature2").limit(n)
    names = top.select(F.explode(F.array("feature1", "feature2")).alias("name")).distinct()
    inside = pairs.join(names.withColumnRenamed("name", "feature1"), "feature1", "left_semi")
    return inside.join(names.withColumnRenamed("name", "feature2"), "feature2", "left_semi").select(
        "feature1", "feature2", "correlation")


def drop_list_summary(members: DataFrame, group: str = "group", feature: str = "feature") -> DataFrame:
    """Per group the number of features to drop, the share of the whole list, and the sorted names."""
    counts = members.groupBy(group).agg(
        F.countDistinct(feature).alias("features"),
        F.array_join(F.array_sort(F.collect_set(feature)), ",").alias("names"))
    return counts.withColumn("total", F.sum("features").over(Window.partitionBy(F.lit(0))))


def group_counts(spark, columns: Iterable[str], groups: Sequence[str] = d.FEATURE_GROUPS) -> DataFrame:
    """Features per prefix group with the range of their trailing numbers."""
    names = spark.createDataFrame([(c,) for c in columns], "feature string")
    return names.withColumns({"group": feature_group(F.col("feature"), groups),
                              "number": trailing_index(F.col("feature"))})


def chi_square(df: DataFrame, columns: Sequence[str], label: str = d.LABEL) -> DataFrame:
    """M4: chi-square test of each categorical column against a 0/1 label; nulls are left out.

    One scan: counts per (column, value), then ``N * (sum o1^2/(R*C1) + sum o0^2/(R*C0) - 1)`` per column, its degrees of
    freedom and the chance of a larger value.
    """
    long = df.select(F.col(label).cast("bigint").alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("_v")) for c in columns])))
    cells = long.where(F.col("_v").isNotNull() & F.col("_y").isNotNull()).groupBy("feature", "_v").agg(
        F.sum("_y").cast("double").alias("o1"), F.count("*").cast("double").alias("r"))
    o0 = F.col("r") - F.col("o1")
    sums = cells.groupBy("feature").agg(
        F.sum("r").alias("n"), F.sum("o1").alias("c1"), F.sum(o0).alias("c0"),
        F.sum(F.col("o1") * F.col("o1") / F.col("r")).alias("a1"), F.sum(o0 * o0 / F.col("r")).alias("a0"),
        F.count("*").alias("values"))
    tests = sums.select(
        "feature", (F.col("n") * (F.try_divide("a1", "c1") + F.try_divide("a0", "c0") - 1)).alias("statistic"),
        (F.col("values") - 1).alias("degrees"))
    return tests.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("degrees")))
