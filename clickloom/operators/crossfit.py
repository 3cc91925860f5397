"""Leave-fold-out click-rate differences between a slice of the rows and the rest.

All features of a job are fitted in one scan: four sums per (keys, fold) cell.  "All folds but one" is the
key's total minus the cell, so no fold is aggregated twice.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom import defaults as d
from clickloom.functions.calendar import in_slice
from clickloom.functions.keys import hash_fold
from clickloom.operators.encode import Cells, grouped_cells
from clickloom.operators.lookup import Lookup, attach_all
from clickloom.session import Measured
from clickloom.sources.files import read_text, write_text

_SUMS = ["_y1", "_n1", "_y0", "_n0"]  # label sum and rows: inside the slice, outside it


@dataclass(frozen=True)
class SliceDelta:
    """One feature: click rate inside the slice minus click rate outside, per key combination.

    ``alpha=None`` is the plain difference: a key seen on one side only gets the overall difference, or,
    with ``one_sided=True``, the overall rate in place of the missing side.  With ``alpha`` each side is
    ``(sum + alpha * overall) / (rows + alpha)``, and the overall rate below ``min_count`` rows.
    """

    name: str
    keys: tuple[str, ...]
    alpha: float | None = None
    min_count: int = 0
    one_sided: bool = False

    def value(self, y1: Column, n1: Column, y0: Column, n0: Column, inside: Column, outside: Column) -> Column:
        if self.alpha is None:
            a, b = F.try_divide(y1, n1), F.try_divide(y0, n0)
            if self.one_sided:
                return F.coalesce(a, inside) - F.coalesce(b, outside)
            return F.coalesce(a - b, inside - outside)
        alpha, least = max(self.alpha, 1e-6), max(self.min_count, 0)

        def side(y: Column, n: Column, overall: Column) -> Column:
            return F.when(n >= least, (y + F.lit(alpha) * overall) / (n + F.lit(alpha))).otherwise(overall)

        return side(y1, n1, inside) - side(y0, n0, outside)


@dataclass
class SliceDeltas:
    """Estimator for a list of deltas and, optionally, the smoothed slice share of one key."""

    deltas: Sequence[SliceDelta]
    share_key: str | None = None
    share_name: str = "day7_freq_ratio_inv"
    label: str = d.LABEL
    slice_test: Column | None = None
    folds: int = d.FOLDS
    seed: int = d.SEED
    row_key: str = d.ROW_KEY
    # a column with fold numbers, such as stratified folds; None: drawn by a hash of the row key
    fold: str | None = None
    # False: fallback and smoothing rates come from all training rows; True: from the other folds only
    strict_oof: bool = False

    def fold_number(self) -> Column:
        return F.col(self.fold) if self.fold else hash_fold(self.row_key, self.folds, self.seed)

    def fit(self, train: DataFrame) -> "SliceDeltaModel":
        inside = in_slice() if self.slice_test is None else self.slice_test
        rows = train.withColumn("_fold", self.fold_number()).withColumn("_in", inside)
        key_sets = list(dict.fromkeys(delta.keys for delta in self.deltas))
        sets = [[*k, "_fold"] for k in key_sets] + ([[self.share_key]] if self.share_key else []) + [["_fold"], []]
        y = F.col(self.label).cast("bigint")
        cells = grouped_cells(rows, sets, [
            F.coalesce(F.sum(F.when(F.col("_in"), y)), F.lit(0)).alias("_y1"), F.count_if(F.col("_in")).alias("_n1"),
            F.coalesce(F.sum(F.when(~F.col("_in"), y)), F.lit(0)).alias("_y0"), F.count_if(~F.col("_in")).alias("_n0"),
        ])
        return self.model(cells)

    def model(self, cells: Cells) -> "SliceDeltaModel":
        """The model of counted cells: one set per key set and fold, one of the share key, one per fold, one for all."""
        key_sets = list(dict.fromkeys(delta.keys for delta in self.deltas))
        folds_at = len(key_sets) + bool(self.share_key)
        # one row per fold and one for everything
        sums = cells.df.where(F.col("_set") >= folds_at).select("_set", "_fold", *_SUMS).collect()
        whole = next((r for r in sums if r["_set"] == folds_at + 1), None)
        overall = _rates(*(whole[c] for c in _SUMS))
        by_fold = {}
        for r in sums:
            if r["_set"] == folds_at:
                by_fold[r["_fold"]] = _rates(*(whole[c] - r[c] for c in _SUMS)) if self.strict_oof else overall
        seen = whole["_n1"] + whole["_n0"]
        share = whole["_n1"] / seen if seen else 0.0

        loo, full = {}, {}
        for delta in self.deltas:
            number = key_sets.index(delta.keys)
            cell = cells.of(number)
            by_key = Window.partitionBy(*delta.keys)  # one row per fold
            rest = cell.withColumns({f"{c}_t": F.sum(c).over(by_key) for c in _SUMS}).withColumns(
                {f"{c}_r": F.col(f"{c}_t") - F.col(c) for c in _SUMS})
            means = [_per_fold(by_fold, i, overall[i]) for i in (0, 1)]
            value = delta.value(*[F.col(f"{c}_r") for c in _SUMS], *means)
            loo[delta] = cells.derived(number, rest.select(
                *delta.keys, "_fold", value.alias(delta.name), (F.col("_n1") + F.col("_n0")).alias("_w")))
            totals = cell.groupBy(*delta.keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
            value = delta.value(*[F.col(c) for c in _SUMS], F.lit(overall[0]), F.lit(overall[1]))
            full[delta] = cells.derived(number, totals.select(
                *delta.keys, value.alias(delta.name), (F.col("_n1") + F.col("_n0")).alias("_w")))
        shares = None
        if self.share_key:
            number = len(key_sets)
            n = F.col("_n1") + F.col("_n0")
            shares = cells.derived(number, cells.of(number).select(
                self.share_key, ((F.col("_n1") + 1) / (n + 2)).alias(self.share_name), n.alias("_w")))
        return SliceDeltaModel(self, cells, overall, by_fold, share, loo, full, shares)


def _rates(y1: int, n1: int, y0: int, n0: int) -> tuple[float, float]:
    """Mean label inside and outside; an empty side takes the mean of all rows."""
    everything = (y1 + y0) / (n1 + n0) if n1 + n0 else 0.0
    return (y1 / n1 if n1 else everything, y0 / n0 if n0 else everything)


def _per_fold(by_fold: dict[int, tuple[float, float]], side: int, default: float) -> Column:
    expr = F.lit(default)
    for fold, rates in by_fold.items():
        if rates[side] != default:
            expr = F.when(F.col("_fold") == fold, F.lit(rates[side])).otherwise(expr)
    return expr


@dataclass
class SliceDeltaModel:
    spec: SliceDeltas
    cells: Cells
    overall: tuple[float, float]
    by_fold: dict[int, tuple[float, float]]
    share: float
    leave_out: dict[SliceDelta, Measured]
    full: dict[SliceDelta, Measured]
    shares: Measured | None

    @property
    def names(self) -> list[str]:
        return [x.name for x in self.spec.deltas] + ([self.spec.share_name] if self.shares else [])

    def transform_train(self, df: DataFrame) -> DataFrame:
        fold = {"_fold": self.spec.fold_number()}
        # a missing cell has the difference of its fold's rates, so the fold is a value of the lookup's rows
        gap = _per_fold(self.by_fold, 0, self.overall[0]) - _per_fold(self.by_fold, 1, self.overall[1])
        lookups = [Lookup(t, [*x.keys, "_fold"], fold, {x.name: gap}) for x, t in self.leave_out.items()]
        return attach_all(df, [*lookups, *self._share_lookup()], self.spec.row_key)

    def transform_new(self, df: DataFrame) -> DataFrame:
        gap = F.lit(self.overall[0]) - F.lit(self.overall[1])
        lookups = [Lookup(t, list(x.keys), defaults={x.name: gap}) for x, t in self.full.items()]
        return attach_all(df, [*lookups, *self._share_lookup()], self.spec.row_key)

    def _share_lookup(self) -> list[Lookup]:
        if self.shares is None:
            return []
        return [Lookup(self.shares, [self.spec.share_key], defaults={self.spec.share_name: F.lit(self.share)})]

    def release(self) -> None:
        self.cells.release()

    def save(self, path: str) -> None:
        """The cells as Parquet and the settings as JSON, without the slice: rows were dealt to it when they were counted."""
        self.cells.save(f"{path}/cells")
        spec = {f.name: getattr(self.spec, f.name) for f in fields(self.spec) if f.name != "slice_test"}
        spec["deltas"] = [asdict(x) for x in self.spec.deltas]
        write_text(self.cells.df.sparkSession, f"{path}/deltas.json", json.dumps(spec))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SliceDeltaModel":
        spec = json.loads(read_text(spark, f"{path}/deltas.json"))
        spec["deltas"] = [SliceDelta(**{**x, "keys": tuple(x["keys"])}) for x in spec["deltas"]]
        return SliceDeltas(**spec).model(Cells.load(spark, f"{path}/cells"))

    def merge(self, other: "SliceDeltaModel") -> "SliceDeltaModel":
        """The model of both models' training rows, as if they had been fitted together."""
        if list(self.spec.deltas) != list(other.spec.deltas) or self.spec.share_key != other.spec.share_key:
            raise ValueError("only models of the same features can be merged")
        return self.spec.model(self.cells.merged(other.cells, _SUMS))


def slice_full_outer(df: DataFrame, keys: Sequence[str], label: str = d.LABEL,
                     slice_test: Column | None = None) -> DataFrame:
    """Both sides of the slice per key, a missing side as null.

    One grouped pass with conditional aggregates replaces two filtered aggregates and a full outer join.
    """
    inside = in_slice() if slice_test is None else slice_test
    return df.withColumn("_in", inside).groupBy(*keys).agg(
        F.avg(F.when(F.col("_in"), F.col(label))).alias("day7_ctr"),
        F.nullif(F.count_if(F.col("_in")), F.lit(0)).alias("day7_cnt"),
        F.avg(F.when(~F.col("_in"), F.col(label))).alias("rest_ctr"),
        F.nullif(F.count_if(~F.col("_in")), F.lit(0)).alias("rest_cnt"),
    )


def slice_means(df: DataFrame, label: str = d.LABEL, slice_test: Column | None = None) -> DataFrame:
    """Slice and rest means with the overall mean for an empty side; one row."""
    inside = in_slice() if slice_test is None else slice_test
    y = F.col(label)
    return df.agg(
        F.coalesce(F.avg(F.when(inside, y)), F.avg(y)).alias("day7_mean"),
        F.coalesce(F.avg(F.when(~inside, y)), F.avg(y)).alias("rest_mean"),
    ).withColumn("delta", F.col("day7_mean") - F.col("rest_mean"))
