"""Downsampling and splitting by deterministic hash order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from clickloom import defaults as d
from clickloom.functions.calendar import in_slice
from clickloom.functions.keys import hash_split
from clickloom.operators.hash_order import (
    SLOT_ROWS, first_by_hash, group_sizes, grouped, hash_limits, hash_parts, within_limits,
)
from clickloom.session import ONE_TASK_ROWS, measure


def strata_columns(df: DataFrame, candidates: Iterable[str] = d.STRATA) -> list[str]:
    """G1: the candidate columns that exist; at least one must."""
    found = [c for c in candidates if c in df.columns]
    if not found:
        raise ValueError("none of the stratum columns exists")
    return found


def class_counts(df: DataFrame, label: str = d.LABEL) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    return row["p"], row["n"]


def _target(pos: int, neg: int, ratio: float) -> int:
    if pos == 0 or neg == 0:
        raise ValueError("both classes are needed")
    return min(int(pos * ratio), neg)


def _strata(df: DataFrame, strata: list[str], parity: bool) -> tuple[DataFrame, list[str]]:
    if not parity:
        return df, strata
    joined = F.concat_ws("|", *[F.col(c).cast("string") for c in strata])
    hole = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in strata], F.lit(False))
    return df.withColumn("_stratum", F.when(~hole, joined)), ["_stratum"]


def stratified_downsample(df: DataFrame, strata: Iterable[str], ratio: float = d.NEGATIVE_RATIO,
                          label: str = d.LABEL, key: str = d.ROW_KEY, seed: int = d.SEED, parity: bool = False,
                          slot_rows: int = SLOT_ROWS, keep_positives: bool = True) -> DataFrame:
    """All positives and, per stratum, ``max(1, round(n * fraction))`` negatives, halves to even.

    Nulls form strata of their own; ``parity=True`` puts every row with any null component in one stratum.
    The quotas and limits come from scans of the strata, label and key columns; the rows themselves are
    read once, by a filter.
    """
    frame, groups = _strata(df, list(strata), parity)
    negative = F.col(label) == 0
    by_class = measure(grouped(frame, groups).groupBy("_g").agg(
        F.count_if(negative).alias("_n"), F.count_if(F.col(label) == 1).alias("_p")))
    neg, pos = by_class.df.agg(F.sum("_n"), F.sum("_p")).first()
    target = _target(pos or 0, neg or 0, ratio)
    share = F.bround(F.col("_n") * F.lit(target / neg), 0).cast("bigint")
    quotas = by_class.df.where("_n > 0").select(
        "_g", "_n", F.greatest(F.lit(1), F.least(F.col("_n"), share)).alias("_quota"))
    limits = hash_limits(frame.where(negative), quotas, groups, key, seed, slot_rows)
    if keep_positives:
        rows = frame.where(F.col(label).isin(0, 1))
        chosen = within_limits(rows, limits, groups, key, seed, always=F.col(label) == 1)
    else:
        chosen = within_limits(frame.where(negative), limits, groups, key, seed)
    return chosen.select(*df.columns)


def sample_negatives(df: DataFrame, strata: Iterable[str], ratio: float = d.NEGATIVE_RATIO, **options) -> DataFrame:
    """The sampled negatives alone."""
    return stratified_downsample(df, strata, ratio, keep_positives=False, **options)


def downsample_stats(df: DataFrame, sampled: DataFrame, ratio: float = d.NEGATIVE_RATIO,
                     label: str = d.LABEL) -> DataFrame:
    """One row describing a downsample of ``df``."""
    pos, neg = class_counts(df, label)
    target = _target(pos, neg, ratio)
    return sampled.agg(F.count_if(F.col(label) == 0).alias("actual_neg")).select(
        F.lit(pos).cast("bigint").alias("total_pos"), F.lit(neg).cast("bigint").alias("total_neg"),
        F.lit(target).cast("bigint").alias("target_neg"), "actual_neg",
        (F.col("actual_neg") / F.lit(float(pos))).alias("ratio"))


def sample_rows(df: DataFrame, n: int, key: str = d.ROW_KEY, seed: int = d.SEED,
                slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, uniformly, without replacement."""
    quotas = group_sizes(df, []).withColumn("_quota", F.least(F.col("_n"), F.lit(int(n)).cast("bigint")))
    return first_by_hash(df, quotas, [], key, seed, slot_rows)


def random_downsample(df: DataFrame, ratio: float = 2.0, label: str = d.LABEL, key: str = d.ROW_KEY,
                      seed: int = d.SEED, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """All positives and exactly ``ratio`` times as many negatives, unstratified."""
    pos, neg = class_counts(df, label)
    target = _target(pos, neg, ratio)
    negatives = df.where(F.col(label) == 0)
    quotas = group_sizes(negatives, []).withColumn("_quota", F.lit(target).cast("bigint"))
    limits = hash_limits(negatives, quotas, [], key, seed, slot_rows)
    return within_limits(df.where(F.col(label).isin(0, 1)), limits, [], key, seed, always=F.col(label) == 1)


def first_by_key(df: DataFrame, n: int, key: str = d.ROW_KEY) -> DataFrame:
    """A4: the ``n`` rows with the smallest key, as a filter on the exact n-th key.

    The key is a unique integer of any size; rows without a key come after all others.  The keys are counted between
    approximate quantiles, in their own type, until the range that holds the n-th one can be sorted by one task.
    The filter reaches the Parquet scan, so a large ``n`` never passes through one task.
    """
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"the row key {key!r} is not an integer")
    if n <= 0:
        return df.where(F.lit(False))
    if n >= df.count():
        return df
    keys = df.select(F.col(key).cast("bigint").alias("k")).where("k is not null")
    inside = keys.count()
    if n >= inside:  # some of the rows without a key, in no order
        return df.where(F.col(key).isNotNull()).unionByName(df.where(F.col(key).isNull()).limit(n - inside))
    left = n
    while inside > ONE_TASK_ROWS:
        probs = [i / 64 for i in range(1, 64)]
        cuts = sorted(set(keys.agg(F.percentile_approx("k", probs, 10_000)).first()[0]))
        upto = keys.agg(*[F.count_if(F.col("k") <= c) for c in cuts]).first()
        above = next((i for i, c in enumerate(upto) if c >= left), len(cuts))
        if above < len(cuts):
            keys = keys.where(F.col("k") <= F.lit(cuts[above]))
        if above:
            keys = keys.where(F.col("k") > F.lit(cuts[above - 1]))
        below = upto[above - 1] if above else 0
        before, inside = inside, (upto[above] if above < len(cuts) else inside) - below
        if inside == before:
            raise ValueError(f"the row key {key!r} is not unique: {inside} rows cannot be told apart")
        left -= below
    last = keys.orderBy("k").offset(left - 1).first()[0]
    return df.where(F.col(key) <= F.lit(last))


def stratified_folds(df: DataFrame, folds: int = d.FOLDS, label: str = d.LABEL, key: str = d.ROW_KEY,
                     seed: int = d.SEED, name: str = "fold", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Folds whose class counts differ by at most one row: equal parts of every class's hash order.

    The rows are read once and stay where they are; the cuts between the parts come from the keys and labels.
    """
    return hash_parts(df, [label], folds, key, seed, slot_rows, name)


def split(df: DataFrame, share: float = 0.2, key: str = d.ROW_KEY, seed: int = d.SEED) -> tuple[DataFrame, DataFrame]:
    """(training, held-out) by hash."""
    held = hash_split(key, share, seed)
    return df.where(~held), df.where(held)


def slice_holdout(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M6: (all other weekdays, the slice day)."""
    return df.where(~in_slice()), df.where(in_slice())
