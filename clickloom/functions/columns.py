"""Choosing, validating and aligning columns from the schema alone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from clickloom import defaults as d


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """Fail before any job when a required column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")


def present(df: DataFrame, columns: Iterable[str], on_missing: str = "skip") -> list[str]:
    """Columns of the list that exist, in list order; ``on_missing="error"`` insists on all of them."""
    wanted = list(columns)
    if on_missing == "error":
        require_columns(df, wanted)
    have = set(df.columns)
    return [c for c in wanted if c in have]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), parity: bool = False) -> list[str]:
    """Numeric columns in schema order.

    ``parity=True`` keeps only 32/64-bit floats and signed integers, the narrower historic rule.
    """
    kinds = (T.FloatType, T.DoubleType, T.IntegerType, T.LongType) if parity else T.NumericType
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def feature_columns(df: DataFrame, label: str = d.LABEL, seq: str = "seq", row_id: str = d.TEST_ID) -> list[str]:
    """Everything except label, sequence and id."""
    return [c for c in df.columns if c not in {label, seq, row_id}]


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Non-strict drop; absent names are ignored."""
    return df.drop(*columns)


def align(df: DataFrame, features: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """The training feature list by name and in training order; absent features become 0.0."""
    have = set(df.columns)
    cols = [F.col(c) for c in keep if c in have]
    cols += [(F.col(c).cast("double") if c in have else F.lit(0.0)).alias(c) for c in features]
    return df.select(*cols)


def cast_fill(column: str | Column, default: float = 0.0) -> Column:
    """Numeric cast with a default for nulls and unparsable strings."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.try_cast("double"), F.lit(default))


def feature_group(name: Column, groups: Iterable[str] = d.FEATURE_GROUPS, other: str = "others") -> Column:
    """Group of a feature name by its prefix; groups are tried in order."""
    expr = None
    for group in groups:
        test = name.startswith(f"{group}_")
        expr = F.when(test, group) if expr is None else expr.when(test, group)
    return F.lit(other) if expr is None else expr.otherwise(other)


def trailing_index(name: Column) -> Column:
    """Number after the last underscore, null when there is none."""
    return F.element_at(F.split(name, "_"), -1).try_cast("int")
