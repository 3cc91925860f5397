"""Null handling: category defaults, value defaults and missing flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from clickloom import defaults as d


def fill_categories(df: DataFrame, columns: Iterable[str] = d.CATEGORICAL) -> DataFrame:
    """Nulls become -1 in numeric columns and "Unknown" in all others (which become strings)."""
    new = {}
    for name in columns:
        if name not in df.columns:
            continue
        if isinstance(df.schema[name].dataType, T.NumericType):
            new[name] = F.coalesce(F.col(name), F.lit(-1).cast(df.schema[name].dataType))
        else:
            new[name] = F.coalesce(F.col(name).cast("string"), F.lit("Unknown"))
    return df.withColumns(new) if new else df


def fill_values(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """B13, second half: replace nulls by fitted values, e.g. training medians."""
    new = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items() if c in df.columns}
    return df.withColumns(new) if new else df


def missing_flags(df: DataFrame, groups: Mapping[str, list[str]] = d.MISSING_FLAGS) -> DataFrame:
    """1 when every present column of the group is null; a group without columns is skipped."""
    new = {}
    for flag, columns in groups.items():
        nulls = [F.col(c).isNull() for c in columns if c in df.columns]
        if nulls:
            new[flag] = reduce(lambda a, b: a & b, nulls).cast("byte")
    return df.withColumns(new) if new else df
