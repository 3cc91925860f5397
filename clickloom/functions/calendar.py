"""Calendar features: cyclical encodings, named periods, slice flags and sample weights."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from clickloom import defaults as d


def _int(column: str) -> Column:
    # day and hour may be strings, and a filled-in "Unknown" must give null instead of an error
    return F.col(column).try_cast("int")


def cyclical(df: DataFrame, columns: Iterable[str] = ("day_of_week", "hour"),
             weekend: Iterable[int] = d.WEEKEND_CODES) -> DataFrame:
    """sine and cosine of day (period 7) and hour (period 24), and the weekend flag."""
    new: dict[str, Column] = {}
    if "day_of_week" in columns and "day_of_week" in df.columns:
        phase = F.col("day_of_week").try_cast("double") * (2 * math.pi / 7)
        new |= {
            "dow_sin": F.sin(phase),
            "dow_cos": F.cos(phase),
            "is_weekend": _int("day_of_week").isin(*weekend).cast("byte"),
        }
    if "hour" in columns and "hour" in df.columns:
        phase = F.col("hour").try_cast("double") * (2 * math.pi / 24)
        new |= {"hour_sin": F.sin(phase), "hour_cos": F.cos(phase)}
    return df.withColumns(new) if new else df


def report_phase(column: str, period: int, origin: int = 0) -> Column:
    """angle used by the report tables (days start at phase zero)."""
    return (F.col(column).try_cast("double") - float(origin)) * math.tau / float(period)


def time_period(hour: str = "hour", periods: Iterable[tuple[int, int, str]] = d.TIME_PERIODS,
                default: str = "other") -> Column:
    """named part of the day; when ranges overlap the later one wins."""
    expr = F.lit(default)
    for start, end, name in periods:
        expr = F.when(_int(hour).between(start, end), F.lit(name)).otherwise(expr)
    return expr


def pair_key(left: str, right: str) -> Column:
    """both values joined by a pipe; null when either side is null."""
    return F.concat(F.col(left).cast("string"), F.lit("|"), F.col(right).cast("string"))


def add_time_period(df: DataFrame, periods=d.TIME_PERIODS) -> DataFrame:
    """F3 and F4 together; a frame without ``hour`` is returned unchanged."""
    if "hour" not in df.columns:
        return df
    new = {"time_period": time_period(periods=periods)}
    if "day_of_week" in df.columns:
        new["dow_hour"] = pair_key("day_of_week", "hour")
    return df.withColumns(new)


def in_slice(day: int = d.SLICE_DAY) -> Column:
    """B2: the chosen weekday; false (never null) for an unparsable day."""
    return F.coalesce(_int("day_of_week") == day, F.lit(False))


def early_flag(threshold: int = d.EARLY_HOUR, day: int = d.SLICE_DAY) -> Column:
    """chosen weekday and an hour up to the threshold."""
    return ((_int("day_of_week") == day) & (_int("hour") <= threshold)).cast("byte")


def sample_weight(day_weight: float = 1.0, early_weight: float = 1.0, early_hour: int = -1,
                  positive_weight: float = 1.0, day: int = d.SLICE_DAY, label: str = d.LABEL) -> Column:
    """Product of the weekday, the early-hour and the positive-class multipliers."""
    weight = F.when(in_slice(day), F.lit(float(day_weight))).otherwise(1.0)
    if early_hour >= 0:
        early = in_slice(day) & F.coalesce(_int("hour") <= early_hour, F.lit(False))
        weight = weight * F.when(early, F.lit(float(early_weight))).otherwise(1.0)
    if positive_weight != 1.0:
        weight = weight * F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(1.0)
    return weight
