"""Special functions as column expressions: the tail of the chi-square distribution (M4)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Stirling's series is used from here on; smaller arguments are shifted up.
_LARGE = 12
# Relative size at which series and fraction are cut off, by their number of terms.
_TERMS, _TERMS_PER_ROOT = 120, 14


def _stirling_rest(z: Column) -> Column:
    """ln Gamma(z + 1) minus that of sqrt(2 pi z) (z / e)^z, for z of 12 or more."""
    s = 1 / (z * z)
    return (1 / z) * (F.lit(1 / 12) - s * (F.lit(1 / 360) - s * (F.lit(1 / 1260) - s * (F.lit(1 / 1680) - s * F.lit(1 / 1188)))))


def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0."""
    up = z + _LARGE
    product = z
    for i in range(1, _LARGE + 1):
        product = product * (z + i)
    # Gamma(z) = Gamma(z + 13) / (z (z + 1) .. (z + 12))
    return F.lit(0.5 * math.log(2 * math.pi)) + 0.5 * F.ln(up) + up * F.ln(up) - up + _stirling_rest(up) - F.ln(product)


def _density(a: Column, x: Column) -> Column:
    """x^a e^-x / Gamma(a + 1) without the loss of digits that large terms of opposite sign bring."""
    off = (x - a) / a
    large = F.exp(-a * (off - F.log1p(off)) - _stirling_rest(a)) / F.sqrt(F.lit(2 * math.pi) * a)
    small = F.exp(a * F.ln(x) - x - log_gamma(a + 1))
    return F.when(a >= _LARGE, large).otherwise(small)


def upper_gamma(a: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function Q(a, x) for a > 0, x >= 0.

    A power series below a + 1, a continued fraction by modified Lentz steps from there on.  Both need a number of terms in
    the order of the square root of ``a``.
    """
    steps = F.sequence(F.lit(1), F.ceil(_TERMS + _TERMS_PER_ROOT * F.sqrt(a)).cast("int"))
    number = lambda c: c.cast("double")
    series = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, i: F.struct((s["term"] * x / (a + number(i))).alias("term"),
                              (s["sum"] + s["term"] * x / (a + number(i))).alias("sum")), lambda s: s["sum"])
    tiny = 1e-300

    def step(s: Column, i: Column) -> Column:
        n, b = -number(i) * (number(i) - a), x + 1 - a + 2 * number(i)
        d = 1 / _nonzero(n * s["d"] + b, tiny)
        c = _nonzero(b + n / s["c"], tiny)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = 1 / _nonzero(x + 1 - a, tiny)
    fraction = F.aggregate(steps, F.struct(F.lit(1 / tiny).alias("c"), first.alias("d"), first.alias("h")), step,
                           lambda s: s["h"])
    density = _density(a, x)
    # the series gives the lower part, density * sum; the fraction the upper one, density * a * fraction
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, F.greatest(1 - density * series, F.lit(0.0))).otherwise(
        density * a * fraction)


def _nonzero(c: Column, tiny: float) -> Column:
    return F.when(F.abs(c) < tiny, F.lit(tiny)).otherwise(c)


def chi_square_tail(statistic: Column, degrees: Column) -> Column:
    """The chance of a larger statistic; 1 without degrees of freedom, null for a null statistic."""
    statistic, degrees = statistic.cast("double"), degrees.cast("double")
    tail = upper_gamma(degrees / 2, F.greatest(statistic, F.lit(0.0)) / 2)
    return F.when(statistic.isNull(), F.lit(None)).when(degrees <= 0, F.lit(1.0)).otherwise(tail)
