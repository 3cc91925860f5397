"""The chi-square tail against closed forms in many digits."""

from __future__ import annotations

import math
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from clickloom.functions.special import chi_square_tail, log_gamma


def exact_even(degrees: int, x: float) -> float:
    """exp(-x/2) times the first degrees/2 terms of its series, with 60 digits."""
    getcontext().prec = 60
    half = Decimal(x) / 2
    term = total = Decimal(1)
    for j in range(1, degrees // 2):
        term = term * half / j
        total += term
    return float(total * (-half).exp())


def exact_odd(degrees: int, x: float) -> float:
    half = x / 2
    terms = [math.exp((j - 0.5) * math.log(half) - half - math.lgamma(j + 0.5)) for j in range(1, (degrees - 1) // 2 + 1)]
    return math.fsum([math.erfc(math.sqrt(half)), *terms])


CASES = [(2, 1e-9), (2, 3.0), (2, 60.0), (4, 9.4877290367811), (10, 2.0), (10, 18.307038053275), (30, 80.0),
         (24, 12.0), (26, 1000.0), (100, 77.9), (100, 124.342113404), (1000, 900.0), (1000, 1074.6794494), (20_000, 20_300.0),
         (400_000, 398_000.0), (400_000, 401_500.0)]


def test_even_degrees(spark):
    df = spark.createDataFrame([(i, k, x) for i, (k, x) in enumerate(CASES)], "i int, k long, x double")
    got = {r.i: r.p for r in df.select("i", chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()}
    for i, (k, x) in enumerate(CASES):
        assert got[i] == pytest.approx(exact_even(k, x), rel=1e-9, abs=1e-300), (k, x)


def test_odd_degrees_and_edges(spark):
    cases = [(1, 1e-6), (1, 3.841458820694124), (1, 50.0), (3, 7.814727903251179), (5, 1.1), (23, 35.17), (99, 60.0), (999, 1100.0)]
    df = spark.createDataFrame([(i, k, x) for i, (k, x) in enumerate(cases)], "i int, k long, x double")
    got = {r.i: r.p for r in df.select("i", chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()}
    for i, (k, x) in enumerate(cases):
        assert got[i] == pytest.approx(exact_odd(k, x), rel=1e-9), (k, x)
    edges = spark.createDataFrame([(0, 0.0, 1.0), (0, 5.0, 1.0), (3, 0.0, 1.0), (3, -1e-12, 1.0), (3, None, None)],
                                  "k long, x double, want double")
    assert all(r.p == r.want for r in edges.select("want", chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect())


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 2.0, 7.25, 11.9, 12.0, 100.5, 1e6]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", log_gamma(F.col("v")).alias("g")).collect()
    for r in got:
        assert r.g == pytest.approx(math.lgamma(r.v), rel=1e-12, abs=1e-12)
