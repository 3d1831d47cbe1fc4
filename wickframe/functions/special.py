"""Tail probabilities and correction factors as column expressions or task-side helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def chi2_tail_even(x: Column, df: int) -> Column:
    """Upper tail of the chi-square distribution with an even number of degrees of freedom."""
    half, term, total = x / 2, F.lit(1.0), F.lit(1.0)
    for j in range(1, df // 2):
        term = term * half / j
        total = total + term
    return F.exp(-half) * total


def sample_skew(n: Column, g1: Column) -> Column:
    """Bias-corrected skewness from the population value."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(n: Column, g2: Column) -> Column:
    """Bias-corrected excess kurtosis from the population value."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p-value of Student's t by the continued fraction of the incomplete beta function."""
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h
