"""Tail probabilities and quantiles as column expressions.

Series and expansions from Abramowitz & Stegun, Handbook of Mathematical Functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

Z95 = 1.6448536269514722  # fixed value: 0.95 quantile of the standard normal

# Coefficients of a**-k in gamma(a + 1/2) / (gamma(a) sqrt(a)) as a grows.
_GAMMA_RATIO = [1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304, 39325 / 33554432]


def _gamma_ratio(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a): the expansion at a + 24, and back by the recurrence."""
    far = a + 24
    series = F.lit(0.0)
    for c in reversed(_GAMMA_RATIO):
        series = series / far + F.lit(c)
    back = F.aggregate(F.sequence(F.lit(0), F.lit(23)), F.lit(1.0), lambda v, i: v * ((a + i) / (a + i + 0.5)))
    return F.sqrt(far) * series * back


def _fraction(a: Column, b: Column, x: Column, terms: Column) -> Column:
    """Continued fraction of the incomplete beta function (26.5.8) from its last term to its first."""

    def step(value: Column, k: Column) -> Column:
        m = terms - k  # terms - 1 ... 0
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        inner = 1 + odd / value
        return F.when(m > 0, 1 + even / inner).otherwise(inner)

    return 1 / F.aggregate(F.sequence(F.lit(1), terms), F.lit(1.0), step)


def t_two_sided_p(t: Column, nu: Column) -> Column:
    """P(|T| > |t|) for any positive degrees of freedom, as an incomplete beta function.

    The fraction is taken on the side where it converges; its terms grow with the square root of
    the degrees of freedom, and small probabilities keep their relative accuracy.
    """
    v, t = nu.cast("double"), F.abs(t)
    a = v / 2
    x, y = v / (v + t * t), t * t / (v + t * t)
    terms = (40 + F.ceil(2 * F.sqrt(v))).cast("int")
    lead = F.exp(-a * F.log1p(t * t / v)) * F.sqrt(y) * _gamma_ratio(a) / math.sqrt(math.pi)
    half = F.lit(0.5)
    tail = lead / a * _fraction(a, half, x, terms)
    inside = lead / half * _fraction(half, a, y, terms)
    return F.when(v > 0, F.when(t == 0, 1.0).when(x < (a + 1) / (a + 2.5), tail).otherwise(1 - inside))


def t_quantile95(nu: Column) -> Column:
    """0.95 quantile of Student t: Newton steps on the tail from the expansion 26.7.5; NULL without degrees of freedom."""
    z = Z95
    v = nu.cast("double")
    start = z + (z**3 + z) / 4 / v + (5 * z**5 + 16 * z**3 + 3 * z) / 96 / (v * v) + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384 / (v * v * v)
    height = _gamma_ratio(v / 2) / F.sqrt(v * math.pi)

    def step(q: Column, _: Column) -> Column:
        density = height * F.exp(-(v + 1) / 2 * F.log1p(q * q / v))
        return q + (t_two_sided_p(q, nu) - 0.1) / (2 * density)

    return F.when(v > 0, F.aggregate(F.sequence(F.lit(1), F.lit(7)), start, step))


def chi2_tail(x: Column, df: int) -> Column:
    """P(X > x) for a chi-square with ``df`` degrees of freedom: the regularized incomplete gamma function of df / 2 and x / 2.

    By its power series (6.5.29) below df / 2 + 1 and by its continued fraction (6.5.31) from there on, so that small
    probabilities keep their relative accuracy, 1e-12 for up to some hundred degrees of freedom.
    """
    if df < 1:
        raise ValueError("df must be positive")
    a, half = df / 2, x.cast("double") / 2
    terms = F.sequence(F.lit(1), F.lit(100 + 4 * int(math.sqrt(a))))
    lead = F.exp(a * F.ln(half) - half - math.lgamma(a))
    last = F.lit(100 + 4 * int(math.sqrt(a)))
    # from the last term to the first: 1 + x / (a + 1) (1 + x / (a + 2) (...))
    series = F.aggregate(terms, F.lit(1.0), lambda v, k: 1 + v * half / (a + (last - k + 1))) / a
    fraction = 1 / F.aggregate(terms, half + (2 * last + 1) - a, lambda v, k: half + (2 * (last - k) + 1) - a - (last - k + 1) * ((last - k + 1) - a) / v)
    return F.when(half <= 0, 1.0).when(half < a + 1, 1 - lead * series).otherwise(lead * fraction)
