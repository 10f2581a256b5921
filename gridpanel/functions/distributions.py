"""Tail probabilities of a few test statistics, for tables of one row per term."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 400):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    return front * total


def t_two_sided(t: float, df: float) -> float:
    if df <= 0 or math.isnan(t):
        return math.nan
    return _incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Quantile by bisection on the two-sided tail, for confidence intervals."""
    target = 2.0 * (1.0 - p)
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = 0.5 * (low + high)
        if t_two_sided(mid, df) > target:
            low = mid
        else:
            high = mid
    return 0.5 * (low + high)
