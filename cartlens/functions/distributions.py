"""Tails and quantiles of distributions as Column expressions.

Series and continued fractions are folded over as many terms as the parameters need, about the square root of
the degrees, so a statistic with its p-value stays one plan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Acklam's rational approximations of the normal quantile, relative error below 1.2e-9.
CENTRE_TOP = (
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
)
CENTRE_BOTTOM = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
TAIL_TOP = (
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00,
)
TAIL_BOTTOM = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
TAIL = 0.02425


def _named(body: Callable[[Column], Column], **values: Column) -> Column:
    """body of a struct of values, each computed once."""
    held = F.array(F.struct(*[v.cast("double").alias(k) for k, v in values.items()]))
    return F.get(F.transform(held, body), F.lit(0))


def _terms(size: Column) -> Column:
    return F.sequence(F.lit(1), (F.lit(100) + 8 * F.sqrt(size)).cast("int"))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series, eight steps further on."""
    y = x + 8
    steps = reduce(lambda a, b: a * b, [x + k for k in range(8)])
    r = 1 / (y * y)
    series = (F.lit(1 / 12) - r * (F.lit(1 / 360) - r * (F.lit(1 / 1260) - r / 1680))) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _beta_part(p: Column) -> Column:
    """Regularised incomplete beta function of p.x (p.y = 1 - p.x), p.a, p.b by its continued fraction."""
    a, b, x = p["a"], p["b"], p["x"]

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))
        d, c = 1 / (1 + even * s["d"]), 1 + even / s["c"]
        d2, c2 = 1 / (1 + odd * d), 1 + odd / c
        return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d * c * d2 * c2).alias("h"))

    first = 1 / (1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    fraction = F.aggregate(_terms(F.greatest(a, b)), start, step)["h"]
    front = log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(p["y"])
    return F.exp(front) / a * fraction


def f_tail(f: Column, df1: Column, df2: Column) -> Column:
    """P(F > f); null for a null statistic or degrees below one."""
    f, d1, d2 = f.cast("double"), df1.cast("double"), df2.cast("double")
    x, y, a, b = d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f), d2 / 2, d1 / 2
    # the fraction converges fast on one side of the mean; the other side is its complement
    swap = x > (a + 1) / (a + b + 2)
    side = lambda one, other: F.when(swap, one).otherwise(other)
    part = _named(_beta_part, a=side(b, a), b=side(a, b), x=side(y, x), y=side(x, y))
    tail = F.when(f <= 0, F.lit(1.0)).when(f == float("inf"), F.lit(0.0)).otherwise(F.when(swap, 1 - part).otherwise(part))
    return F.when(f.isNotNull() & ~F.isnan(f) & (d1 >= 1) & (d2 >= 1), tail)


def _gamma_below(p: Column) -> Column:
    a, x = p["a"], p["x"]
    step = lambda s, k: F.struct((s["t"] * x / (a + k)).alias("t"), (s["sum"] + s["t"] * x / (a + k)).alias("sum"))
    total = F.aggregate(_terms(a), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("sum")), step)["sum"]
    return F.exp(a * F.log(x) - x - log_gamma(a + 1)) * total


def _gamma_above(p: Column) -> Column:
    a, x = p["a"], p["x"]

    def step(s: Column, k: Column) -> Column:
        up, low = -k * (k - a), x + 1 - a + 2 * k
        d, c = 1 / (up * s["d"] + low), low + up / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = 1 / (x + 1 - a)
    start = F.struct(F.lit(1e300).alias("c"), first.alias("d"), first.alias("h"))
    return F.exp(a * F.log(x) - x - log_gamma(a)) * F.aggregate(_terms(a), start, step)["h"]


def chi_square_tail(x: Column, df: Column) -> Column:
    """P(X > x); without degrees of freedom 1, null for a null statistic."""
    half, a = x.cast("double") / 2, df.cast("double") / 2
    tail = F.when(half < a + 1, 1 - _named(_gamma_below, a=a, x=half)).otherwise(_named(_gamma_above, a=a, x=half))
    return F.when((half <= 0) | (a <= 0), F.lit(1.0)).when(half == float("inf"), F.lit(0.0)).when(half.isNotNull(), tail)


def normal_tail(z: Column) -> Column:
    """P(Z > z)."""
    half = chi_square_tail(z * z, F.lit(1)) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def _polynomial(x: Column, factors: Sequence[float]) -> Column:
    return reduce(lambda total, c: total * x + c, factors[1:], F.lit(factors[0]))


def normal_quantile(p: Column) -> Column:
    """z with P(Z < z) = p, for 0 < p < 1."""
    q = p - 0.5
    t = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    tail = _polynomial(t, TAIL_TOP) / _polynomial(t, TAIL_BOTTOM)
    centre = q * _polynomial(q * q, CENTRE_TOP) / _polynomial(q * q, CENTRE_BOTTOM)
    return F.when(p < TAIL, tail).when(p > 1 - TAIL, -tail).otherwise(centre)
