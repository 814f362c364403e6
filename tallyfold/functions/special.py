"""Tails and quantiles of Student's t distribution as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 16  # where the series of the gamma ratio is exact to double precision
_HALVINGS = 64
_TERMS = 200  # of the continued fraction; fewer than 100 settle it on the side where it is used


def _log_gamma_ratio(a: Column) -> Column:
    """ln(gamma(a + 1/2) / gamma(a)), by its asymptotic series at ``a`` + 16 and the recurrence down to ``a``."""
    z = a + _SHIFT
    series = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * z * z * z) - 1 / (640 * F.pow(z, F.lit(5)))
    steps = F.transform(F.sequence(F.lit(0), F.lit(_SHIFT - 1)), lambda i: F.log1p(F.lit(0.5) / (a + i)))
    return series - F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, evaluated from its far end."""

    def term(j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(j % 2 == 0, even).otherwise(odd)

    terms = F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1))
    return F.aggregate(terms, F.lit(1.0), lambda tail, j: 1 + term(j) / tail)


def student_tail(t: Column, df: Column) -> Column:
    """Probability that a t value with ``df`` degrees of freedom lies at least as far from 0 as ``t``.

    The regularised incomplete beta function at df / (df + t^2), by its continued fraction; null if either is.
    """
    square, a, half = t * t, df / 2, F.lit(0.5)
    x = df / (df + square)
    away = square / (df + square)
    front = F.exp(_log_gamma_ratio(a) - F.log(F.lit(3.141592653589793)) / 2 - a * F.log1p(square / df) + F.log(away) / 2)
    near = 1 - front / half / _fraction(half, a, away)
    far = front / a / _fraction(a, half, x)
    tail = F.when(x < (a + 1) / (a + 2.5), far).otherwise(near)
    return F.when(df > 0, F.when(square == 0, F.lit(1.0)).otherwise(tail))


def student_quantile(tail: float, df: Column) -> Column:
    """The t value beyond which, on both sides, lies the probability ``tail``; by halving t / (1 + t)."""
    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))

    def halved(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        inside = student_tail(middle / (1 - middle), df) > tail
        return F.struct(
            F.when(inside, middle).otherwise(state["low"]).alias("low"), F.when(inside, state["high"]).otherwise(middle).alias("high")
        )

    place = F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), start, halved, lambda state: state["low"])
    return F.when(df > 0, place / (1 - place))
