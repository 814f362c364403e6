"""Correlation and simple regression, as partial aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.columns import number_or_null
from tallyfold.functions.special import student_quantile, student_tail
from tallyfold.operators.joins import join_null_safe
from tallyfold.operators.ordered import row_positions


def _pair(rows: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Keys with both values as doubles, NaN as null, which the statistics skip."""
    return rows.select(*keys, number_or_null(x).cast("double").alias("_x"), number_or_null(y).cast("double").alias("_y"))


def correlation(rows: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of the pairs in which both values are present."""
    return _pair(rows, keys, x, y).groupBy(*keys).agg(F.corr("_x", "_y").alias("corr"))


def lagged_correlation(
    rows: DataFrame,
    first: str,
    second: str,
    lags: range,
    keys: Sequence[str] = (),
    order: str = "date",
    block: Column | None = None,
) -> DataFrame:
    """Correlation of ``first`` with ``second`` shifted by each lag, counted in rows.

    Needs one row per (keys, order). Rows are numbered and cut into stretches as long as the lags reach.
    A row of ``second`` goes to the two stretches at most in which it has partners and meets ``first``
    there, so every row is shuffled three times whatever the number of lags; the correlations combine
    before their shuffle. NaN counts as missing.
    """
    low, high = min(lags), max(lags)
    length = high - low + 1
    numbered = row_positions(
        rows.select(*keys, order, number_or_null(first).alias(first), number_or_null(second).alias(second)), keys, order, block
    )
    base = numbered.select(
        *keys, F.floor(F.col("pos") / length).alias("_stretch"), "pos", F.col(first).cast("double").alias("_first")
    )
    reached = [F.floor((F.col("pos") + lag) / length) for lag in (low, high)]
    shifted = numbered.select(
        *keys,
        F.explode(F.array_distinct(F.array(*reached))).alias("_stretch"),
        F.col("pos").alias("_from"),
        F.col(second).cast("double").alias("_second"),
    )
    lag = F.col("pos") - F.col("_from")
    wanted = lag.between(low, high) & (F.pmod(lag - lags.start, F.lit(abs(lags.step))) == 0)
    pairs = join_null_safe(shifted, base, [*keys, "_stretch"]).withColumn("lag", lag).where(wanted)
    return pairs.groupBy(*keys, F.col("lag").cast("int").alias("lag")).agg(F.corr("_first", "_second").alias("corr"))


def simple_regression(
    rows: DataFrame, x: str, y: str, keys: Sequence[str] = (), confidence: float | None = None
) -> DataFrame:
    """Least squares of y on x: coefficients, their standard errors and t values, fit.

    With ``confidence`` (such as 0.95) also the two-sided probabilities ``slope_p`` and ``intercept_p``, the
    ``f`` value of the fit with ``f_p``, and the limits ``slope_low``, ``slope_high``, ``intercept_low`` and
    ``intercept_high``. All of these are null for fewer than three pairs; those that divide by an error are
    so for a perfect fit.
    """
    xd, yd = F.col("_x"), F.col("_y")
    sums = _pair(rows, keys, x, y).groupBy(*keys).agg(
        F.regr_count(yd, xd).alias("n"),
        F.regr_slope(yd, xd).alias("slope"),
        F.regr_intercept(yd, xd).alias("intercept"),
        F.regr_r2(yd, xd).alias("r2"),
        F.regr_sxx(yd, xd).alias("_sxx"),
        F.regr_syy(yd, xd).alias("_syy"),
        F.regr_avgx(yd, xd).alias("_mean_x"),
    )
    free = F.nullif(F.greatest(F.col("n") - 2, F.lit(0)), F.lit(0)).cast("double")
    variance = (1 - F.col("r2")) * F.col("_syy") / free
    sxx = F.nullif(F.col("_sxx"), F.lit(0.0))
    slope_error = F.sqrt(variance / sxx)
    intercept_error = F.sqrt(variance * (1 / F.col("n") + F.pow("_mean_x", F.lit(2)) / sxx))
    fitted = (
        sums.withColumn("slope_error", slope_error)
        .withColumn("intercept_error", intercept_error)
        .withColumn("slope_t", F.col("slope") / F.nullif(F.col("slope_error"), F.lit(0.0)))
        .withColumn("intercept_t", F.col("intercept") / F.nullif(F.col("intercept_error"), F.lit(0.0)))
        .withColumn("r2_adjusted", 1 - (1 - F.col("r2")) * (F.col("n") - 1) / free)
        .drop("_sxx", "_syy", "_mean_x")
    )
    return fitted if confidence is None else _with_tests(fitted, confidence)


def _with_tests(fitted: DataFrame, confidence: float) -> DataFrame:
    """One row per fit: probabilities and limits from the t distribution."""
    free = F.nullif(F.greatest(F.col("n") - 2, F.lit(0)), F.lit(0)).cast("double")
    reach = student_quantile(1 - confidence, F.col("_free"))
    tested = fitted.withColumn("_free", free).withColumn("_reach", reach)
    for name in ("slope", "intercept"):
        tested = (
            tested.withColumn(f"{name}_p", student_tail(F.col(f"{name}_t"), F.col("_free")))
            .withColumn(f"{name}_low", F.col(name) - F.col("_reach") * F.col(f"{name}_error"))
            .withColumn(f"{name}_high", F.col(name) + F.col("_reach") * F.col(f"{name}_error"))
        )
    # With one regressor the fit's F value is the square of the slope's t value.
    return tested.withColumn("f", F.col("slope_t") * F.col("slope_t")).withColumn("f_p", F.col("slope_p")).drop("_free", "_reach")
