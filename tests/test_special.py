"""Tails and quantiles of the t distribution against its finite series, and the tests of a fit."""

import math

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.special import student_quantile, student_tail
from tallyfold.operators import stats


def tail(t, df):
    """1 - A(t | df), by the finite series for whole degrees of freedom."""
    theta = math.atan(t / math.sqrt(df))
    cos2, term, total = math.cos(theta) ** 2, 1.0, 1.0
    for k in range(2 + df % 2, df - 1, 2):
        term *= (k - 1) / k * cos2
        total += term
    if df % 2 == 0:
        return 1 - math.sin(theta) * total
    return 1 - 2 / math.pi * (theta + (math.sin(theta) * math.cos(theta) * total if df > 1 else 0))


def test_tails(spark):
    points = [(t, float(df)) for df in (1, 2, 3, 4, 7, 30, 31, 1001, 20_000) for t in (0.0, 1e-6, 0.3, 1.0, 1.22, 1.23, 1.96, 4.0, -2.5)]
    rows = spark.createDataFrame(points, "t double, df double").withColumn("p", student_tail(F.col("t"), F.col("df"))).collect()
    for r in rows:
        assert r.p == pytest.approx(tail(abs(r.t), int(r.df)), abs=1e-9)
    # Far out and for many pairs: relative to the known values.
    known = [(40.0, 10.0, 2.280857743084e-12), (5.0, 1e9, 5.733031438e-7)]
    for t, df, p in known:
        assert spark.range(1).select(student_tail(F.lit(t), F.lit(df)).alias("p")).first().p == pytest.approx(p, rel=1e-5)


def test_quantiles(spark):
    # Published two-sided 95 % and 99 % points.
    known = {1: (12.706204736, 63.656741162), 2: (4.302652730, 9.924843201), 10: (2.228138852, 3.169272673), 1000: (1.962339081, 2.580754698)}
    frame = spark.createDataFrame([(float(df),) for df in known], "df double")
    for r in frame.select("df", student_quantile(0.05, F.col("df")).alias("a"), student_quantile(0.01, F.col("df")).alias("b")).collect():
        assert (r.a, r.b) == pytest.approx(known[int(r.df)], rel=1e-9)


def test_few_pairs_and_perfect_fits(spark):
    points = [("one", 1.0, 2.0), ("two", 1.0, 2.0), ("two", 2.0, 3.0), ("three", 1.0, 1.0), ("three", 2.0, 3.0), ("three", 3.0, 4.0)]
    points += [("line", float(i), 2.0 * i) for i in range(5)] + [("gap", None, 1.0), ("gap", 1.0, float("nan"))]
    frame = spark.createDataFrame(points, "k string, x double, y double")
    rows = {r.k: r for r in stats.simple_regression(frame, "x", "y", ["k"], confidence=0.95).collect()}
    for k in ("one", "two", "gap"):
        assert [rows[k][c] for c in ("slope_p", "f", "slope_low", "intercept_high")] == [None] * 4
    assert rows["line"].slope_p is None or rows["line"].slope_p < 1e-9
    r = rows["three"]  # slope 1.5, error sqrt(1/12), one degree of freedom
    assert r.slope_t == pytest.approx(1.5 * math.sqrt(12)) and r.f == pytest.approx(27)
    assert r.slope_p == pytest.approx(tail(r.slope_t, 1), abs=1e-12) == r.f_p
    assert (r.slope_low, r.slope_high) == pytest.approx((1.5 - 12.706204736 / math.sqrt(12), 1.5 + 12.706204736 / math.sqrt(12)))
