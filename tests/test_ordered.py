"""Ordered operators against pandas, with a hot key and ties; plans keep the shapes they need."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import latest, ordered, quality, report, stats
from tallyfold.operators.joins import keep_known
from tallyfold.plans import queries as _registered  # noqa: F401
from tallyfold.plans.registry import QUERIES


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows share one key, a third of the values are equal."""
    g = np.random.default_rng(5)
    n = 3000
    key = np.where(g.random(n) < 0.34, 0, g.integers(1, 40, n))
    value = np.where(g.random(n) < 0.34, 7.0, np.round(g.lognormal(2, 1.5, n), 2))
    return pd.DataFrame({"id": np.arange(n), "key": key, "value": value})


@pytest.mark.parametrize("blocks", [2, 16, 256])
def test_global_rank(spark, skewed, blocks):
    got = ordered.global_rank(spark.createDataFrame(skewed), "value", "r", blocks=blocks).toPandas().sort_values("id")
    assert (got["r"].to_numpy() == skewed["value"].rank(method="min", ascending=False).to_numpy()).all()


def test_rank_leaves_nulls_open(spark):
    frame = spark.createDataFrame([(1, 5.0), (2, None), (3, 6.0)], "id int, value double")
    assert {r.id: r.r for r in ordered.global_rank(frame, "value", "r").collect()} == {1: 2, 2: None, 3: 1}


def test_quantiles_per_key(spark, skewed):
    frame = spark.createDataFrame(skewed)
    got = report.describe(frame, "value", ["key"]).toPandas().set_index("key").sort_index()
    expected = skewed.groupby("key")["value"].describe()
    for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        np.testing.assert_allclose(got[mine].astype(float), expected[theirs])


def test_statistics_skip_nan_and_null(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), ("a", 4.0), (None, 2.0)], "k string, v double")
    row = report.describe(frame.where("k = 'a'"), "v").first()
    assert (row["count"], row.mean, row.max, row.p50) == (2, 2.5, 4.0, 2.5)
    got = {r.k: (r.len, r.mean, r.median) for r in report.group_summary(frame, "v", ["k"]).collect()}
    assert got == {"a": (4, 2.5, 2.5), None: (1, 2.0, 2.0)}


def test_blocks_change_nothing(spark, skewed):
    """Positions, running totals and previous values with and without blocks, null keys included."""
    frame = spark.createDataFrame(skewed).withColumn("key", F.nullif("key", F.lit(0)))
    pandas = skewed.assign(key=skewed["key"].replace(0, -1)).sort_values("id")
    grouped = pandas.groupby("key")
    block = F.floor(F.col("id") / 100)
    positions = ordered.row_positions(frame, ["key"], "id", block).toPandas().sort_values("id")
    assert (positions["pos"].to_numpy() == grouped.cumcount().to_numpy()).all()
    whole = frame.withColumn("value", F.round(F.col("value") * 100).cast("long"))
    totals = ordered.running_totals(whole, "id", "value", ["key"], block=block).toPandas().sort_values("id")
    cents = (pandas["value"] * 100).round().astype(int)
    before = cents.groupby(pandas["key"]).cumsum() - cents
    assert (totals["before"].to_numpy() == before.to_numpy()).all()
    assert (totals["total"].to_numpy() == cents.groupby(pandas["key"]).transform("sum").to_numpy()).all()
    previous = ordered.previous_values(frame, ["key"], "id", ["value"], block).toPandas().sort_values("id")
    np.testing.assert_array_equal(previous["value_previous"].to_numpy(), grouped["value"].shift().to_numpy())


def test_lagged_correlation(spark):
    g = np.random.default_rng(3)
    data = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=120).date, "a": g.random(120)})
    data["b"] = data["a"].shift(-5) + g.random(120) / 10
    frame = spark.createDataFrame(data).withColumn("b", F.nanvl("b", F.lit(None)))
    for block in (None, F.trunc("date", "month")):
        rows = stats.lagged_correlation(frame, "a", "b", range(-8, 9), block=block).collect()
        got = {r.lag: r["corr"] for r in rows}
        expected = {lag: data["a"].corr(data["b"].shift(lag)) for lag in range(-8, 9)}
        assert got == pytest.approx(expected)
        assert max(got, key=got.get) == 5


def test_regression_errors(spark):
    g = np.random.default_rng(4)
    x = g.random(50)
    y = 3 * x + 1 + g.normal(0, 0.1, 50)
    row = stats.simple_regression(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), "x", "y").first()
    design = np.column_stack([np.ones(50), x])
    beta, residual, *_ = np.linalg.lstsq(design, y, rcond=None)
    covariance = residual[0] / 48 * np.linalg.inv(design.T @ design)
    assert row.slope == pytest.approx(beta[1]) and row.intercept == pytest.approx(beta[0])
    assert row.slope_error == pytest.approx(covariance[1, 1] ** 0.5)
    assert row.intercept_error == pytest.approx(covariance[0, 0] ** 0.5)
    assert row.slope_t == pytest.approx(beta[1] / covariance[1, 1] ** 0.5)


def test_histogram_matches_numpy(spark, skewed):
    counts, edges = np.histogram(skewed["value"], bins=10)
    got = {r.bin: r["count"] for r in report.histogram(spark.createDataFrame(skewed), "value", 10).collect()}
    assert [got.get(i, 0) for i in range(10)] == list(counts)
    same = spark.createDataFrame([(2.0,), (2.0,)], "value double")
    assert [(r.bin, r["count"]) for r in report.histogram(same, "value").collect()] == [(0, 2)]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rank_is_cut_before_the_shuffle(spark, skewed):
    text = plan(latest.leading_rows(spark.createDataFrame(skewed), ["key"], [F.desc("value")]))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    frame = report.duplicates(lines.where(F.col("l_quantity") > 40), ["l_orderkey"])
    text = plan(frame)
    assert "GreaterThan(l_quantity,40.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_no_query_leaves_the_jvm_or_pairs_everything(spark):
    """No Python stage, and no nested loop or product except against a one-row broadcast."""
    small = "/root/testdata/sf0.001"
    for name in ("g1_nearest_per_element", "k12_two_batches", "m4_rank_and_share", "m2_lagged_per_group", "g6_resolve_locations"):
        text = plan(QUERIES[name].run(spark, small))
        assert "Python" not in text and "CartesianProduct" not in text, name


def test_semi_join_and_days_do_not_multiply(spark):
    rows = spark.createDataFrame([("s", "T", 1, None), ("s", "T", 1, None), ("s", "T", 2, None)], "station_id string, measured string, date int, quality_flag string")
    twice = spark.createDataFrame([("s", "T"), ("s", "T")], "station_id string, measured string")
    assert keep_known(rows, twice, ["station_id", "measured"]).count() == 3
    assert quality.reporting_days(rows).first().nb_days == 2
    assert quality.significant_pairs(rows, 2).count() == 0
