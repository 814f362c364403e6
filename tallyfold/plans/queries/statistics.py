"""Correlation and regression. Purchases and clicks per day play cases and weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import stats
from tallyfold.operators.timeseries import month_of
from tallyfold.plans.registry import query
from tallyfold.plans.standins import table

_DAYS = """days AS (SELECT CAST(ts AS DATE) AS date, count(*) FILTER (event_type = 'purchase') AS purchases,
  count(*) FILTER (event_type = 'click') AS clicks, round(sum(value), 2) AS amount FROM events GROUP BY 1)"""
_ORDER_DAYS = """days AS (SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS date, count(*) AS n,
  round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY ALL)"""


def _days(spark, sf):
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .groupBy(F.col("ts").cast("date").alias("date"))
        .agg(
            F.count_if(kind == "purchase").alias("purchases"),
            F.count_if(kind == "click").alias("clicks"),
            F.round(F.sum("value"), 2).alias("amount"),
        )
    )


def _order_days(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("amount"))
    )


@query("m1_correlation", "M1", f"WITH {_DAYS} SELECT round(corr(purchases, clicks), 8) AS corr FROM days")
def m1_correlation(spark, sf):
    rows = stats.correlation(_days(spark, sf), "purchases", "clicks")
    return rows.select(F.round("corr", 8).alias("corr"))


@query(
    "m1_correlation_lines",
    "M1",
    "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS corr FROM lineitem GROUP BY 1",
)
def m1_correlation_lines(spark, sf):
    rows = stats.correlation(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rows.select("l_returnflag", F.round("corr", 8).alias("corr"))


_LAGGED = """WITH {days},
numbered AS (SELECT *, row_number() OVER ({part} ORDER BY date) AS pos FROM days)
SELECT {key} CAST(lag AS BIGINT) AS lag, round(corr(a.{x}, b.{y}), 8) AS corr
FROM numbered a, (SELECT unnest(range({lo}, {hi})) AS lag) l, numbered b
WHERE b.pos = a.pos - lag {on} GROUP BY ALL"""


@query(
    "m2_lagged_correlation",
    "M2",
    _LAGGED.format(days=_DAYS, part="", key="", x="purchases", y="clicks", lo=-10, hi=15, on=""),
)
def m2_lagged_correlation(spark, sf):
    rows = stats.lagged_correlation(_days(spark, sf), "purchases", "clicks", range(-10, 15), block=month_of("date"))
    return rows.select(F.col("lag").cast("bigint").alias("lag"), F.round("corr", 8).alias("corr"))


@query(
    "m2_lagged_per_group",
    "M2 C22",
    _LAGGED.format(
        days=_ORDER_DAYS, part="PARTITION BY status", key="a.status AS status,", x="n", y="amount", lo=-60, hi=60,
        on="AND a.status = b.status",
    ),
)
def m2_lagged_per_group(spark, sf):
    rows = stats.lagged_correlation(
        _order_days(spark, sf), "n", "amount", range(-60, 60), ["status"], block=month_of("date")
    )
    return rows.select("status", F.col("lag").cast("bigint").alias("lag"), F.round("corr", 8).alias("corr"))


_FIT = """SELECT {key} CAST(n AS BIGINT) AS n, round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(r2, 8) AS r2,
  round(sqrt((1 - r2) * syy / (n - 2) / sxx), 6) AS slope_error,
  round(slope / sqrt((1 - r2) * syy / (n - 2) / sxx), 4) AS slope_t
FROM (SELECT {key} regr_count(y, x) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2,
             regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM {source} GROUP BY ALL)"""


def _fit(rows, keys=()):
    digits = {"slope": 6, "intercept": 4, "r2": 8, "slope_error": 6, "slope_t": 4}
    return rows.select(*keys, "n", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "m3_simple_regression",
    "M3",
    f"WITH {_DAYS}, points AS (SELECT CAST(purchases AS DOUBLE) AS y, CAST(clicks AS DOUBLE) AS x FROM days) "
    + _FIT.format(key="", source="points"),
)
def m3_simple_regression(spark, sf):
    return _fit(stats.simple_regression(_days(spark, sf), "clicks", "purchases"))


@query(
    "m3_regression_lines",
    "M3",
    "WITH points AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity AS x FROM lineitem) "
    + _FIT.format(key="l_returnflag,", source="points"),
)
def m3_regression_lines(spark, sf):
    rows = stats.simple_regression(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return _fit(rows, ["l_returnflag"])


_WITH_GAPS = """SELECT l_returnflag, l_quantity AS q, l_extendedprice AS p FROM lineitem
WHERE l_linenumber <> 2 AND l_linenumber <> 4"""


def _with_gaps(spark, sf):
    """Second lines of an order have a NaN quantity, fourth ones a NaN price."""
    number, nan = F.col("l_linenumber"), F.lit(float("nan"))
    return table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(number == 2, nan).otherwise(F.col("l_quantity").cast("double")).alias("q"),
        F.when(number == 4, nan).otherwise(F.col("l_extendedprice").cast("double")).alias("p"),
    )


@query(
    "m1_correlation_nan",
    "M1",
    f"SELECT l_returnflag, round(corr(q, p), 8) AS corr FROM ({_WITH_GAPS}) GROUP BY 1",
)
def m1_correlation_nan(spark, sf):
    rows = stats.correlation(_with_gaps(spark, sf), "q", "p", ["l_returnflag"])
    return rows.select("l_returnflag", F.round("corr", 8).alias("corr"))


@query(
    "m3_regression_nan",
    "M3",
    f"""SELECT l_returnflag, regr_count(p, q) AS n, round(regr_slope(p, q), 4) AS slope, round(regr_r2(p, q), 8) AS r2
FROM ({_WITH_GAPS}) GROUP BY 1""",
)
def m3_regression_nan(spark, sf):
    rows = stats.simple_regression(_with_gaps(spark, sf), "q", "p", ["l_returnflag"])
    return rows.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("r2", 8).alias("r2"))


# The finite series of the t distribution with n - 2 degrees of freedom: with theta = atan(t / sqrt(n - 2)),
# products of (k - 1) / k * cos(theta)^2 for odd or for even k, summed up.
_CENTRAL = """(CASE WHEN n % 2 = 0 THEN 0 ELSE 2 / pi() * atan({t} / sqrt(n - 2)) END
  + sin(atan({t} / sqrt(n - 2))) * CASE WHEN n = 3 THEN 0 ELSE
    CASE WHEN n % 2 = 0 THEN 1.0 ELSE 2 / pi() * cos(atan({t} / sqrt(n - 2))) END
    * list_sum(list_transform(range(0, (n - 2 - n % 2) // 2), lambda i: coalesce(list_product(list_transform(range(1, i + 1),
        lambda k: (2 * k - 1 + n % 2) / (2 * k + n % 2) * pow(cos(atan({t} / sqrt(n - 2))), 2))), 1.0))) END)"""


@query(
    "m3_regression_tests",
    "M3",
    f"""WITH RECURSIVE {_DAYS},
fit AS (SELECT regr_count(purchases, clicks) AS n, regr_slope(purchases, clicks) AS slope, regr_intercept(purchases, clicks) AS intercept,
  (1 - regr_r2(purchases, clicks)) * regr_syy(purchases, clicks) / (regr_count(purchases, clicks) - 2) AS var,
  regr_sxx(purchases, clicks) AS sxx, regr_avgx(purchases, clicks) AS mean FROM days),
errors AS (SELECT *, sqrt(var / sxx) AS se, sqrt(var * (1 / n + mean * mean / sxx)) AS ie FROM fit),
halved AS (SELECT n, 0.0::DOUBLE AS low, 100.0::DOUBLE AS high, 0 AS step FROM fit
  UNION ALL SELECT n, CASE WHEN inner_part < 0.95 THEN (low + high) / 2 ELSE low END,
    CASE WHEN inner_part < 0.95 THEN high ELSE (low + high) / 2 END, step + 1
  FROM (SELECT *, {_CENTRAL.format(t="((low + high) / 2)")} AS inner_part FROM halved WHERE step < 60)),
reach AS (SELECT low AS q FROM halved WHERE step = 60)
SELECT CAST(n AS BIGINT) AS n, round(1 - {_CENTRAL.format(t="abs(slope / se)")}, 9) AS slope_p,
  round(1 - {_CENTRAL.format(t="abs(intercept / ie)")}, 9) AS intercept_p, round(pow(slope / se, 2), 6) AS f,
  round(1 - {_CENTRAL.format(t="abs(slope / se)")}, 9) AS f_p, round(slope - q * se, 7) AS slope_low, round(slope + q * se, 7) AS slope_high,
  round(intercept - q * ie, 5) AS intercept_low, round(intercept + q * ie, 5) AS intercept_high
FROM errors, reach""",
)
def m3_regression_tests(spark, sf):
    """Probabilities, F test and 95 % limits of the fit."""
    rows = stats.simple_regression(_days(spark, sf), "clicks", "purchases", confidence=0.95)
    digits = {"slope_p": 9, "intercept_p": 9, "f": 6, "f_p": 9, "slope_low": 7, "slope_high": 7, "intercept_low": 5, "intercept_high": 5}
    return rows.select("n", *[F.round(c, d).alias(c) for c, d in digits.items()])
