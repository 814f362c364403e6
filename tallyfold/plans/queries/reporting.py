"""Reports: shares, ranks, frequencies, summaries, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.fixed_values import SIGNIFICANT_RANK
from tallyfold.functions import columns as fx
from tallyfold.operators import ordered, quality, report, reshape
from tallyfold.plans.registry import query
from tallyfold.plans.standins import cumulated, table, with_sql
from tallyfold.session import staged

PLACE = ["state", "county", "fips"]

_REVENUE = """revenue AS (
  SELECT l_partkey, round(sum(l_extendedprice), 2) AS cases, CAST(sum(l_quantity) AS BIGINT) AS deaths
  FROM lineitem GROUP BY 1)"""


def _revenue(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("cases"), F.sum("l_quantity").cast("bigint").alias("deaths"))
    )


_RANKS = """ranked AS (SELECT *, rank() OVER (ORDER BY cases DESC) AS rank_cases, rank() OVER (ORDER BY deaths DESC) AS rank_deaths,
  cases / (SELECT sum(cases) FROM revenue) AS ratio_cases, deaths / (SELECT sum(deaths) FROM revenue) AS ratio_deaths FROM revenue)"""
_SHOWN = "l_partkey, cases, deaths, rank_cases, rank_deaths, round(ratio_cases, 8) AS ratio_cases, round(ratio_deaths, 8) AS ratio_deaths"


def _ranked(spark, sf):
    return report.rank_and_share(_revenue(spark, sf), ["cases", "deaths"])


def _shown(rows):
    ratios = [F.round(c, 8).alias(c) for c in ("ratio_cases", "ratio_deaths")]
    return rows.select("l_partkey", "cases", "deaths", "rank_cases", "rank_deaths", *ratios)


@query("m4_rank_and_share", "M4 F11 E19 D15 J13", f"WITH {_REVENUE},\n{_RANKS}\nSELECT {_SHOWN} FROM ranked")
def m4_rank_and_share(spark, sf):
    return _shown(_ranked(spark, sf))


@query(
    "i4_significant_ranks",
    "I4",
    f"WITH {_REVENUE},\n{_RANKS}\nSELECT {_SHOWN} FROM ranked WHERE rank_cases < 500 OR rank_deaths < 500",
)
def i4_significant_ranks(spark, sf):
    return _shown(_ranked(spark, sf).where((F.col("rank_cases") < SIGNIFICANT_RANK) | (F.col("rank_deaths") < SIGNIFICANT_RANK)))


@query(
    "f11_rank_lines",
    "F11",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rank_quantity
FROM lineitem""",
)
def f11_rank_lines(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return ordered.global_rank(rows, "l_quantity", "rank_quantity")


_TOTALS = """totals AS (SELECT state, county, fips, max(cases) AS cases, max(deaths) AS deaths FROM cumulated GROUP BY ALL)"""


def _totals(spark, sf):
    return report.totals_per_location(cumulated(spark, sf), PLACE, ["cases", "deaths"])


@query("e5_totals_per_place", "E5", with_sql("cumulated", "SELECT * FROM totals", _TOTALS))
def e5_totals_per_place(spark, sf):
    return _totals(spark, sf)


@query(
    "i5_ranks_without_code",
    "I5 J12 N5",
    with_sql(
        "cumulated",
        """SELECT state, county, format('{:.2e}', ratio) AS share, rank_cases FROM (
  SELECT *, CAST(cases AS DOUBLE) / (SELECT sum(cases) FROM totals) AS ratio, rank() OVER (ORDER BY cases DESC) AS rank_cases FROM totals)
WHERE fips IS NULL""",
        _TOTALS,
    ),
)
def i5_ranks_without_code(spark, sf):
    rows = report.rank_and_share(staged(_totals(spark, sf), "totals"), ["cases"])
    return rows.where(F.col("fips").isNull()).select(
        "state", "county", fx.scientific("ratio_cases").alias("share"), "rank_cases"
    )


@query(
    "e16_crosstab",
    "E16 C17",
    with_sql(
        "cumulated",
        """SELECT state, CAST(sum(deaths) FILTER (fips IS NULL) AS BIGINT) AS no_fips,
       CAST(sum(deaths) FILTER (fips IS NOT NULL) AS BIGINT) AS fips_exist FROM totals GROUP BY 1""",
        _TOTALS,
    ),
)
def e16_crosstab(spark, sf):
    flag = F.when(F.col("fips").isNull(), 0).otherwise(1)
    return reshape.crosstab_sums(_totals(spark, sf), "state", flag, "deaths", {0: "no_fips", 1: "fips_exist"})


@query(
    "i2_top_parts",
    "I2 I1",
    f"WITH {_REVENUE}\nSELECT l_partkey, cases FROM revenue ORDER BY cases DESC, l_partkey LIMIT 10",
)
def i2_top_parts(spark, sf):
    rows = _revenue(spark, sf).select("l_partkey", "cases")
    return report.top_rows(rows, [F.desc("cases"), F.asc("l_partkey")], 10)


@query("i1_sorted_nations", "I1 I3", "SELECT n_name, n_regionkey FROM nation ORDER BY n_regionkey DESC, n_name")
def i1_sorted_nations(spark, sf):
    return table(spark, sf, "nation").select("n_name", "n_regionkey").orderBy(F.desc("n_regionkey"), "n_name")


@query(
    "i3_preview",
    "I3",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20",
)
def i3_preview(spark, sf):
    return report.top_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.asc("o_orderkey")], 20)


@query(
    "e11_value_counts",
    "E11",
    "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL",
)
def e11_value_counts(spark, sf):
    return report.value_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "e13_describe",
    "E13 E7",
    """SELECT count(*) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75
FROM lineitem""",
)
def e13_describe(spark, sf):
    return _rounded(report.describe(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice"))


def _rounded(summary, keys=()):
    numbers = [F.round(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75") if c in summary.columns]
    return summary.select(*keys, "count", "min", "max", *numbers)


@query(
    "e13_describe_groups",
    "E13 E12",
    """SELECT l_returnflag, count(*) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75
FROM lineitem GROUP BY 1""",
)
def e13_describe_groups(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return _rounded(report.describe(rows, "l_extendedprice", ["l_returnflag"]), ["l_returnflag"])


@query(
    "e12_group_summary",
    "E12",
    """SELECT c_nationkey, c_mktsegment, round(avg(c_acctbal), 4) AS mean, round(median(c_acctbal), 4) AS median,
       min(c_acctbal) AS min, max(c_acctbal) AS max, count(*) AS len FROM customer GROUP BY ALL""",
)
def e12_group_summary(spark, sf):
    rows = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_acctbal")
    summary = report.group_summary(rows, "c_acctbal", ["c_nationkey", "c_mktsegment"])
    numbers = [F.round(c, 4).alias(c) for c in ("mean", "median")]
    return summary.select("c_nationkey", "c_mktsegment", *numbers, "min", "max", "len")


@query(
    "e14_histogram",
    "E14",
    """SELECT CAST(least(floor((l_quantity - lo) / ((hi - lo) / 10)), 9) AS INT) AS bin, count(*) AS count,
       round(any_value(lo) + (any_value(hi) - any_value(lo)) / 10 * least(floor((l_quantity - lo) / ((hi - lo) / 10)), 9), 6) AS lower_edge
FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
GROUP BY least(floor((l_quantity - lo) / ((hi - lo) / 10)), 9)""",
)
def e14_histogram(spark, sf):
    rows = report.histogram(table(spark, sf, "lineitem").select("l_quantity"), "l_quantity", 10)
    return rows.select("bin", F.round("lower_edge", 6).alias("lower_edge"), "count")


@query(
    "e8_repeated_lines",
    "E8 L1",
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def e8_repeated_lines(spark, sf):
    return report.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "e4_count_range",
    "E4 E3",
    """SELECT user_id, min(n) AS min_count, max(n) AS max_count
FROM (SELECT user_id, event_type, count(ts) AS n FROM events GROUP BY ALL) GROUP BY 1""",
)
def e4_count_range(spark, sf):
    return report.count_range(table(spark, sf, "events"), ["user_id", "event_type"], ["user_id"], "ts")


@query(
    "e3_count_present",
    "E3 C10",
    """SELECT l_suppkey, count(CASE WHEN l_discount > 0.05 THEN l_discount END) AS present FROM lineitem
WHERE l_returnflag <> 'N' AND l_quantity IS NOT NULL GROUP BY 1""",
)
def e3_count_present(spark, sf):
    rows = table(spark, sf, "lineitem").where((F.col("l_returnflag") != "N") & F.col("l_quantity").isNotNull())
    present = F.when(F.col("l_discount") > 0.05, F.col("l_discount"))
    return rows.groupBy("l_suppkey").agg(F.count(present).alias("present"))


@query(
    "e19_share_of_rows",
    "E19",
    "SELECT round(count(*) FILTER (l_returnflag = 'A') / count(*), 8) AS share FROM lineitem",
)
def e19_share_of_rows(spark, sf):
    share = report.share_of(table(spark, sf, "lineitem"), F.col("l_returnflag") == "A")
    return share.select(F.round("share", 8).alias("share"))


@query(
    "e7_overall",
    "E7",
    "SELECT max(l_extendedprice) AS max, min(l_extendedprice) AS min, CAST(sum(l_quantity) AS BIGINT) AS sum FROM lineitem",
)
def e7_overall(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.max("l_extendedprice").alias("max"),
        F.min("l_extendedprice").alias("min"),
        F.sum("l_quantity").cast("bigint").alias("sum"),
    )


_URGENT = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
_FAILED = "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'"


def _buyers(spark, sf, condition):
    return table(spark, sf, "orders").where(condition).select("o_custkey")


@query("h1_union_all", "H1 H2", f"{_URGENT} UNION ALL {_FAILED}")
def h1_union_all(spark, sf):
    left = _buyers(spark, sf, F.col("o_orderpriority") == "1-URGENT")
    return left.unionByName(_buyers(spark, sf, F.col("o_orderstatus") == "F"))


@query("h4_union_distinct", "H4", f"{_URGENT} UNION {_FAILED}")
def h4_union_distinct(spark, sf):
    left = _buyers(spark, sf, F.col("o_orderpriority") == "1-URGENT")
    return reshape.union_distinct(left, _buyers(spark, sf, F.col("o_orderstatus") == "F"))


@query("h5_set_difference", "H5", f"{_URGENT} EXCEPT {_FAILED}")
def h5_set_difference(spark, sf):
    left = _buyers(spark, sf, F.col("o_orderpriority") == "1-URGENT")
    return left.subtract(_buyers(spark, sf, F.col("o_orderstatus") == "F"))


@query("h6_distinct", "H6", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def h6_distinct(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()


@query(
    "h7_frame_equality",
    "H7",
    """SELECT 'same' AS pair, true AS equal UNION ALL SELECT 'one filtered', NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderstatus = 'F')""",
)
def h7_frame_equality(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    again = orders.repartition("o_custkey")
    filtered = orders.where(F.col("o_orderstatus") != "F")
    parts = [
        reshape.same_rows(orders, other).select(F.lit(name).alias("pair"), "equal")
        for name, other in (("same", again), ("one filtered", filtered))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "l9_separator_check",
    "L9",
    "SELECT contains(text, ',') AS has_separator, count(*) AS count FROM documents GROUP BY 1",
)
def l9_separator_check(spark, sf):
    return quality.holds_separator(table(spark, sf, "documents").select("text"), "text", ",")


@query(
    "j3_strip_and_find",
    "J3 J2",
    """SELECT s_suppkey, trim('.' || s_name || '..', '.') AS name, instr(s_name, '#') AS position FROM supplier""",
)
def j3_strip_and_find(spark, sf):
    rows = fx.lower_names(table(spark, sf, "supplier").withColumnRenamed("s_name", "S_NAME"))
    dotted = F.concat(F.lit("."), F.col("s_name"), F.lit(".."))
    return rows.select(
        "s_suppkey", fx.strip_dots(dotted).alias("name"), F.instr("s_name", "#").cast("bigint").alias("position")
    )


@query(
    "j10_days_before",
    "J10",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 4 AS VARCHAR) AS start FROM orders",
)
def j10_days_before(spark, sf):
    day = fx.days_before(F.col("o_orderdate").cast("date"), 4)
    return table(spark, sf, "orders").select("o_orderkey", day.cast("string").alias("start"))


@query(
    "e14_histogram_nan",
    "E14",
    """SELECT CAST(least(floor((q - lo) / ((hi - lo) / 10)), 9) AS INT) AS bin, count(*) AS count,
       round(any_value(lo) + (any_value(hi) - any_value(lo)) / 10 * least(floor((q - lo) / ((hi - lo) / 10)), 9), 6) AS lower_edge
FROM (SELECT l_quantity AS q FROM lineitem WHERE l_linenumber <> 3 AND l_linenumber <> 5),
     (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem WHERE l_linenumber <> 3 AND l_linenumber <> 5)
GROUP BY least(floor((q - lo) / ((hi - lo) / 10)), 9)""",
)
def e14_histogram_nan(spark, sf):
    """Every third line of an order is NaN, every fifth null."""
    number = F.col("l_linenumber")
    value = F.when(number == 3, F.lit(float("nan"))).when(number != 5, F.col("l_quantity").cast("double"))
    rows = report.histogram(table(spark, sf, "lineitem").select(value.alias("q")), "q", 10)
    return rows.select("bin", F.round("lower_edge", 6).alias("lower_edge"), "count")
