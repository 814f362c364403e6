"""Queries on the star schema. Orders play the case lines: priority and segment are the labels.

One label is missing from the dimension, so the left and the inner load differ.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import quality, star
from tallyfold.operators.star import Dimension
from tallyfold.plans.registry import query
from tallyfold.plans.standins import table

_LABELS = ["segment", "priority"]
_LINES = """lines AS (SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS segment, split_part(o_orderpriority, '-', 2) AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
_DIMS = """dim_segment AS (SELECT segment, CAST(row_number() OVER (ORDER BY segment) AS INT) * 10 AS segment_id
  FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'FURNITURE')),
dim_priority AS (SELECT * FROM (VALUES (1, 'URGENT'), (2, 'HIGH'), (3, 'MEDIUM'), (4, 'NOT SPECIFIED'), (1000, 'Missing')) d(priority_id, priority))"""
_WITH = f"WITH {_LINES},\n{_DIMS}\n"
_JOINS = "lines l {how} JOIN dim_segment s ON l.segment = s.segment {how} JOIN dim_priority p ON l.priority = p.priority"


def _lines(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    orders = table(spark, sf, "orders")
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderdate").cast("date").alias("date"),
        "segment",
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("priority"),
    )


def _dimensions(spark):
    segments = [(10, "AUTOMOBILE"), (20, "BUILDING"), (30, "HOUSEHOLD"), (40, "MACHINERY")]
    priorities = [(1, "URGENT"), (2, "HIGH"), (3, "MEDIUM"), (4, "NOT SPECIFIED"), (1000, "Missing")]
    return [
        Dimension(spark.createDataFrame(segments, "segment_id int, segment string"), "segment", "segment_id"),
        Dimension(spark.createDataFrame(priorities, "priority_id int, priority string"), "priority", "priority_id"),
    ]


_IDS = ["segment_id", "priority_id"]


def _fact(spark, sf, how):
    counted = star.group_counts(_lines(spark, sf), ["date", *_LABELS])
    return star.sum_fact(star.attach_dimensions(counted, _dimensions(spark), how), ["date", *_IDS])


def _show(fact):
    return fact.select(F.col("date").cast("string").alias("date"), *_IDS, "count")


def _star_sql(how, where=""):
    return (
        f"{_WITH}SELECT CAST(date AS VARCHAR) AS date, segment_id, priority_id, count(*) AS count FROM "
        + _JOINS.format(how=how)
        + f" {where} GROUP BY ALL"
    )


@query("d9_star_left", "D9 E17 A13 J2 N4", _star_sql("LEFT"))
def d9_star_left(spark, sf):
    return _show(_fact(spark, sf, "left"))


@query("d10_star_inner", "D10 E17 A13", _star_sql("INNER"))
def d10_star_inner(spark, sf):
    return _show(_fact(spark, sf, "inner"))


_LAST = "(SELECT max(date) FROM lines WHERE date <= DATE '1999-12-31')"


@query("k11_incremental_star", "K11 C19 K10 D10 B6", _star_sql("INNER", f"WHERE date > {_LAST}"))
def k11_incremental_star(spark, sf):
    lines = _lines(spark, sf)
    loaded = lines.where(F.col("date") <= F.lit("1999-12-31").cast("date"))
    return _show(star.incremental_population_rows(loaded, lines, _dimensions(spark), _LABELS, "date"))


@query(
    "e17_group_counts",
    "E17",
    f"{_WITH}SELECT CAST(date AS VARCHAR) AS date, segment, priority, count(*) AS count FROM lines GROUP BY ALL",
)
def e17_group_counts(spark, sf):
    counted = star.group_counts(_lines(spark, sf), ["date", *_LABELS])
    return counted.select(F.col("date").cast("string").alias("date"), *_LABELS, "count")


@query(
    "e18_reconciles",
    "E18",
    f"""{_WITH}SELECT grouped, n AS lines, grouped = n AS agrees FROM (SELECT count(*) AS n FROM lines),
  (SELECT sum(c) AS grouped FROM (SELECT date, segment, priority, count(*) AS c FROM lines WHERE segment <> 'BUILDING' GROUP BY ALL))""",
)
def e18_reconciles(spark, sf):
    """One segment's groups are missing, which the check has to show."""
    lines = _lines(spark, sf)
    counted = star.group_counts(lines, ["date", *_LABELS]).where(F.col("segment") != "BUILDING")
    return quality.reconciles(counted, lines)


@query(
    "l2_uncovered_labels",
    "L2 C18",
    f"""{_WITH}SELECT count(*) FILTER (segment_id IS NULL) AS segment_id, count(*) FILTER (priority_id IS NULL) AS priority_id
FROM (SELECT DISTINCT date, segment_id, priority_id FROM {_JOINS.format(how='LEFT')})""",
)
def l2_uncovered_labels(spark, sf):
    return star.uncovered(_fact(spark, sf, "left"), _dimensions(spark))


@query(
    "e6_sums_per_label",
    "E6",
    f"{_WITH}SELECT segment, count(*) AS count FROM lines GROUP BY 1",
)
def e6_sums_per_label(spark, sf):
    counted = star.group_counts(_lines(spark, sf), ["date", *_LABELS])
    return star.sum_fact(counted, ["segment"])
