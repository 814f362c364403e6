"""Joins of growing tables with a few literal rows: no task may get all rows of a key."""

import re

import pytest

from tallyfold.plans import queries as _registered  # noqa: F401
from tallyfold.plans.registry import QUERIES


@pytest.fixture()
def tables(spark, tmp_path):
    """Orders and customers of very few keys, one of them null."""
    spark.range(20_000).selectExpr("id AS o_orderkey", "IF(id % 10 = 9, NULL, id % 2) AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(20_000).selectExpr(
        "id AS c_custkey", "element_at(array('BUILDING', 'FURNITURE', NULL, 'X'), int(id % 4) + 1) AS c_mktsegment", "1.5D AS c_acctbal"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def executed(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_rows_stay_where_they_are(spark, tables, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows, plan = executed(QUERIES["a13_literal_dimension"].run(spark, tables))
        assert {r.age_group: r.orders for r in rows} == {"0 - 9 Years": 10_000, "10 - 19 Years": 8_000}
        assert re.findall(r"hashpartitioning\((\w+?)#", plan) == ["age_group"] and "SortMergeJoin" not in plan
        rows, plan = executed(QUERIES["c15_conditional_patch"].run(spark, tables))
        assert sorted({(r.c_custkey % 4, r.latitude) for r in rows}) == [(0, 40.71274), (1, 37.0842), (2, 1.5), (3, 1.5)] and len(rows) == 20_000
        assert "hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
