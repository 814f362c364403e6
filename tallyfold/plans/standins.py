"""The job inputs, derived from the test tables.

Each frame has an SQL twin of the same name in ``SQL``, so that a query and its check start from the
same rows. Everything is computed from whole tables.

observations  events: user = station, type = element, day, value; a low ``k`` marks a failed check
cumulated     orders per (nation, day), counted up; region 0 has no county code, region 4 no deaths
reports       orders per (nation, segment) with the same code rule, as places that report
places        customers' (nation, segment) pairs, without one segment of one region
sites         customers with coordinates computed from their key
stations      suppliers with coordinates computed from their key; the nation is the element
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.operators.locations import with_location_id

CODES = ["US", "CQ", "GQ", "AQ", "RQ", "VQ", "CA"]
ELEMENT_OF_TYPE = {"click": "TMIN", "view": "PRCP", "purchase": "SNOW", "signup": "AWND", "error": "TOBS"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def iso_day() -> Column:
    """The date column as text."""
    return F.col("date").cast("string").alias("date")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    code = F.get(F.array(*[F.lit(c) for c in CODES]), (F.col("user_id") % len(CODES)).cast("int"))
    return events.select(
        "event_id",
        F.concat(code, F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("station_id"),
        F.col("ts").cast("date").alias("date"),
        _element(F.col("event_type")).alias("measured"),
        "value",
        F.when(k < 10, "X").alias("quality_flag"),
    )


def _element(kind: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, element in ELEMENT_OF_TYPE.items():
        out = F.when(kind == name, element).otherwise(out)
    return out


def _code(region: Column, nation: Column) -> Column:
    return F.when(region != 0, F.lpad(nation.cast("string"), 5, "0"))


def _placed_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf, "nation")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("n_name").alias("state"),
            F.col("c_mktsegment").alias("segment"),
            _code(F.col("n_regionkey"), F.col("n_nationkey")).alias("fips"),
            F.col("n_regionkey").alias("region"),
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
        )
    )


def cumulated(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (nation, day): at most the days of the calendar per nation."""
    days = _placed_orders(spark, sf).groupBy("state", "fips", "region", "date").agg(
        F.count(F.lit(1)).alias("_cases"), F.count_if(F.col("o_orderstatus") == "F").alias("_deaths")
    )
    upto = Window.partitionBy("state", "fips", "region").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.select(
        "date",
        F.concat(F.lit("County "), F.col("state")).alias("county"),
        "state",
        "fips",
        F.sum("_cases").over(upto).cast("int").alias("cases"),
        F.when(F.col("region") != 4, F.sum("_deaths").over(upto)).cast("int").alias("deaths"),
    )


def revised(spark: SparkSession, sf: str) -> DataFrame:
    """Like ``cumulated``, with open orders taken back, so that totals also fall."""
    days = _placed_orders(spark, sf).groupBy("state", "date").agg(
        F.sum(F.when(F.col("o_orderstatus") == "P", -1).otherwise(1)).alias("_cases")
    )
    upto = Window.partitionBy("state").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("date", "state", F.sum("_cases").over(upto).alias("cases"))


def nation_locations(spark: SparkSession, sf: str) -> DataFrame:
    """The places of ``cumulated`` with ids; one nation is not listed."""
    nations = table(spark, sf, "nation").where(F.col("n_nationkey") != 24)
    rows = nations.select(
        F.col("n_name").alias("state"),
        F.concat(F.lit("County "), F.col("n_name")).alias("county"),
        _code(F.col("n_regionkey"), F.col("n_nationkey")).alias("fips"),
    )
    return with_location_id(rows)


def reports(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _placed_orders(spark, sf)
        .groupBy("state", F.col("segment").alias("county"), "fips")
        .agg(
            F.count(F.lit(1)).alias("cases"),
            F.count_if(F.col("o_orderstatus") == "F").alias("deaths"),
        )
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    listed = customers.where(~((F.col("c_mktsegment") == "BUILDING") & F.col("n_regionkey").isin(0, 1)))
    rows = listed.select(
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("county"),
        _code(F.col("n_regionkey"), F.col("n_nationkey")).alias("fips"),
    ).distinct()
    return with_location_id(rows)


def _latitude(key: Column, factor: int) -> Column:
    return ((key * factor) % 17000 - 8500) / 100.0


def _longitude(key: Column, factor: int) -> Column:
    return ((key * factor) % 36000 - 18000) / 100.0


def sites(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("location_id"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("county"),
        _latitude(key, 7919).alias("latitude"),
        _longitude(key, 104729).alias("longitude"),
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    region = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return (
        table(spark, sf, "supplier")
        .join(region, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("USC"), F.lpad(key.cast("string"), 8, "0")).alias("station_id"),
            F.concat(F.lit("E"), F.col("n_regionkey").cast("string")).alias("measured"),
            F.col("s_nationkey").alias("nation"),
            _latitude(key, 6101).alias("latitude"),
            _longitude(key, 91193).alias("longitude"),
            F.col("s_acctbal").alias("elevation"),
            F.col("s_name").alias("station_name"),
        )
    )


_CODE = "CASE WHEN n_regionkey <> 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END"

SQL = {
    "observations": """observations AS (
  SELECT event_id,
         (['US','CQ','GQ','AQ','RQ','VQ','CA'])[CAST(user_id % 7 AS INT) + 1]
           || lpad(CAST(user_id AS VARCHAR), 9, '0') AS station_id,
         CAST(ts AS DATE) AS date,
         CASE event_type WHEN 'click' THEN 'TMIN' WHEN 'view' THEN 'PRCP' WHEN 'purchase' THEN 'SNOW'
                         WHEN 'signup' THEN 'AWND' WHEN 'error' THEN 'TOBS' END AS measured,
         value,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 10 THEN 'X' END AS quality_flag
  FROM events)""",
    "placed": f"""placed AS (
  SELECT CAST(o_orderdate AS DATE) AS date, n_name AS state, c_mktsegment AS segment, {_CODE} AS fips,
         n_regionkey AS region, o_orderkey, o_custkey, o_orderstatus, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "cumulated": """cumulated AS (
  SELECT date, 'County ' || state AS county, state, fips,
         CAST(sum(n) OVER w AS INT) AS cases,
         CASE WHEN region <> 4 THEN CAST(sum(f) OVER w AS INT) END AS deaths
  FROM (SELECT state, fips, region, date, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f
        FROM placed GROUP BY ALL)
  WINDOW w AS (PARTITION BY state, fips, region ORDER BY date ROWS UNBOUNDED PRECEDING))""",
    "revised": """revised AS (
  SELECT date, state, CAST(sum(n) OVER (PARTITION BY state ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cases
  FROM (SELECT state, date, sum(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END) AS n FROM placed GROUP BY ALL))""",
    "nation_locations": f"""nation_locations AS (
  SELECT n_name AS state, 'County ' || n_name AS county, {_CODE} AS fips, n_nationkey AS place_key
  FROM nation WHERE n_nationkey <> 24)""",
    "reports": """reports AS (
  SELECT state, segment AS county, fips, count(*) AS cases, count(*) FILTER (o_orderstatus = 'F') AS deaths
  FROM placed GROUP BY ALL)""",
    "places": f"""places AS (
  SELECT DISTINCT n_name AS state, c_mktsegment AS county, {_CODE} AS fips
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE NOT (c_mktsegment = 'BUILDING' AND n_regionkey IN (0, 1)))""",
    "sites": """sites AS (
  SELECT c_custkey AS location_id, c_nationkey AS nation, c_mktsegment AS county,
         ((c_custkey * 7919) % 17000 - 8500) / 100.0 AS latitude,
         ((c_custkey * 104729) % 36000 - 18000) / 100.0 AS longitude
  FROM customer)""",
    "stations": """stations AS (
  SELECT 'USC' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS station_id,
         'E' || CAST(n_regionkey AS VARCHAR) AS measured, s_nationkey AS nation,
         ((s_suppkey * 6101) % 17000 - 8500) / 100.0 AS latitude,
         ((s_suppkey * 91193) % 36000 - 18000) / 100.0 AS longitude,
         s_acctbal AS elevation, s_name AS station_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
}

NEEDS = {"cumulated": ["placed"], "revised": ["placed"], "reports": ["placed"]}


def with_sql(names: str, select: str, *more: str) -> str:
    """``WITH`` the named twins (and further CTE texts) before a select."""
    wanted: list[str] = []
    for name in names.split():
        wanted += [n for n in [*NEEDS.get(name, []), name] if n not in wanted]
    return "WITH " + ",\n".join([SQL[n] for n in wanted] + list(more)) + "\n" + select
