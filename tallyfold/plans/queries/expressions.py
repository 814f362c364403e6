"""Projections, joins and scalar functions one by one, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.fixed_values import AGE_GROUPS
from tallyfold.functions import columns as fx
from tallyfold.operators import joins, report, star, timeseries
from tallyfold.operators.latest import earliest_rows
from tallyfold.plans.registry import query
from tallyfold.plans.standins import cumulated, iso_day, observations, places, reports, table, with_sql
from tallyfold.session import scratch_path
from tallyfold.sinks import files as sinks
from tallyfold.sources import files


@query("c1_project_rename", "C1", "SELECT s_suppkey AS station, s_name AS station_name FROM supplier")
def c1_project_rename(spark, sf):
    rows = table(spark, sf, "supplier").withColumnRenamed("s_name", "station_name")
    return rows.select(F.col("s_suppkey").alias("station"), "station_name")


@query("c2_projection_by_list", "C2", "SELECT * EXCLUDE (o_orderdate) FROM orders")
def c2_projection_by_list(spark, sf):
    rows = table(spark, sf, "orders")
    return rows.select(*[c for c in rows.columns if c != "o_orderdate"])


@query(
    "c4_casts",
    "C4",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT) AS quantity,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, CAST(l_linenumber AS DOUBLE) AS number FROM lineitem""",
)
def c4_casts(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").try_cast("int").alias("quantity"),
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
        F.col("l_linenumber").cast("double").alias("number"),
    )


@query(
    "c10_compound_filter",
    "C10",
    with_sql(
        "cumulated",
        """SELECT CAST(date AS VARCHAR) AS date, state, cases FROM cumulated
WHERE deaths IS NULL AND state = 'NATION_4' OR cases = 1""",
    ),
)
def c10_compound_filter(spark, sf):
    silent = F.col("deaths").isNull() & (F.col("state") == "NATION_4")
    return cumulated(spark, sf).where(silent | (F.col("cases") == 1)).select(iso_day(), "state", "cases")


@query(
    "c15_conditional_patch",
    "C15",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 40.71274 WHEN c_mktsegment = 'FURNITURE' THEN 37.0842
       ELSE c_acctbal END AS latitude FROM customer""",
)
def c15_conditional_patch(spark, sf):
    """Listed coordinates replace the row's own."""
    listed = spark.createDataFrame([("BUILDING", 40.71274), ("FURNITURE", 37.0842)], "county string, patched double")
    rows = joins.join_on(table(spark, sf, "customer"), F.broadcast(listed), [("c_mktsegment", "county")], "left")
    return rows.select("c_custkey", F.coalesce("patched", "c_acctbal").alias("latitude"))


@query(
    "c17_case_flag",
    "C17",
    with_sql("reports", "SELECT *, CASE WHEN fips IS NULL THEN 0 ELSE 1 END AS fips_exist FROM reports"),
)
def c17_case_flag(spark, sf):
    return reports(spark, sf).withColumn("fips_exist", F.when(F.col("fips").isNull(), 0).otherwise(1))


@query(
    "c21_pair_column",
    "C21 C24",
    """SELECT c_nationkey, c_mktsegment, count(*) AS count FROM customer GROUP BY ALL""",
)
def c21_pair_column(spark, sf):
    rows = table(spark, sf, "customer").withColumn("pair", F.struct("c_nationkey", "c_mktsegment"))
    counted = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    return counted.select("pair.*", "count")


@query(
    "c24_add_and_drop",
    "C24",
    with_sql("reports", "SELECT state, county, fips, cases, deaths, cases - deaths AS other FROM reports"),
)
def c24_add_and_drop(spark, sf):
    rows = reports(spark, sf).withColumn("last", F.current_date()).withColumn("other", F.col("cases") - F.col("deaths"))
    return rows.drop("last")


@query(
    "c26_chained_steps",
    "C26",
    with_sql(
        "cumulated",
        """SELECT state, CAST(date AS VARCHAR) AS date, cases FROM first_day WHERE cases > 1""",
        "first_day AS (SELECT * FROM cumulated QUALIFY rank() OVER (PARTITION BY state ORDER BY date) = 1)",
    ),
)
def c26_chained_steps(spark, sf):
    first_day = earliest_rows(cumulated(spark, sf), ["state"])
    return first_day.where(F.col("cases") > 1).select("state", iso_day(), "cases")


@query(
    "c27_mask",
    "C27",
    "SELECT s_suppkey, CASE WHEN s_acctbal > 100 THEN s_acctbal END AS distance FROM supplier",
)
def c27_mask(spark, sf):
    far = F.when(F.col("s_acctbal") > 100, F.col("s_acctbal"))
    return table(spark, sf, "supplier").select("s_suppkey", far.alias("distance"))


@query(
    "d1_inner_join",
    "D1",
    with_sql("reports places", "SELECT r.* FROM reports r JOIN (SELECT DISTINCT fips FROM places) p ON r.fips = p.fips"),
)
def d1_inner_join(spark, sf):
    codes = places(spark, sf).select("fips").distinct()
    return joins.join_on(reports(spark, sf), codes, ["fips"])


@query(
    "d6_left_or_both_null",
    "D6",
    with_sql(
        "reports places",
        """SELECT r.*, p.state IS NOT NULL AS known FROM reports r LEFT JOIN places p
ON r.county = p.county AND r.state = p.state AND (r.fips = p.fips OR (r.fips IS NULL AND p.fips IS NULL))""",
    ),
)
def d6_left_or_both_null(spark, sf):
    listed = places(spark, sf).select("state", "county", "fips", F.lit(True).alias("known"))
    rows = joins.join_null_safe(reports(spark, sf), listed, ["state", "county", "fips"], "left")
    return rows.withColumn("known", F.coalesce("known", F.lit(False)))


@query(
    "d11_left_lookup",
    "D11",
    "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2",
)
def d11_left_lookup(spark, sf):
    lookup = table(spark, sf, "nation").where(F.col("n_regionkey") != 2).select("n_nationkey", "n_name")
    rows = joins.join_on(table(spark, sf, "customer"), lookup, [("c_nationkey", "n_nationkey")], "left")
    return rows.select("c_custkey", "n_name")


@query(
    "d15_ratio_to_total",
    "D15 J13 E19",
    with_sql(
        "reports",
        """SELECT state, county, fips, cases, deaths, round(cases / CAST((SELECT sum(cases) FROM reports) AS DOUBLE), 8) AS ratio_cases,
       round(deaths / CAST((SELECT sum(deaths) FROM reports) AS DOUBLE), 8) AS ratio_deaths FROM reports""",
    ),
)
def d15_ratio_to_total(spark, sf):
    rows = report.with_shares(reports(spark, sf), ["cases", "deaths"])
    ratios = [F.round(c, 8).alias(c) for c in ("ratio_cases", "ratio_deaths")]
    return rows.select("state", "county", "fips", "cases", "deaths", *ratios)


@query(
    "d19_update_by_key",
    "D19",
    with_sql(
        "cumulated",
        """SELECT c.state, CAST(c.date AS VARCHAR) AS date, c.cases - p.previous AS daily_cases FROM cumulated c
JOIN (SELECT state, date, lag(cases) OVER (PARTITION BY state ORDER BY date) AS previous FROM cumulated) p
  ON c.state = p.state AND c.date = p.date""",
    ),
)
def d19_update_by_key(spark, sf):
    daily = timeseries.daily_increments(
        cumulated(spark, sf), ["state"], ["cases"], first="null", block=timeseries.month_of("date")
    )
    return daily.select("state", iso_day(), "daily_cases")


@query(
    "a13_literal_dimension",
    "A13",
    """SELECT age_group, count(*) AS orders FROM orders JOIN (VALUES (0, '0 - 9 Years'), (10, '10 - 19 Years'),
  (20, '20 - 29 Years'), (30, '30 - 39 Years'), (40, '40 - 49 Years'), (50, '50 - 59 Years'), (60, '60 - 69 Years'),
  (70, '70 - 79 Years'), (80, '80+ Years'), (1000, 'Missing'), (2000, 'NA')) d(id, age_group)
ON o_custkey % 9 * 10 = id GROUP BY 1""",
)
def a13_literal_dimension(spark, sf):
    ages = spark.createDataFrame(AGE_GROUPS, schemas.AGE_DIMENSION)
    rows = table(spark, sf, "orders").select((F.col("o_custkey") % 9 * 10).cast("int").alias("age_group_id"))
    return joins.join_on(rows, F.broadcast(ages), ["age_group_id"]).groupBy("age_group").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "b8_json_output",
    "B8 A4",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL",
)
def b8_json_output(spark, sf):
    path = scratch_path(spark, "json")
    sinks.write_json(star.group_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]), path)
    schema = schemas.columns("o_orderstatus string, o_orderpriority string, count bigint")
    return files.read_json_lines(spark, path, schema)


@query("b9_empty_like", "B9", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def b9_empty_like(spark, sf):
    rows = table(spark, sf, "nation")
    return files.empty_like(spark, rows).unionByName(rows)


@query(
    "e23_selected_groups",
    "E23",
    "SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL HAVING o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('2-HIGH', '5-LOW')",
)
def e23_selected_groups(spark, sf):
    sums = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.where(F.col("o_orderstatus").isin("F", "O") & F.col("o_orderpriority").isin("2-HIGH", "5-LOW"))


@query("j1_substring", "J1 N1", "SELECT s_suppkey, substr(s_name, 1, 8) AS head, substr(s_name, 10) AS tail FROM supplier")
def j1_substring(spark, sf):
    name = F.col("s_name")
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.substring(name, 1, 8).alias("head"), F.substring(name, 10, 1 << 30).alias("tail")
    )


@query(
    "j2_split_and_join",
    "J2",
    """SELECT doc_id, len(w) AS words, array_to_string(w, ' ') AS joined
FROM (SELECT doc_id, regexp_split_to_array(trim(text, ' '), ' +') AS w FROM documents)""",
)
def j2_split_and_join(spark, sf):
    words = F.split(F.btrim("text", F.lit(" ")), " +")
    return table(spark, sf, "documents").select(
        "doc_id", F.size(words).cast("bigint").alias("words"), F.array_join(words, " ").alias("joined")
    )


@query(
    "n4_before_comma",
    "N4 J2",
    """SELECT c_mktsegment AS race, count(*) AS count FROM customer GROUP BY 1""",
)
def n4_before_comma(spark, sf):
    label = F.concat("c_mktsegment", F.lit(", "), F.col("c_nationkey").cast("string"))
    rows = table(spark, sf, "customer").select(fx.before_comma(label).alias("race"))
    return star.group_counts(rows, ["race"])


@query(
    "j4_prefix_and_slice",
    "J4",
    "SELECT p_partkey, starts_with(p_brand, 'Brand#1') AS has_prefix, substr(p_brand, 1, 7) IN ('Brand#2', 'Brand#3') AS in_list FROM part",
)
def j4_prefix_and_slice(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        fx.has_prefix("p_brand", ["Brand#1"]).alias("has_prefix"),
        fx.prefix_in("p_brand", ["Brand#2", "Brand#3"], width=7).alias("in_list"),
    )


@query(
    "j6_trigonometry",
    "J6 G4 N3",
    """SELECT c_custkey, round(sin(radians(a)), 8) AS sine, round(cos(radians(a)), 8) AS cosine,
       round(atan2(sqrt(abs(a)), 1.0 + abs(a)), 8) AS angle, round(pow(a / 100, 2), 8) AS square
FROM (SELECT c_custkey, c_custkey % 180 - 90 AS a FROM customer)""",
)
def j6_trigonometry(spark, sf):
    a = (F.col("c_custkey") % 180 - 90).cast("double")
    parts = {
        "sine": F.sin(F.radians(a)),
        "cosine": F.cos(F.radians(a)),
        "angle": F.atan2(F.sqrt(F.abs(a)), 1.0 + F.abs(a)),
        "square": F.pow(a / 100, 2),
    }
    return table(spark, sf, "customer").select("c_custkey", *[F.round(e, 8).alias(n) for n, e in parts.items()])


@query(
    "j7_date_formats",
    "J7",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders""",
)
def j7_date_formats(spark, sf):
    """Through the compact text and back."""
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    rows = table(spark, sf, "orders").select("o_orderkey", compact.alias("compact"))
    return rows.select("o_orderkey", "compact", fx.parse_date("compact").cast("string").alias("iso"))


@query(
    "j8_weekday",
    "J8",
    "SELECT isodow(o_orderdate) - 1 AS dayofweek, count(*) AS orders FROM orders GROUP BY 1",
)
def j8_weekday(spark, sf):
    day = F.weekday("o_orderdate").cast("bigint").alias("dayofweek")
    return table(spark, sf, "orders").groupBy(day).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "j11_coalesce_and_null_order",
    "J11",
    with_sql(
        "observations",
        "SELECT coalesce(quality_flag, '') AS flag, count(*) AS count FROM observations GROUP BY 1",
    ),
)
def j11_coalesce_and_null_order(spark, sf):
    flags = observations(spark, sf).groupBy("quality_flag").agg(F.count(F.lit(1)).alias("count"))
    ordered = flags.orderBy(F.asc_nulls_first("quality_flag"))
    return ordered.select(F.coalesce("quality_flag", F.lit("")).alias("flag"), "count")


@query(
    "j12_scientific",
    "J12 N5",
    # Ties round away from zero, as for exact numerics; DuckDB's own '{:.2e}' rounds them to even. Hence by
    # digits: three of them, from the price in cents.
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(m // 100 AS VARCHAR) || '.' || lpad(CAST(m % 100 AS VARCHAR), 2, '0') || 'e+' || lpad(CAST(e AS VARCHAR), 2, '0') AS price
FROM (SELECT *, CASE WHEN d = 1000 THEN 100 ELSE d END AS m, n - 3 + CASE WHEN d = 1000 THEN 1 ELSE 0 END AS e
      FROM (SELECT *, (cents + 5 * CAST(pow(10, n - 4) AS BIGINT)) // CAST(pow(10, n - 3) AS BIGINT) AS d
            FROM (SELECT *, length(CAST(cents AS VARCHAR)) AS n
                  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem))))""",
)
def j12_scientific(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fx.scientific("l_extendedprice").alias("price")
    )


@query(
    "j13_ratio",
    "J13",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / nullif(l_discount, 0), 4) AS ratio FROM lineitem",
)
def j13_ratio(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(fx.ratio("l_extendedprice", "l_discount"), 4).alias("ratio")
    )


@query(
    "j14_county_code",
    "J14",
    "SELECT n_nationkey, lpad(CAST(n_nationkey * 1001 AS VARCHAR), 5, '0') AS fips FROM nation",
)
def j14_county_code(spark, sf):
    """The same code from a number and from text."""
    number = F.col("n_nationkey") * 1001
    rows = table(spark, sf, "nation").select("n_nationkey", number.alias("a"), number.cast("string").alias("b"))
    same = rows.where(fx.fips_text("a") == fx.fips_text("b"))
    return same.select("n_nationkey", fx.fips_text("a").alias("fips"))
