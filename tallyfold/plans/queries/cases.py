"""Queries on case counts: increments, snapshots, batches, place matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import incremental, joins, latest, timeseries
from tallyfold.operators.timeseries import month_of
from tallyfold.plans.registry import query
from tallyfold.plans.standins import cumulated, iso_day, nation_locations, places, reports, revised, table, with_sql
from tallyfold.session import staged

PLACE = ["state", "county", "fips"]


def _increments(first):
    def run(spark, sf):
        daily = timeseries.daily_increments(
            cumulated(spark, sf), PLACE, ["cases", "deaths"], first=first, block=month_of("date")
        )
        return daily.select(*PLACE, iso_day(), "daily_cases", "daily_deaths")

    return run


_DAILY = """SELECT state, county, fips, CAST(date AS VARCHAR) AS date,
       {cases} AS daily_cases, {deaths} AS daily_deaths
FROM cumulated WINDOW w AS (PARTITION BY state, county, fips ORDER BY date)"""

query(
    "f1_daily_first_zero",
    "F1 C1 C24",
    with_sql(
        "cumulated",
        _DAILY.format(cases="cases - lag(cases, 1, 0) OVER w", deaths="deaths - lag(deaths, 1, 0) OVER w"),
    ),
)(_increments("zero"))

query(
    "f2_daily_first_null",
    "F2 D19",
    with_sql("cumulated", _DAILY.format(cases="cases - lag(cases) OVER w", deaths="deaths - lag(deaths) OVER w")),
)(_increments("null"))

query(
    "f3_daily_first_self",
    "F3 J11",
    with_sql(
        "cumulated",
        _DAILY.format(
            cases="coalesce(cases - lag(cases) OVER w, cases)",
            deaths="coalesce(deaths - lag(deaths) OVER w, deaths)",
        ),
    ),
)(_increments("self"))


@query(
    "f4_territory_series",
    "F4 M5 E6",
    with_sql(
        "cumulated",
        """SELECT territory, CAST(date AS VARCHAR) AS date, cases, deaths,
       cases - lag(cases, 1, 0) OVER w AS daily_cases, deaths - lag(deaths, 1, 0) OVER w AS daily_deaths
FROM (SELECT CASE WHEN fips IS NULL THEN 'uncoded' ELSE 'coded' END AS territory, date,
             CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths
      FROM cumulated GROUP BY ALL)
WINDOW w AS (PARTITION BY territory ORDER BY date)""",
    ),
)
def f4_territory_series(spark, sf):
    territory = F.when(F.col("fips").isNull(), "uncoded").otherwise("coded")
    rows = cumulated(spark, sf).withColumn("territory", territory)
    series = timeseries.territory_series(rows, ["territory"], ["cases", "deaths"])
    return series.select("territory", iso_day(), "cases", "deaths", "daily_cases", "daily_deaths")


def _customer_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), "o_totalprice"
    )


_EXTREME_ORDERS = """SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date
FROM orders JOIN (SELECT o_custkey AS c, {agg} AS d FROM orders GROUP BY 1)
  ON o_custkey = c AND CAST(o_orderdate AS DATE) = d"""


@query("f7_first_per_customer", "F7", _EXTREME_ORDERS.format(agg="min(CAST(o_orderdate AS DATE))"))
def f7_first_per_customer(spark, sf):
    return latest.earliest_rows(_customer_orders(spark, sf), ["o_custkey"]).select("o_custkey", "o_orderkey", iso_day())


@query("f8_latest_by_rank", "F8", _EXTREME_ORDERS.format(agg="max(CAST(o_orderdate AS DATE))"))
def f8_latest_by_rank(spark, sf):
    return latest.latest_rows(_customer_orders(spark, sf), ["o_custkey"]).select("o_custkey", "o_orderkey", iso_day())


@query("f9_latest_by_max", "F9", _EXTREME_ORDERS.format(agg="max(CAST(o_orderdate AS DATE))"))
def f9_latest_by_max(spark, sf):
    rows = latest.rows_at_extreme(_customer_orders(spark, sf), ["o_custkey"], "date")
    return rows.select("o_custkey", "o_orderkey", iso_day())


@query(
    "f10_rows_at_minimum",
    "F10",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
JOIN (SELECT o_custkey AS c, min(o_totalprice) AS p FROM orders GROUP BY 1) ON o_custkey = c AND o_totalprice = p""",
)
def f10_rows_at_minimum(spark, sf):
    rows = latest.rows_at_extreme(_customer_orders(spark, sf), ["o_custkey"], "o_totalprice", largest=False)
    return rows.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "f12_cheapest_order",
    "F12",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1""",
)
def f12_cheapest_order(spark, sf):
    price_then_key = F.struct("o_totalprice", "o_orderkey").alias("first")
    rows = _customer_orders(spark, sf).groupBy("o_custkey").agg(F.min(price_then_key).alias("first"))
    return rows.select("o_custkey", "first.o_orderkey", "first.o_totalprice")


_SAME_PLACE = "{a}.state = {b}.state AND {a}.county = {b}.county AND {a}.fips IS NOT DISTINCT FROM {b}.fips"
_MATCH = _SAME_PLACE.format(a="r", b="p")


@query(
    "d4_match_places",
    "D4",
    with_sql("reports places", f"SELECT r.* FROM reports r JOIN places p ON {_MATCH}"),
)
def d4_match_places(spark, sf):
    return joins.join_null_safe(reports(spark, sf), places(spark, sf), PLACE).drop("location_id")


@query(
    "d5_unmatched_places",
    "D5 L3",
    with_sql("reports places", f"SELECT * FROM reports r WHERE NOT EXISTS (SELECT 1 FROM places p WHERE {_MATCH})"),
)
def d5_unmatched_places(spark, sf):
    return joins.without_known_null_safe(reports(spark, sf), places(spark, sf), PLACE)


@query(
    "d7_attach_location_id",
    "D6 D7 C24",
    with_sql(
        "reports places",
        f"SELECT r.*, p.state IS NOT NULL AS has_id FROM reports r LEFT JOIN places p ON {_MATCH}",
    ),
)
def d7_attach_location_id(spark, sf):
    rows = incremental.attach_location_id(reports(spark, sf), places(spark, sf))
    return rows.withColumn("has_id", F.col("location_id").isNotNull()).drop("location_id")


@query(
    "d8_without_known_code",
    "D8",
    with_sql(
        "reports places",
        """SELECT * FROM reports WHERE NOT EXISTS
  (SELECT 1 FROM places p WHERE p.fips = reports.fips AND p.county = 'BUILDING')""",
    ),
)
def d8_without_known_code(spark, sf):
    known = places(spark, sf).where(F.col("county") == "BUILDING")
    return joins.without_known(reports(spark, sf), known, ["fips"])


@query(
    "d20_code_difference",
    "D20 H5",
    with_sql(
        "reports places",
        "SELECT fips FROM reports WHERE fips IS NOT NULL EXCEPT SELECT fips FROM places WHERE county = 'BUILDING'",
    ),
)
def d20_code_difference(spark, sf):
    left = reports(spark, sf).where(F.col("fips").isNotNull()).select("fips")
    right = places(spark, sf).where(F.col("county") == "BUILDING").select("fips")
    return left.subtract(right)


@query(
    "d12_one_to_one",
    "D12 D1",
    """SELECT c_custkey, c_name, n, total FROM customer
JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
  ON c_custkey = o_custkey""",
)
def d12_one_to_one(spark, sf):
    totals = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    return joins.join_one_to_one(table(spark, sf, "customer").select("c_custkey", "c_name"), totals, ["c_custkey"])


@query(
    "d22_lookup_with_unmatched",
    "D22",
    with_sql(
        "reports places",
        f"""SELECT 'matched' AS part, count(*) AS n FROM reports r WHERE EXISTS (SELECT 1 FROM places p WHERE {_MATCH})
UNION ALL
SELECT 'unmatched', count(*) FROM reports r WHERE NOT EXISTS (SELECT 1 FROM places p WHERE {_MATCH})""",
    ),
)
def d22_lookup_with_unmatched(spark, sf):
    found, missing = joins.split_matched(
        incremental.attach_location_id(reports(spark, sf), places(spark, sf)), "location_id"
    )
    parts = [
        part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        for name, part in (("matched", found), ("unmatched", missing))
    ]
    return parts[0].unionByName(parts[1])


# Days that part the case table into loaded rows and overlapping batches.
LOADED_TO, FIRST_FROM, FIRST_TO, SECOND_FROM = "1997-12-31", "1997-11-01", "1999-06-30", "1999-05-15"


def _between(rows, start=None, end=None):
    if start:
        rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        rows = rows.where(F.col("date") <= F.lit(end).cast("date"))
    return rows


def _stage(spark, sf):
    """The reported counts as a loaded table, which a batch reads more than once."""
    return staged(cumulated(spark, sf), "cumulated")


def _known(rows, locations):
    rows = incremental.attach_location_id(rows, locations)
    return joins.split_matched(rows, "location_id")[0]


def _snapshot(known):
    """The stored snapshot a batch starts from."""
    loaded = _between(known, end=LOADED_TO).select(*incremental.SNAPSHOT_COLUMNS)
    return staged(latest.snapshot(None, loaded), "snapshot")


def _show_snapshot(rows):
    return rows.select(iso_day(), *PLACE, "cases", "deaths")


_KNOWN = "known AS (SELECT * FROM cumulated WHERE state IN (SELECT state FROM nation_locations))"
_SNAP = f"""snap AS (SELECT * FROM known WHERE date <= DATE '{LOADED_TO}'
  QUALIFY rank() OVER (PARTITION BY state ORDER BY date DESC) = 1)"""
_ROW = "CAST(date AS VARCHAR) AS date, state, county, fips, cases, deaths"


@query(
    "k1_snapshot_merge",
    "K1 H4 B7",
    with_sql(
        "cumulated nation_locations",
        f"SELECT {_ROW} FROM known WHERE date <= DATE '{FIRST_TO}' QUALIFY rank() OVER (PARTITION BY state ORDER BY date DESC) = 1",
        _KNOWN,
    ),
)
def k1_snapshot_merge(spark, sf):
    known = _known(_stage(spark, sf), nation_locations(spark, sf))
    recent = _between(known, FIRST_FROM, FIRST_TO).select(*incremental.SNAPSHOT_COLUMNS)
    return _show_snapshot(latest.snapshot(_snapshot(known), recent))


@query(
    "k2_carry_in",
    "K2",
    with_sql(
        "cumulated nation_locations",
        f"""SELECT {_ROW} FROM known WHERE date > DATE '{LOADED_TO}'
UNION ALL
SELECT {_ROW} FROM snap
WHERE date < (SELECT min(date) FROM known k WHERE k.date > DATE '{LOADED_TO}' AND k.state = snap.state)""",
        _KNOWN,
        _SNAP,
    ),
)
def k2_carry_in(spark, sf):
    known = _known(_stage(spark, sf), nation_locations(spark, sf))
    recent = known.where(F.col("date") > F.lit(LOADED_TO).cast("date"))
    return _show_snapshot(incremental.carry_in(recent, _snapshot(known)))


@query(
    "k4_drop_loaded",
    "K4",
    with_sql(
        "cumulated nation_locations",
        f"""SELECT {_ROW} FROM known WHERE date >= DATE '{FIRST_FROM}'
  AND date > (SELECT date FROM snap WHERE snap.state = known.state)""",
        _KNOWN,
        _SNAP,
    ),
)
def k4_drop_loaded(spark, sf):
    known = _known(_stage(spark, sf), nation_locations(spark, sf))
    return _show_snapshot(incremental.drop_loaded(_between(known, FIRST_FROM), _snapshot(known)))


_NEW_DAYS = f"""SELECT state, county, fips, CAST(date AS VARCHAR) AS date, daily_cases, daily_deaths
FROM (SELECT *, cases - lag(cases) OVER w AS daily_cases, deaths - lag(deaths) OVER w AS daily_deaths
      FROM known WINDOW w AS (PARTITION BY state ORDER BY date))
WHERE date > DATE '{LOADED_TO}'"""


def _named(daily, locations):
    return daily.join(locations, "location_id").select(*PLACE, iso_day(), "daily_cases", "daily_deaths")


@query(
    "k3_batch_increments",
    "K3",
    with_sql("cumulated nation_locations", f"{_NEW_DAYS} AND date <= DATE '{FIRST_TO}'", _KNOWN),
)
def k3_batch_increments(spark, sf):
    rows, locations = _stage(spark, sf), nation_locations(spark, sf)
    snapshot = _snapshot(_known(rows, locations))
    return _named(incremental.load_batch(snapshot, _between(rows, FIRST_FROM, FIRST_TO), locations).daily, locations)


@query("k12_two_batches", "K12 B6", with_sql("cumulated nation_locations", _NEW_DAYS, _KNOWN))
def k12_two_batches(spark, sf):
    rows, locations = _stage(spark, sf), nation_locations(spark, sf)
    snapshot = _snapshot(_known(rows, locations))
    one = incremental.load_batch(snapshot, _between(rows, FIRST_FROM, FIRST_TO), locations)
    two = incremental.load_batch(staged(one.snapshot, "snapshot"), _between(rows, SECOND_FROM), locations)
    return _named(one.daily.unionByName(two.daily), locations)


@query(
    "k12_final_snapshot",
    "K12 K1",
    with_sql(
        "cumulated nation_locations",
        f"SELECT {_ROW} FROM known QUALIFY rank() OVER (PARTITION BY state ORDER BY date DESC) = 1",
        _KNOWN,
    ),
)
def k12_final_snapshot(spark, sf):
    rows, locations = _stage(spark, sf), nation_locations(spark, sf)
    snapshot = _snapshot(_known(rows, locations))
    return _show_snapshot(incremental.load_batch(snapshot, _between(rows, FIRST_FROM), locations).snapshot)


@query(
    "k10_last_loaded",
    "K10 E7",
    with_sql("cumulated", f"SELECT CAST(max(date) AS VARCHAR) AS last FROM cumulated WHERE date <= DATE '{LOADED_TO}'"),
)
def k10_last_loaded(spark, sf):
    loaded = _between(cumulated(spark, sf), end=LOADED_TO)
    return timeseries.last_loaded(loaded).select(F.col("last").cast("string").alias("last"))


@query(
    "c19_newer_than_loaded",
    "C19",
    with_sql(
        "cumulated",
        f"""SELECT {_ROW} FROM cumulated
WHERE date > (SELECT max(date) FROM cumulated WHERE date <= DATE '{LOADED_TO}')""",
    ),
)
def c19_newer_than_loaded(spark, sf):
    rows = cumulated(spark, sf)
    last = timeseries.last_loaded(_between(rows, end=LOADED_TO))
    return _show_snapshot(timeseries.newer_than(rows, last))


@query(
    "c22_date_slice",
    "C22 J7",
    with_sql(
        "cumulated", f"SELECT {_ROW} FROM cumulated WHERE date BETWEEN DATE '1998-12-01' AND DATE '1998-12-31'"
    ),
)
def c22_date_slice(spark, sf):
    return _show_snapshot(timeseries.date_slice(cumulated(spark, sf), "1998-12-01", "1998-12-31"))


@query(
    "c23_one_day",
    "C23 E23",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders
WHERE CAST(o_orderdate AS DATE) = DATE '1997-07-10' GROUP BY ALL HAVING o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def c23_one_day(spark, sf):
    rows = timeseries.date_slice(_orders_by_day(spark, sf), "1997-07-10", "1997-07-10")
    counts = rows.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("count"))
    return counts.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


def _orders_by_day(spark, sf):
    return table(spark, sf, "orders").withColumn("date", F.col("o_orderdate").cast("date"))


@query(
    "j9_calendar_gaps",
    "J9",
    """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""",
)
def j9_calendar_gaps(spark, sf):
    rows = _orders_by_day(spark, sf)
    urgent = rows.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    return joins.without_known(timeseries.calendar(rows), urgent, ["date"]).select(iso_day())


@query(
    "l6_negative_increments",
    "L6 D21",
    with_sql(
        "revised",
        """SELECT state, CAST(date AS VARCHAR) AS date, daily_cases
FROM (SELECT *, cases - lag(cases, 1, 0) OVER (PARTITION BY state ORDER BY date) AS daily_cases FROM revised)
WHERE daily_cases < 0""",
    ),
)
def l6_negative_increments(spark, sf):
    daily = timeseries.daily_increments(revised(spark, sf), ["state"], ["cases"])
    return timeseries.negative_increments(daily, "daily_cases").select("state", iso_day(), "daily_cases")


@query(
    "d21_series_of_anomalies",
    "D21 H6",
    with_sql(
        "revised",
        """SELECT state, CAST(date AS VARCHAR) AS date, cases FROM revised
WHERE state IN (SELECT state FROM (SELECT state, cases - lag(cases, 1, 0) OVER (PARTITION BY state ORDER BY date) AS d FROM revised)
                WHERE d < -2)""",
    ),
)
def d21_series_of_anomalies(spark, sf):
    rows = revised(spark, sf)
    daily = timeseries.daily_increments(rows, ["state"], ["cases"])
    anomalies = timeseries.negative_increments(daily, "daily_cases", -2)
    return joins.keep_known(rows, anomalies, ["state"]).select("state", iso_day(), "cases")


@query(
    "l7_weekday_profile",
    "L7 J8",
    with_sql(
        "revised",
        """SELECT isodow(date) - 1 AS dayofweek, CAST(sum(daily_cases) AS BIGINT) AS daily_cases
FROM (SELECT *, cases - lag(cases, 1, 0) OVER (PARTITION BY state ORDER BY date) AS daily_cases FROM revised) GROUP BY 1""",
    ),
)
def l7_weekday_profile(spark, sf):
    daily = timeseries.daily_increments(revised(spark, sf), ["state"], ["cases"])
    profile = timeseries.weekday_profile(daily, ["daily_cases"])
    return profile.select(F.col("dayofweek").cast("bigint").alias("dayofweek"), "daily_cases")
