"""Queries on observations: quality, selection, reshaping, deltas."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.fixed_values import ELEMENTS, TERRITORY_PREFIXES, UNINCORPORATED_FIRST_PREFIXES
from tallyfold.functions import columns as fx
from tallyfold.operators import delta, joins, latest, quality, report, reshape
from tallyfold.operators.nearest import clear_mapping
from tallyfold.plans import stations
from tallyfold.plans.registry import QUERIES, query
from tallyfold.plans.standins import ELEMENT_OF_TYPE, iso_day, observations, table, with_sql
from tallyfold.plans.weather import cases_with_stored_weather, publish_cases_with_weather, store_weather_by_place
from tallyfold.session import scratch_path, staged
from tallyfold.sources.files import read_csv

OUT = "event_id, station_id, CAST(date AS VARCHAR) AS date, measured, value"
# A pair counts as reporting almost daily from here on; the month of events has 30 days.
MIN_DAYS = 9


def _show(rows):
    return rows.select("event_id", "station_id", iso_day(), "measured", "value")


@query("c5_quality_filter", "C5", with_sql("observations", f"SELECT {OUT} FROM observations WHERE quality_flag IS NULL"))
def c5_quality_filter(spark, sf):
    return _show(quality.passed_quality(observations(spark, sf)))


@query(
    "c6_territory_prefixes",
    "C6 J4",
    with_sql(
        "observations",
        f"SELECT {OUT} FROM observations WHERE left(station_id, 2) IN ('US','CQ','GQ','AQ','RQ','VQ')",
    ),
)
def c6_territory_prefixes(spark, sf):
    return _show(observations(spark, sf).where(fx.has_prefix("station_id", TERRITORY_PREFIXES)))


@query(
    "c7_prefix_list",
    "C7 J4",
    with_sql("observations", f"SELECT {OUT} FROM observations WHERE left(station_id, 2) IN ('RQ','VQ','CQ','AQ','US')"),
)
def c7_prefix_list(spark, sf):
    return _show(observations(spark, sf).where(fx.prefix_in("station_id", UNINCORPORATED_FIRST_PREFIXES)))


@query(
    "c8_element_list",
    "C8",
    with_sql("observations", f"SELECT {OUT} FROM observations WHERE measured IN ('TMIN','PRCP','SNOW','AWND')"),
)
def c8_element_list(spark, sf):
    return _show(observations(spark, sf).where(F.col("measured").isin(ELEMENTS)))


_SELECTED = f"""selected AS (
  SELECT measured, station_id, count(DISTINCT date) AS nb_days FROM observations
  WHERE quality_flag IS NULL AND left(station_id, 2) IN ('US','CQ','GQ','AQ','RQ','VQ')
    AND measured IN ('TMIN','PRCP','SNOW','AWND')
  GROUP BY ALL HAVING count(DISTINCT date) > {MIN_DAYS})"""


def _selected(rows):
    rows = quality.passed_quality(rows).where(
        fx.has_prefix("station_id", TERRITORY_PREFIXES) & F.col("measured").isin(ELEMENTS)
    )
    return quality.significant_pairs(rows, MIN_DAYS)


@query("l5_significant_pairs", "L5 E2 C13", with_sql("observations", "SELECT * FROM selected", _SELECTED))
def l5_significant_pairs(spark, sf):
    return _selected(observations(spark, sf))


@query("l5_folded_batches", "L5 E2", with_sql("observations", "SELECT * FROM selected", _SELECTED))
def l5_folded_batches(spark, sf):
    """The same pairs from stored days, to which batches that overlap are added, one of them twice."""
    rows = staged(quality.passed_quality(observations(spark, sf)), "checked")
    path, day = scratch_path(spark, "reported-days"), F.dayofmonth("date")
    for name, batch in (("a", day <= 12), ("b", day.between(10, 20)), ("c", day > 18), ("b", day <= 20), ("d", day < 25)):
        stations.fold_days(spark, path, rows.where(batch), name)
    kept = stations.significant_stations(spark, path, MIN_DAYS)
    return kept.where(fx.has_prefix("station_id", TERRITORY_PREFIXES) & F.col("measured").isin(ELEMENTS))


@query(
    "e1_reports_per_pair",
    "E1",
    with_sql("observations", "SELECT station_id, measured, count(*) AS count FROM observations GROUP BY ALL"),
)
def e1_reports_per_pair(spark, sf):
    return observations(spark, sf).groupBy("station_id", "measured").agg(F.count(F.lit(1)).alias("count"))


@query(
    "e10_distinct_values",
    "E10 L8",
    with_sql(
        "observations",
        "SELECT count(DISTINCT station_id) AS stations, count(DISTINCT date) AS days, count(DISTINCT measured) AS elements FROM observations",
    ),
)
def e10_distinct_values(spark, sf):
    # One pass over values that were made distinct first: no single task sees a whole column.
    columns = {"station_id": "stations", "date": "days", "measured": "elements"}
    domain = quality.flag_domain(observations(spark, sf), list(columns)).where(F.col("value").isNotNull())
    return domain.agg(*[F.count_if(F.col("flag") == c).alias(name) for c, name in columns.items()])


@query(
    "d16_relevant_rows",
    "D16 K9 C2",
    with_sql(
        "observations",
        f"""SELECT {OUT} FROM observations o WHERE quality_flag IS NULL
  AND EXISTS (SELECT 1 FROM selected s WHERE s.station_id = o.station_id AND s.measured = o.measured)""",
        _SELECTED,
    ),
)
def d16_relevant_rows(spark, sf):
    rows = observations(spark, sf)
    keep = [c for c in rows.columns if c != "quality_flag"]
    return _show(delta.relevant(rows, _selected(rows), keep))


@query(
    "e9_first_value",
    "E9",
    with_sql(
        "observations",
        """SELECT CAST(date AS VARCHAR) AS date, station_id, measured, arg_min(value, event_id) AS value
FROM observations GROUP BY ALL""",
    ),
)
def e9_first_value(spark, sf):
    rows = latest.one_value_per_key(observations(spark, sf), ["date", "station_id", "measured"], "event_id", ["value"])
    return rows.select(iso_day(), "station_id", "measured", "value")


@query(
    "e15_pivot_elements",
    "E15",
    with_sql(
        "observations",
        "SELECT station_id, CAST(date AS VARCHAR) AS date, "
        + ", ".join(f"arg_min(value, event_id) FILTER (measured = '{e}') AS {e}" for e in ("PRCP", "SNOW", "TMIN", "TOBS"))
        + " FROM observations GROUP BY ALL",
    ),
)
def e15_pivot_elements(spark, sf):
    wide = reshape.pivot_elements(
        observations(spark, sf), ["station_id", "date"], "measured", "value", ["PRCP", "SNOW", "TMIN", "TOBS"], "event_id"
    )
    return wide.select("station_id", iso_day(), "PRCP", "SNOW", "TMIN", "TOBS")


@query(
    "d14_rows_per_element",
    "D14 D13",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, count(*) AS cases, element
FROM orders, (VALUES ('TMIN'), ('PRCP'), ('SNOW'), ('AWND')) e(element) GROUP BY ALL""",
)
def d14_rows_per_element(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date"))
    daily = days.agg(F.count(F.lit(1)).alias("cases"))
    return reshape.replicate_per_element(daily, ELEMENTS).select(iso_day(), "cases", "element")


@query(
    "d3_two_key_join",
    "D3 D18",
    with_sql(
        "observations",
        """SELECT o.event_id, o.station_id, o.measured AS element, s.nb_days FROM observations o
JOIN selected s ON s.station_id = o.station_id AND s.measured = o.measured""",
        _SELECTED,
    ),
)
def d3_two_key_join(spark, sf):
    observed = observations(spark, sf)
    mapping = _selected(observed).withColumnRenamed("measured", "element")
    rows = reshape.filtered_observations(observed, mapping)
    return rows.select("event_id", "station_id", "element", "nb_days")


@query(
    "d17_cases_with_weather",
    "D17 D18",
    with_sql(
        "observations",
        """SELECT s.state, CAST(s.date AS VARCHAR) AS date, s.cases, w.element, round(w.value, 4) AS value
FROM (SELECT n_name AS state, CAST(ts AS DATE) AS date, count(*) AS cases
      FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY ALL) s
LEFT JOIN (SELECT n_name AS state, date, measured AS element, avg(value) AS value
           FROM observations JOIN nation ON CAST(right(station_id, 9) AS INT) = n_nationkey
           WHERE quality_flag IS NULL GROUP BY ALL) w ON w.state = s.state AND w.date = s.date""",
    ),
)
def d17_cases_with_weather(spark, sf):
    cases, weather = _cases_and_weather(spark, sf)
    rows = reshape.attach_observations(cases, weather, ["state"])
    return rows.select("state", iso_day(), "cases", "element", F.round("value", 4).alias("value"))


@query(
    "d17_stored_per_element",
    "D17 D18 B4",
    with_sql(
        "observations",
        """SELECT s.state, CAST(s.date AS VARCHAR) AS date, s.cases, e.element, round(w.value, 4) AS value
FROM (SELECT n_name AS state, CAST(ts AS DATE) AS date, count(*) AS cases
      FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL) s
CROSS JOIN (SELECT DISTINCT measured AS element FROM observations WHERE quality_flag IS NULL) e
LEFT JOIN (SELECT n_name AS state, date, measured AS element, avg(value) AS value
           FROM observations JOIN nation ON CAST(right(station_id, 9) AS INT) = n_nationkey
           WHERE quality_flag IS NULL GROUP BY ALL) w ON w.state = s.state AND w.date = s.date AND w.element = e.element""",
    ),
)
def d17_stored_per_element(spark, sf):
    cases, weather = _cases_and_weather(spark, sf)
    path = scratch_path(spark, "cases-with-weather")
    publish_cases_with_weather(cases, weather, ["state"], path)
    schema = schemas.columns("state string, date date, cases bigint, value double, element string")
    rows = read_csv(spark, path, schema)
    return rows.select("state", iso_day(), "cases", "element", F.round("value", 4).alias("value"))


@query("d17_stored_in_buckets", "D17 D18 K7", QUERIES["d17_stored_per_element"].sql)
def d17_stored_in_buckets(spark, sf):
    """The same rows, from observations stored in buckets of the join's key."""
    cases, weather = _cases_and_weather(spark, sf)
    name, path = f"weather_by_place_{uuid.uuid4().hex}", scratch_path(spark, "weather-buckets")
    store_weather_by_place(weather, name, path, ["state"])
    rows = cases_with_stored_weather(spark, cases, name, ["state"])
    return rows.select("state", iso_day(), "cases", "element", F.round("value", 4).alias("value"))


def _cases_and_weather(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    buyers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    cases = (
        table(spark, sf, "events")
        .join(buyers, F.col("user_id") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("state", F.col("ts").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("cases"))
    )
    number = F.substring("station_id", 3, 9).cast("int")
    weather = (
        quality.passed_quality(observations(spark, sf))
        .withColumn("_nation", number)
        .join(nations, F.col("_nation") == F.col("n_nationkey"))
        .groupBy("state", "date", F.col("measured").alias("element"))
        .agg(F.avg("value").alias("value"))
    )
    return cases, weather


@query(
    "l1_duplicate_reports",
    "L1 E8",
    with_sql(
        "observations",
        """SELECT CAST(date AS VARCHAR) AS date, station_id, measured, count(*) AS count
FROM observations GROUP BY ALL HAVING count(*) > 1""",
    ),
)
def l1_duplicate_reports(spark, sf):
    rows = report.duplicates(observations(spark, sf), ["date", "station_id", "measured"])
    return rows.select(iso_day(), "station_id", "measured", "count")


@query(
    "l8_flag_domain",
    "L8",
    with_sql(
        "observations",
        """SELECT 'quality_flag' AS flag, quality_flag AS value, count(*) AS count FROM observations GROUP BY 2
UNION ALL SELECT 'measured', measured, count(*) FROM observations GROUP BY 2""",
    ),
)
def l8_flag_domain(spark, sf):
    return quality.flag_domain(observations(spark, sf), ["quality_flag", "measured"])


@query(
    "l_quality_report",
    "L1 L2 C18 L8",
    with_sql(
        "observations",
        """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys,
       CAST(sum(n) FILTER (n > 1) AS BIGINT) AS rows_in_repeated_keys,
       CAST(sum(f) AS BIGINT) AS failed_quality, CAST(sum(g) AS BIGINT) AS any_missing, CAST(sum(h) AS BIGINT) AS large_value
FROM (SELECT count(*) AS n, count(quality_flag) AS f,
             count(*) FILTER (measured IS NULL OR value IS NULL OR quality_flag IS NULL) AS g,
             count(*) FILTER (value > 200) AS h
      FROM observations GROUP BY date, station_id, measured)""",
    ),
)
def l_quality_report(spark, sf):
    checks = {
        "failed_quality": F.col("quality_flag").isNotNull(),
        "any_missing": fx.any_null(["measured", "value", "quality_flag"]),
        "large_value": F.col("value") > 200,
    }
    return quality.quality_report(observations(spark, sf), ["date", "station_id", "measured"], checks)


@query(
    "c16_null_out_group",
    "C16 C27 G8",
    with_sql(
        "observations",
        """SELECT event_id, station_id, CASE WHEN bad THEN NULL ELSE measured END AS measured,
       CASE WHEN bad THEN NULL ELSE value END AS value
FROM (SELECT *, (measured IN ('SNOW','SNWD') AND left(station_id, 2) IN ('RQ','GQ')) OR value > 100 AS bad FROM observations)""",
    ),
)
def c16_null_out_group(spark, sf):
    bad = (F.col("measured").isin("SNOW", "SNWD") & fx.has_prefix("station_id", ["RQ", "GQ"])) | (F.col("value") > 100)
    rows = observations(spark, sf).select("event_id", "station_id", "measured", "value")
    return clear_mapping(rows, bad, ["measured", "value"])


# Roles in the deltas. Fact: first report of each key before the cut. Insert: first report of each key
# from the cut on. Update: last report of each repeated key. Delete: the reports of one element as
# they stand, which match the fact only where the report was the first of its key.
CUT = "2024-01-24"
_KEY = ["measured", "station_id", "date"]


def _roles(spark, sf):
    rows = observations(spark, sf).withColumn("date", F.date_format("date", "yyyyMMdd"))
    cut = CUT.replace("-", "")
    per_key = rows.groupBy(*_KEY).agg(
        F.min_by("value", "event_id").alias("first"),
        F.max_by("value", "event_id").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    fact = per_key.where(F.col("date") < cut).select(*_KEY, F.col("first").alias("value"))
    insert = per_key.where(F.col("date") >= cut).select(*_KEY, F.col("first").alias("value"))
    update = per_key.where(F.col("n") > 1).select(*_KEY, F.col("last").alias("value"))
    gone = rows.where(F.col("measured") == "TOBS").select(*_KEY, "value")
    return fact, gone, insert, update


_ROLES = [
    "rep AS (SELECT measured, station_id, strftime(date, '%Y%m%d') AS date, value, event_id FROM observations)",
    """keyed AS (SELECT measured, station_id, date, arg_min(value, event_id) AS first, arg_max(value, event_id) AS last,
         count(*) AS n FROM rep GROUP BY ALL)""",
    f"fact AS (SELECT measured, station_id, date, first AS value FROM keyed WHERE date < '{CUT.replace('-', '')}')",
    f"ins AS (SELECT measured, station_id, date, first AS value FROM keyed WHERE date >= '{CUT.replace('-', '')}')",
    "upd AS (SELECT measured, station_id, date, last AS value FROM keyed WHERE n > 1)",
    "gone AS (SELECT measured, station_id, date, value FROM rep WHERE measured = 'TOBS')",
    """kept AS (SELECT * FROM fact f WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.measured = f.measured
         AND g.station_id = f.station_id AND g.date = f.date AND g.value = f.value))""",
]


def _without(rows, other):
    return f"""SELECT * FROM {rows} a WHERE NOT EXISTS (SELECT 1 FROM {other} b WHERE b.measured = a.measured
  AND b.station_id = a.station_id AND b.date = a.date)"""


@query("k6_delete_rows", "K6", with_sql("observations", "SELECT * FROM kept", *_ROLES))
def k6_delete_rows(spark, sf):
    fact, gone, _, _ = _roles(spark, sf)
    return delta.delete_rows(fact, gone)


@query(
    "k7_upsert",
    "K7",
    with_sql("observations", f"SELECT * FROM upd UNION ALL {_without('fact', 'upd')}", *_ROLES),
)
def k7_upsert(spark, sf):
    fact, _, _, update = _roles(spark, sf)
    return delta.upsert(fact, update)


@query(
    "k8_update_wins",
    "K8",
    with_sql(
        "observations",
        f"SELECT * FROM upd UNION ALL {_without('base', 'upd')}",
        *_ROLES,
        f"base AS (SELECT * FROM ins UNION ALL {_without('kept', 'ins')})",
    ),
)
def k8_update_wins(spark, sf):
    return delta.apply_delta(*_roles(spark, sf))


@query(
    "k8_insert_wins",
    "K8",
    with_sql(
        "observations",
        f"SELECT * FROM ins UNION ALL {_without('base', 'ins')}",
        *_ROLES,
        f"base AS (SELECT * FROM upd UNION ALL {_without('kept', 'upd')})",
    ),
)
def k8_insert_wins(spark, sf):
    return delta.apply_delta(*_roles(spark, sf), order=("delete", "update", "insert"))


@query(
    "k7_conflicts_by_order",
    "K7",
    with_sql(
        "observations",
        "SELECT measured, station_id, strftime(date, '%Y%m%d') AS date, arg_max(value, event_id) AS value FROM observations GROUP BY ALL",
    ),
)
def k7_conflicts_by_order(spark, sf):
    rows = observations(spark, sf).withColumn("date", F.date_format("date", "yyyyMMdd"))
    return delta.one_per_key(rows.select(*_KEY, "value", "event_id"), _KEY, order="event_id")


@query(
    "f6_first_element",
    "F6",
    with_sql(
        "observations",
        "SELECT station_id, min(measured) AS measured FROM observations GROUP BY ALL",
    ),
)
def f6_first_element(spark, sf):
    pairs = observations(spark, sf).select("station_id", "measured").distinct()
    return latest.one_row_per_station(pairs)


@query(
    "h3_stack_sources",
    "H3",
    with_sql(
        "observations",
        "SELECT station_id, value, measured AS element FROM observations",
    ),
)
def h3_stack_sources(spark, sf):
    rows = observations(spark, sf)
    frames = {e: rows.where(F.col("measured") == e).select("station_id", "value") for e in ELEMENT_OF_TYPE.values()}
    return reshape.stack_sources(frames)


@query(
    "c9_without_either",
    "C9",
    with_sql(
        "observations",
        f"""SELECT {OUT} FROM observations
WHERE station_id NOT IN (SELECT station_id FROM observations WHERE value > 250 AND measured = 'TOBS')
  AND measured NOT IN (SELECT measured FROM observations WHERE value > 250 AND measured = 'TOBS')""",
    ),
)
def c9_without_either(spark, sf):
    rows = observations(spark, sf)
    listed = rows.where((F.col("value") > 250) & (F.col("measured") == "TOBS"))
    return _show(joins.without_either(rows, listed, ["station_id", "measured"]))


@query(
    "e2_distinct_days",
    "E2",
    with_sql(
        "observations", "SELECT station_id, measured, count(DISTINCT date) AS nb_days FROM observations GROUP BY ALL"
    ),
)
def e2_distinct_days(spark, sf):
    return quality.reporting_days(observations(spark, sf))


@query(
    "c13_thresholds",
    "C13 C27 I1",
    with_sql(
        "observations",
        """SELECT event_id, CASE WHEN value > 100 THEN value END AS far, value > 200 AS farther FROM observations""",
    ),
)
def c13_thresholds(spark, sf):
    value = F.col("value")
    return observations(spark, sf).select(
        "event_id", F.when(value > 100, value).alias("far"), (value > 200).alias("farther")
    )
