"""Queries on coordinates: resolution, distances, nearest stations and their outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.fixed_values import HAWAII_LATITUDE, HAWAII_LONGITUDE
from tallyfold.functions import columns as fx
from tallyfold.functions import geo
from tallyfold.operators import joins, latest, locations, nearest, quality, report
from tallyfold.plans import locations as location_jobs
from tallyfold.plans.registry import query
from tallyfold.plans.standins import sites, stations, table, with_sql
from tallyfold.session import scratch_path, staged

_ANGLE = """atan2(sqrt({a}), sqrt(1 - {a}))"""
_TERM = """least(pow(sin((radians({p}.latitude) - radians({q}.latitude)) / 2), 2)
  + cos(radians({p}.latitude)) * cos(radians({q}.latitude)) * pow(sin(radians({p}.longitude - {q}.longitude) / 2), 2), 1.0)"""
_PAIRS = f"""pairs AS (
  SELECT p.location_id, p.nation AS location_nation, q.measured, q.station_id, q.nation AS station_nation,
         {_TERM.format(p="p", q="q")} AS a
  FROM sites p, stations q)"""
_ANGLES = f"angles AS (SELECT *, {_ANGLE.format(a='a')} AS angle FROM pairs)"
_NEAREST = """nearest AS (
  SELECT * FROM angles WHERE angle * 6371 < 600
  QUALIFY rank() OVER (PARTITION BY location_id, measured ORDER BY round(angle, 12)) = 1)"""
_MAPPED = "location_id, measured, station_id, round(angle, 8) AS angle, round(angle * 6371, 4) AS distance, round(angle * 12742, 4) AS distance_km"


def _mapping(spark, sf, cutoff=600):
    places = sites(spark, sf).select("location_id", "latitude", "longitude")
    ends = stations(spark, sf).select("station_id", "measured", "latitude", "longitude")
    return nearest.nearest_per_element(places, ends, cutoff)


def _rounded(mapping):
    return mapping.select(
        "location_id",
        "measured",
        "station_id",
        F.round("angle", 8).alias("angle"),
        F.round("distance", 4).alias("distance"),
        F.round("distance_km", 4).alias("distance_km"),
    )


@query(
    "g1_nearest_per_element",
    "G1 G2 G3 F10 F12 D13 N6",
    with_sql("sites stations", f"SELECT {_MAPPED} FROM nearest", _PAIRS, _ANGLES, _NEAREST),
)
def g1_nearest_per_element(spark, sf):
    return _rounded(_mapping(spark, sf))


@query(
    "g1_nearest_without_cutoff",
    "G1 H8",
    with_sql(
        "sites stations",
        f"""SELECT {_MAPPED} FROM angles
QUALIFY rank() OVER (PARTITION BY location_id, measured ORDER BY round(angle, 12)) = 1""",
        _PAIRS,
        _ANGLES,
    ),
)
def g1_nearest_without_cutoff(spark, sf):
    return _rounded(_mapping(spark, sf, cutoff=None))


_CENTERS = """centers AS (
  SELECT n_nationkey AS nation, n_regionkey AS region, (n_nationkey * 617 % 17000 - 8500) / 100.0 AS latitude,
         (n_nationkey * 2411 % 36000 - 18000) / 100.0 AS longitude FROM nation)"""


def _centers(spark, sf):
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        key.alias("nation"),
        F.col("n_regionkey").alias("region"),
        F.col("n_name").alias("state"),
        ((key * 617 % 17000 - 8500) / 100.0).alias("latitude"),
        ((key * 2411 % 36000 - 18000) / 100.0).alias("longitude"),
    )


@query(
    "g2_site_distance",
    "G2 G3 G4 J6 N3",
    with_sql(
        "sites",
        f"""SELECT location_id, round(angle, 8) AS angle, round(angle * 6371, 4) AS distance, round(angle * 12742, 4) AS distance_km
FROM (SELECT location_id, {_ANGLE.format(a='a')} AS angle
      FROM (SELECT location_id, {_TERM.format(p="p", q="q")} AS a FROM sites p JOIN centers q ON p.nation = q.nation))""",
        _CENTERS,
    ),
)
def g2_site_distance(spark, sf):
    ends = _centers(spark, sf).select(
        "nation", F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2")
    )
    angle = geo.half_angle("latitude", "longitude", "lat2", "lon2")
    rows = sites(spark, sf).join(ends, "nation").withColumn("angle", angle)
    return rows.select(
        "location_id",
        F.round("angle", 8).alias("angle"),
        F.round(geo.distance_in_cutoff_unit("angle"), 4).alias("distance"),
        F.round(geo.distance_km("angle"), 4).alias("distance_km"),
    )


# Suppliers share the coordinates of their nation's center here.
_SHARED = """shared AS (
  SELECT station_id, measured, c.latitude, c.longitude, CASE WHEN elevation < 0 THEN NULL ELSE elevation END AS elevation
  FROM stations JOIN centers c ON stations.nation = c.nation)"""


def _shared(spark, sf):
    centers = _centers(spark, sf).select("nation", "latitude", "longitude")
    rows = stations(spark, sf).drop("latitude", "longitude").join(centers, "nation")
    known = F.when(F.col("elevation") >= 0, F.col("elevation"))
    return rows.select("station_id", "measured", "latitude", "longitude", known.alias("elevation"))


@query(
    "g5_lowest_colocated",
    "G5 F5",
    with_sql(
        "stations",
        """SELECT * FROM shared
QUALIFY rank() OVER (PARTITION BY latitude, longitude, measured ORDER BY elevation NULLS LAST, station_id) = 1""",
        _CENTERS,
        _SHARED,
    ),
)
def g5_lowest_colocated(spark, sf):
    return latest.lowest_colocated(_shared(spark, sf))


_LOCATIONS = """locs AS (
  SELECT DISTINCT n_name AS state, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Unknown' ELSE c_mktsegment END AS county,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' AND n_regionkey <> 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END AS fips,
         n_regionkey AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
_RESOLVED = """resolved AS (
  SELECT l.state, l.county, l.fips,
    CASE WHEN g.nation IS NOT NULL THEN g.latitude
         WHEN l.county = 'Unknown' AND l.state = 'NATION_20' THEN 18.25
         WHEN l.county = 'Unknown' THEN s.latitude
         WHEN l.county = 'AUTOMOBILE' THEN 40.5 END AS latitude,
    CASE WHEN g.nation IS NOT NULL THEN g.longitude
         WHEN l.county = 'Unknown' AND l.state = 'NATION_20' THEN -66.5
         WHEN l.county = 'Unknown' THEN s.longitude
         WHEN l.county = 'AUTOMOBILE' THEN -74.25 END AS longitude,
    CASE WHEN g.nation IS NOT NULL THEN 'fips' WHEN l.county = 'Unknown' AND l.state = 'NATION_20' THEN 'territory'
         WHEN l.county = 'Unknown' AND s.nation IS NOT NULL THEN 'state'
         WHEN l.county = 'AUTOMOBILE' THEN 'place' END AS resolved_by
  FROM locs l
  LEFT JOIN (SELECT * FROM centers WHERE region <> 4) g ON l.fips = lpad(CAST(g.nation AS VARCHAR), 5, '0')
  LEFT JOIN (SELECT *, 'NATION_' || CAST(nation AS VARCHAR) AS name FROM centers WHERE nation <> 20) s ON l.state = s.name)"""


def _resolved(spark, sf):
    centers = _centers(spark, sf)
    people = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    unknown = F.col("c_mktsegment") == "HOUSEHOLD"
    reported = locations.distinct_locations(
        people.select(
            F.col("n_name").alias("state"),
            F.when(unknown, "Unknown").otherwise(F.col("c_mktsegment")).alias("county"),
            F.when(~unknown & (F.col("n_regionkey") != 0), fx.fips_text("n_nationkey")).alias("fips"),
        )
    )
    gazetteer = centers.where(F.col("region") != 4).select(fx.fips_text("nation").alias("fips"), "latitude", "longitude")
    states = centers.where(F.col("nation") != 20).select("state", "latitude", "longitude")
    territories = spark.createDataFrame([("NATION_20", 18.25, -66.5)], "state string, latitude double, longitude double")
    spots = spark.createDataFrame([("AUTOMOBILE", 40.5, -74.25)], "county string, latitude double, longitude double")
    return locations.resolve_locations(reported, gazetteer, states, territories, spots)


@query(
    "g6_resolve_locations",
    "G6 D1 D11 C15 J14 H6",
    with_sql("sites", "SELECT * FROM resolved", _CENTERS, _LOCATIONS, _RESOLVED),
)
def g6_resolve_locations(spark, sf):
    return _resolved(spark, sf)


@query(
    "c11_with_coordinates",
    "C11",
    with_sql(
        "sites",
        "SELECT state, county, fips, latitude, longitude FROM resolved WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
        _CENTERS,
        _LOCATIONS,
        _RESOLVED,
    ),
)
def c11_with_coordinates(spark, sf):
    return locations.with_coordinates(_resolved(spark, sf)).drop("resolved_by")


@query(
    "c20_surrogate_ids",
    "C20",
    with_sql(
        "sites",
        "SELECT count(*) AS places, count(*) AS ids FROM locs",
        _LOCATIONS,
    ),
)
def c20_surrogate_ids(spark, sf):
    rows = locations.with_location_id(_resolved(spark, sf))
    per_id = rows.groupBy("location_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.sum("n").alias("places"), F.count(F.lit(1)).alias("ids"))


@query(
    "c20_stored_ids",
    "C20",
    with_sql(
        "sites",
        "SELECT state, county, fips, count(*) OVER () AS ids, state < 'NATION_3' AS early FROM locs",
        _LOCATIONS,
    ),
)
def c20_stored_ids(spark, sf):
    """Ids from a stored dictionary that some places enter first, and all of them later, twice."""
    places, path = staged(_resolved(spark, sf).select(*locations.PLACE), "places"), scratch_path(spark, "ids")
    early = F.col("state") < "NATION_3"
    location_jobs.add_location_ids(spark, path, places.where(early), "early")
    first = location_jobs.location_ids(spark, path).read().select("location_id", F.lit(True).alias("early"))
    for _ in range(2):
        location_jobs.add_location_ids(spark, path, places, "all")
    rows = location_jobs.with_stored_id(spark, path, places).join(first, "location_id", "left")
    ids = rows.select("location_id").distinct().agg(F.count(F.lit(1)).alias("ids"))
    return joins.attach_total(rows, ids).select(*locations.PLACE, "ids", F.coalesce("early", F.lit(False)).alias("early"))


_ENRICHED = """enriched AS (
  SELECT n.location_id, n.measured, n.station_id, n.angle * 6371 AS distance,
         'NATION_' || CAST(location_nation AS VARCHAR) AS location_state,
         'NATION_' || CAST(station_nation AS VARCHAR) AS station_state, s.station_name
  FROM nearest n JOIN stations s ON n.station_id = s.station_id)"""
_NEAR = (_PAIRS, _ANGLES, _NEAREST, _ENRICHED)


def _enriched(spark, sf):
    """The published mapping with names: the reports below read it more than once."""
    name = F.concat(F.lit("NATION_"), F.col("nation").cast("string")).alias("state")
    places = sites(spark, sf).select("location_id", F.lit(None).cast("string").alias("fips"), "county", name)
    ends = stations(spark, sf).select("station_id", "station_name", name)
    return staged(nearest.enrich_mapping(_mapping(spark, sf), places, ends), "mapping")


@query(
    "g7_enriched_mapping",
    "G7 C1",
    with_sql(
        "sites stations",
        "SELECT location_id, measured, station_id, station_name, location_state, station_state, round(distance, 4) AS distance FROM enriched",
        *_NEAR,
    ),
)
def g7_enriched_mapping(spark, sf):
    return _enriched(spark, sf).select(
        "location_id", "measured", "station_id", "station_name", "location_state", "station_state",
        F.round("distance", 4).alias("distance"),
    )


@query(
    "g8_far_state_pairs",
    "G8 E12 C13 C21",
    with_sql(
        "sites stations",
        """SELECT location_state, station_state, round(avg(distance), 4) AS mean, round(min(distance), 4) AS min,
       round(max(distance), 4) AS max, count(*) AS len, round(median(distance), 4) AS median
FROM enriched WHERE distance > 100 GROUP BY ALL""",
        *_NEAR,
    ),
)
def g8_far_state_pairs(spark, sf):
    far = _enriched(spark, sf).where(F.col("distance") > 100)
    summary = report.group_summary(far, "distance", ["location_state", "station_state"])
    numbers = [F.round(c, 4).alias(c) for c in ("mean", "min", "max", "median")]
    return summary.select("location_state", "station_state", "len", *numbers)


@query(
    "g8_clear_far_pairs",
    "G8 C16 C21",
    with_sql(
        "sites stations",
        """SELECT location_id, measured, CASE WHEN bad THEN NULL ELSE station_id END AS station_id,
       CASE WHEN bad THEN NULL ELSE round(distance, 4) END AS distance
FROM (SELECT *, (measured, location_state, station_state) IN
        (SELECT (measured, location_state, station_state) FROM enriched WHERE distance > 500) AS bad FROM enriched)""",
        *_NEAR,
    ),
)
def g8_clear_far_pairs(spark, sf):
    rows = _enriched(spark, sf)
    cleared = nearest.clear_state_pairs(rows, rows.where(F.col("distance") > 500), ["station_id", "distance"])
    return cleared.select("location_id", "measured", "station_id", F.round("distance", 4).alias("distance"))


@query(
    "g9_state_mismatches",
    "G9 E11",
    with_sql(
        "sites stations",
        """SELECT measured, location_state, station_state, count(*) AS count FROM enriched
WHERE location_state <> station_state GROUP BY ALL""",
        *_NEAR,
    ),
)
def g9_state_mismatches(spark, sf):
    return nearest.state_mismatches(_enriched(spark, sf))


@query(
    "l4_expected_cardinality",
    "L4",
    with_sql(
        "sites stations",
        """SELECT (SELECT count(*) FROM (SELECT DISTINCT location_id, measured FROM nearest)) AS mapped,
       (SELECT count(*) FROM sites) * (SELECT count(DISTINCT measured) FROM stations) AS expected""",
        _PAIRS,
        _ANGLES,
        _NEAREST,
    ),
)
def l4_expected_cardinality(spark, sf):
    return quality.expected_cardinality(_mapping(spark, sf), sites(spark, sf), stations(spark, sf))


@query(
    "c12_bounding_box",
    "C12",
    with_sql(
        "sites",
        "SELECT location_id, latitude, longitude FROM sites WHERE latitude > 18 AND latitude < 22.5 AND longitude > -160.5 AND longitude < -154",
    ),
)
def c12_bounding_box(spark, sf):
    rows = sites(spark, sf).where(fx.inside_box("latitude", "longitude", HAWAII_LATITUDE, HAWAII_LONGITUDE))
    return rows.select("location_id", "latitude", "longitude")


@query(
    "e20_centroid",
    "E20",
    with_sql(
        "sites",
        "SELECT nation, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude FROM sites GROUP BY 1",
    ),
)
def e20_centroid(spark, sf):
    rows = report.centroid(sites(spark, sf), ["nation"])
    return rows.select("nation", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"))


@query(
    "e22_coordinate_range",
    "E22",
    with_sql(
        "sites",
        """SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude,
       min(longitude) AS min_longitude, max(longitude) AS max_longitude FROM sites""",
    ),
)
def e22_coordinate_range(spark, sf):
    return report.coordinate_range(sites(spark, sf))


@query(
    "e21_stations_per_state",
    "E21",
    with_sql("stations", "SELECT nation, count(*) AS stations FROM stations GROUP BY 1"),
)
def e21_stations_per_state(spark, sf):
    return stations(spark, sf).groupBy("nation").agg(F.count(F.lit(1)).alias("stations"))


@query(
    "d2_state_abbreviation",
    "D2",
    """SELECT n_name, substr(r_name, 1, 2) AS abbreviation FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def d2_state_abbreviation(spark, sf):
    short = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("string").alias("name"), F.substring("r_name", 1, 2).alias("abbreviation")
    )
    states = table(spark, sf, "nation").withColumn("state", F.col("n_regionkey").cast("string"))
    return joins.join_on(states, short, [("state", "name")]).select("n_name", "abbreviation")


@query(
    "e20_centroid_nan",
    "E20 E22",
    with_sql(
        "sites",
        """SELECT nation, round(avg(latitude), 6) AS latitude, round(avg(longitude) FILTER (location_id % 3 <> 0), 6) AS longitude,
       round(min(min(longitude) FILTER (location_id % 3 <> 0)) OVER (), 6) AS least
FROM sites GROUP BY 1""",
    ),
)
def e20_centroid_nan(spark, sf):
    """Every third longitude is NaN."""
    longitude = F.when(F.col("location_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("longitude"))
    rows = sites(spark, sf).withColumn("longitude", longitude)
    ends = report.coordinate_range(rows).select(F.round("min_longitude", 6).alias("least"))
    means = report.centroid(rows, ["nation"])
    return means.crossJoin(F.broadcast(ends)).select(
        "nation", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "least"
    )
