"""Nearest station of every location, for each measured element.

Points are unit vectors, so order by chord is order by angle and neither the antimeridian nor the
poles need care. Station coordinates are summed up as boxes on nested cubes; a cube is cut further
only while it holds more than a few coordinates, so dense places get small cubes and empty ones none.
Locations close to one another go down together, as a cell on the same cubes: a cell starts from the
boxes around it at the coarsest level, and a box stays only while it may hold something closer to one
of its locations than the best box surely does to all. Boxes are not cut smaller than the cell; from
there each location goes on alone, with what its cell has left. Dense clusters of stations, far or near,
are thus never compared station by station, and the answer equals that of all pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.fixed_values import EARTH_RADIUS_KM, MAX_DISTANCE
from tallyfold.functions.columns import both_present
from tallyfold.functions.geo import distance_in_cutoff_unit, distance_km, half_angle
from tallyfold.operators.latest import leading_rows
from tallyfold.session import staged

_AXES = ("x", "y", "z")
_FAN = 4  # edge ratio of two levels: a power of two, so that cubes nest exactly
_SLACK = 1e-11  # on squared chords, above rounding and above the tie tolerance
_EXACT_BITS = 52  # a cube number up to this size is exact in a double
TIE_DIGITS = 12  # half angles equal to this many digits are ties
LEAF = 16  # coordinates that a cube may hold without being cut
CELL = 32  # locations that go down together

# The expressions below are SQL text: one call each, where columns would take dozens.


def _vectors(df: DataFrame, edge: float) -> DataFrame:
    """Add the unit vector x, y, z and the same in units of the coarsest cube's edge."""
    vector = df.selectExpr(
        "*",
        "cos(radians(latitude)) * cos(radians(longitude)) AS x",
        "cos(radians(latitude)) * sin(radians(longitude)) AS y",
        "sin(radians(latitude)) AS z",
    )
    finite = vector.where("NOT isnan(x + y + z)")  # no station is near an infinite coordinate
    return finite.selectExpr("*", *[f"{a} / {edge!r}D AS q{a}" for a in _AXES])


def _cube(level: str) -> str:
    """Number of the cube at a level (an expression), one part per axis."""
    parts = ", ".join(f"'{a}', bigint(floor(q{a} * pow({_FAN}D, {level})))" for a in _AXES)
    return f"named_struct({parts})"


def _nested(coordinates: DataFrame, deepest: int) -> DataFrame:
    """Every coordinate once per level, with its cube and the cube above."""
    each = coordinates.selectExpr("*", f"explode(sequence(0, {deepest})) AS level")
    return each.selectExpr("*", f"{_cube('level')} AS cube", f"{_cube('greatest(level - 1, 0)')} AS parent")


def _boxes(nested: DataFrame) -> DataFrame:
    """Bounding box and number of the coordinates in every cube."""
    bounds = [F.expr(f"{side[:3]}({a}) AS {side}_{a}") for a in _AXES for side in ("min", "max")]
    return nested.groupBy("measured", "level", "parent", "cube").agg(F.count(F.lit(1)).alias("n"), *bounds)


def _deepest(coordinates: DataFrame, most: int) -> int:
    """The first level at which no cube holds more than ``LEAF`` coordinates, ``most`` at the latest."""
    counts = _nested(coordinates, most).groupBy("measured", "level", "cube").count()
    full = counts.where(F.col("count") > LEAF).agg(F.max("level")).first()[0]
    return 0 if full is None else min(full + 1, most)


def _in_use(boxes: DataFrame) -> DataFrame:
    """Boxes of the coarsest level and those inside a cube that is cut."""
    cut = boxes.where(F.col("n") > LEAF).selectExpr("measured", "level + 1 AS level", "cube AS parent")
    return boxes.where("level = 0").unionByName(boxes.where("level > 0").join(cut, ["measured", "level", "parent"], "left_semi"))


def _in_cells(points: DataFrame, deepest: int) -> DataFrame:
    """Each point with its cell: the first of its cubes that holds at most ``CELL`` points, else the deepest."""
    nested = points.selectExpr("*", f"explode(sequence(0, {deepest})) AS level").selectExpr(
        "latitude", "longitude", "level", f"{_cube('level')} AS cube"
    )
    full = nested.groupBy("level", "cube").count().where(F.col("count") > CELL).drop("count")
    below = nested.join(full, ["level", "cube"], "left_semi").groupBy("latitude", "longitude").agg(F.max("level").alias("above"))
    found = points.join(below, ["latitude", "longitude"], "left").selectExpr("*", f"least(coalesce(above + 1, 0), {deepest}) AS cell_level")
    return found.selectExpr("latitude", "longitude", *_AXES, "cell_level", f"{_cube('cell_level')} AS cell", f"{_cube('0')} AS c")


_BOUNDS = [f"{side}_{a}" for a in _AXES for side in ("min", "max")]  # of stations
_EXTENT = [f"{side}_{a}" for a in _AXES for side in ("lo", "hi")]  # of the locations that go down together
_NEAR = " + ".join(f"pow(greatest(min_{a} - hi_{a}, lo_{a} - max_{a}, 0D), 2)" for a in _AXES)
_FAR = " + ".join(f"pow(greatest(hi_{a} - min_{a}, max_{a} - lo_{a}), 2)" for a in _AXES)
_CELL = ["cell_level", "cell"]
_POINT = ["latitude", "longitude", *_CELL]  # sorting compares numbers first


def _descended(candidates: DataFrame, boxes: DataFrame, level: int, keys: list[str], cut: str) -> DataFrame:
    """Boxes of many coordinates replaced by those inside them, where ``cut`` holds; the others wait.

    Those that wait still rule out others and may be ruled out. One join serves both: a waiting box
    asks for a level that no box has, and its cube keeps it apart from others like it.
    """
    inside = boxes.where(F.col("level") == level).selectExpr(
        "measured", "level AS asked", "parent AS cube", "cube AS inner_cube", "n AS inner_n", *_BOUNDS
    )
    asking = candidates.selectExpr("*", f"IF(level = {level - 1} AND n > {LEAF} AND {cut}, {level}, -1) AS asked")
    return asking.join(inside, ["measured", "asked", "cube"], "left").selectExpr(
        *keys,
        *_EXTENT,
        "measured",
        "IF(inner_n IS NULL, level, asked) AS level",
        "coalesce(inner_cube, cube) AS cube",
        "coalesce(inner_n, n) AS n",
        f"IF(inner_n IS NULL, near, {_NEAR}) AS near",
        f"IF(inner_n IS NULL, far, {_FAR}) AS far",
    )


def _keep_promising(candidates: DataFrame, limit: float, keys: list[str]) -> DataFrame:
    """Drop boxes that cannot hold the nearest coordinate; ``best`` is a chord that the nearest does not exceed."""
    return (
        candidates.where(f"near <= {limit!r}D")
        .selectExpr("*", f"min(far) OVER (PARTITION BY lo_x, {', '.join(keys)}, measured) AS best")
        .where(f"near <= best + {_SLACK!r}D")
    )


def _nearest_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs of the least half angle: by chord first, which is cheap and leaves few."""
    keys = f"lo_x, {', '.join(_POINT)}, measured"
    chord = " + ".join(f"pow(lo_{a} - station_{a}, 2)" for a in _AXES)
    close = pairs.selectExpr("*", f"{chord} AS chord").where(f"chord <= best + {_SLACK!r}D").drop("best")
    close = close.selectExpr("*", f"min(chord) OVER (PARTITION BY {keys}) AS best")
    angle = half_angle("latitude", "longitude", "station_latitude", "station_longitude")
    ranked = close.where(f"chord <= best + {_SLACK!r}D").withColumn("angle", angle)
    ranked = ranked.selectExpr("*", f"round(angle, {TIE_DIGITS}) AS rounded")
    return ranked.selectExpr("*", f"min(rounded) OVER (PARTITION BY {keys}) AS least").where("rounded = least")


def nearest_per_element(
    locations: DataFrame,
    stations: DataFrame,
    cutoff: float | None = MAX_DISTANCE,
    keep_ties: bool = True,
    depth: int | None = None,
) -> DataFrame:
    """(location_id, measured, station_id, angle, distance, distance_km) of the nearest stations.

    ``locations``: location_id, latitude, longitude. ``stations``: station_id, measured, latitude,
    longitude. ``distance`` is in the cut-off's unit (half the great circle); locations without a
    station closer than ``cutoff`` are left out. Stations at equal distance are all kept, or the
    smallest id alone. Each level divides a cube's edge by four, starting from the cut-off; the number
    of levels follows from the stations unless ``depth`` sets it. The boxes of all levels are summed up
    in one pass and the cells go down to their boxes; both run when this is called, and what they find
    is staged in the shared folder.
    """
    reach = cutoff is not None and cutoff / EARTH_RADIUS_KM < math.pi / 2
    chord = 2 * math.sin(cutoff / EARTH_RADIUS_KM) if reach else 2.0
    limit = chord * chord + _SLACK
    edge = chord * (1 + 1e-9)

    located = locations.where(both_present("latitude", "longitude"))
    placed = stations.where(both_present("latitude", "longitude"))
    points = _vectors(located.select("latitude", "longitude").distinct(), edge)
    coordinates = _vectors(placed.select("measured", "latitude", "longitude").distinct(), edge)
    coordinates = staged(coordinates, "station-coordinates")
    most = max(0, int((_EXACT_BITS - math.log2(1 / edge)) / math.log2(_FAN)))
    deepest = _deepest(coordinates, most) if depth is None else min(depth - 1, most)
    nested = _nested(coordinates, deepest)
    boxes = staged(_in_use(staged(_boxes(nested), "station-cubes")), "station-boxes")
    points = staged(_in_cells(points, deepest), "location-points")

    steps = (-1, 0, 1)
    shifts = [(dx, dy, dz) for dx in steps for dy in steps for dz in steps]
    around = ", ".join(f"named_struct('x', c.x + {dx}, 'y', c.y + {dy}, 'z', c.z + {dz})" for dx, dy, dz in shifts)
    extent = [F.expr(f"{side}({a}) AS {name}_{a}") for a in _AXES for side, name in (("min", "lo"), ("max", "hi"))]
    cells = points.groupBy(*_CELL, "c").agg(*extent)
    starts = cells.selectExpr(*_CELL, *_EXTENT, f"explode(array({around})) AS cube")
    first = starts.join(boxes.where("level = 0"), "cube").selectExpr(
        *_CELL, *_EXTENT, "measured", "level", "cube", "n", f"{_NEAR} AS near", f"{_FAR} AS far"
    )
    candidates = _keep_promising(first, limit, _CELL)
    for level in range(1, deepest + 1):
        candidates = _keep_promising(_descended(candidates, boxes, level, _CELL, f"cell_level >= {level}"), limit, _CELL)
    left = staged(candidates.select(*_CELL, "measured", "level", "cube", "n"), "cell-boxes")
    uncut = left.where(F.col("n") > LEAF).agg(F.min("level")).first()[0]

    bounds = boxes.select("measured", "level", "cube", *_BOUNDS)
    alone = points.selectExpr(*_POINT, *[f"{a} AS {side}_{a}" for a in _AXES for side in ("lo", "hi")])
    each = alone.join(left.join(bounds, ["measured", "level", "cube"]), _CELL).selectExpr(
        *_POINT, *_EXTENT, "measured", "level", "cube", "n", f"{_NEAR} AS near", f"{_FAR} AS far"
    )
    candidates = _keep_promising(each, limit, _POINT)
    for level in range(deepest + 1 if uncut is None else uncut + 1, deepest + 1):
        candidates = _keep_promising(_descended(candidates, boxes, level, _POINT, "true"), limit, _POINT)

    whole = boxes.where((F.col("n") <= LEAF) | (F.col("level") == deepest)).select("measured", "level", "cube")
    leaves = staged(nested.join(whole, ["measured", "level", "cube"], "left_semi"), "station-leaves").select(
        "measured",
        F.col("latitude").alias("station_latitude"),
        F.col("longitude").alias("station_longitude"),
        *[F.col(a).alias(f"station_{a}") for a in _AXES],
        "level",
        "cube",
    )
    closest = _nearest_pairs(candidates.drop("n", "near", "far").join(leaves, ["measured", "level", "cube"]))
    if cutoff is not None:
        closest = closest.where(distance_in_cutoff_unit("angle") < cutoff)
    closest = closest.select("latitude", "longitude", "measured", "station_latitude", "station_longitude", "angle")

    named = placed.select(
        "measured",
        "station_id",
        F.col("latitude").alias("station_latitude"),
        F.col("longitude").alias("station_longitude"),
    )
    matched = closest.join(named, ["measured", "station_latitude", "station_longitude"])
    if not keep_ties:
        matched = leading_rows(matched, ["latitude", "longitude", "measured"], [F.asc("station_id")])
    return located.join(matched, ["latitude", "longitude"]).select(
        "location_id",
        "measured",
        "station_id",
        "angle",
        distance_in_cutoff_unit("angle").alias("distance"),
        distance_km("angle").alias("distance_km"),
    )


def enrich_mapping(mapping: DataFrame, locations: DataFrame, stations: DataFrame) -> DataFrame:
    """Put names and states of both ends beside the mapping."""
    places = locations.select("location_id", "fips", "county", F.col("state").alias("location_state"))
    # Of names or states that differ for one station, the first in order.
    end = F.min(F.struct("station_name", F.col("state").alias("station_state"))).alias("_end")
    ends = stations.groupBy("station_id").agg(end).select("station_id", "_end.*")
    return mapping.join(places, "location_id").join(ends, "station_id")


def state_mismatches(mapping: DataFrame) -> DataFrame:
    """How often a location is mapped to a station of another state, per element and state pair."""
    return (
        mapping.where(F.col("location_state") != F.col("station_state"))
        .groupBy("measured", "location_state", "station_state")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def clear_mapping(mapping: DataFrame, reject: Column, columns: list[str]) -> DataFrame:
    """Null the station columns of rejected rows; the rows stay."""
    bad = F.coalesce(reject, F.lit(False))
    return mapping.select(*[F.when(~bad, F.col(c)).alias(c) if c in columns else F.col(c) for c in mapping.columns])


def clear_state_pairs(mapping: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Null the station columns where (measured, location_state, station_state) is listed."""
    on = ["measured", "location_state", "station_state"]
    marked = mapping.join(pairs.select(*on).distinct().withColumn("_listed", F.lit(True)), on, "left")
    return clear_mapping(marked, F.col("_listed"), columns).drop("_listed").select(*mapping.columns)
