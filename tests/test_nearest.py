"""Nearest stations against all pairs, on points where the search could go wrong."""

import math
import random

import pytest

from tallyfold.operators import nearest
from tallyfold.operators.nearest import TIE_DIGITS, clear_state_pairs, nearest_per_element

RADIUS = 6371


def half_angle(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat1 - lat2) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon1 - lon2) / 2) ** 2
    return math.atan2(math.sqrt(min(h, 1)), math.sqrt(max(1 - h, 0)))


def all_pairs(locations, stations, cutoff, keep_ties=True):
    found = set()
    for place, lat, lon in locations:
        if lat is None or lon is None or math.isnan(lat):
            continue
        for element in {s[1] for s in stations}:
            angles = [(round(half_angle((lat, lon), s[2:]), TIE_DIGITS), s[0]) for s in stations if s[1] == element]
            best = min(angles)
            if cutoff is not None and best[0] * RADIUS >= cutoff:
                continue
            ties = sorted(s for angle, s in angles if angle == best[0])
            found |= {(place, element, s) for s in (ties if keep_ties else ties[:1])}
    return found


def search(spark, locations, stations, **options):
    places = spark.createDataFrame(locations, "location_id int, latitude double, longitude double")
    ends = spark.createDataFrame(stations, "station_id string, measured string, latitude double, longitude double")
    result = nearest_per_element(places, ends, **options).collect()
    for row in result:
        assert row.distance == pytest.approx(row.angle * RADIUS) and row.distance_km == pytest.approx(2 * row.distance)
    return {(r.location_id, r.measured, r.station_id) for r in result}


def scattered(seed, places, ends):
    g = random.Random(seed)

    def point():
        kind = g.randrange(5)
        if kind == 0:  # near a pole
            return g.choice((-1, 1)) * g.uniform(88, 90), g.uniform(-180, 180)
        if kind == 1:  # at the antimeridian
            return g.uniform(-60, 60), g.choice((-1, 1)) * g.uniform(179, 180)
        if kind == 2:  # in a dense cluster
            return 40 + g.uniform(-0.2, 0.2), -74 + g.uniform(-0.2, 0.2)
        return g.uniform(-90, 90), g.uniform(-180, 180)

    stations = [(f"S{i:04d}", g.choice("ABC"), *point()) for i in range(ends)]
    return [(i, *point()) for i in range(places)], stations


@pytest.mark.parametrize("seed, cutoff, depth", [(1, 600, 4), (2, 60, 2), (3, None, 5), (4, 600, 1), (5, 5, 3)])
def test_equals_all_pairs(spark, seed, cutoff, depth):
    locations, stations = scattered(seed, 150, 120)
    got = search(spark, locations, stations, cutoff=cutoff, depth=depth)
    assert got == all_pairs(locations, stations, cutoff)


def test_shared_coordinates_ties_and_missing_points(spark):
    locations = [(1, 10.0, 20.0), (2, 10.0, 20.0), (3, None, 20.0), (4, float("nan"), 1.0), (5, 0.0, 0.0)]
    stations = [
        ("a", "T", 10.0, 21.0),
        ("b", "T", 10.0, 21.0),
        ("c", "T", 10.0, 19.0),
        ("d", "T", 10.0, 25.0),
        ("e", "P", 0.0, 1.0),
        ("f", "P", 0.0, -1.0),
    ]
    assert search(spark, locations, stations) == all_pairs(locations, stations, 600)
    single = search(spark, locations, stations, keep_ties=False)
    assert single == all_pairs(locations, stations, 600, keep_ties=False)
    assert (1, "T", "a") in single and (5, "P", "e") in single


def test_far_cluster_is_not_compared_station_by_station(spark):
    """Many places far from a dense cluster: few stations per place reach the distance."""
    g = random.Random(11)
    stations = [(f"S{i:05d}", "T", 40 + g.uniform(0, 0.5), -74 + g.uniform(0, 0.5)) for i in range(2000)]
    locations = [(i, 36 + g.uniform(0, 0.5), -74 + g.uniform(0, 0.5)) for i in range(20)]
    assert search(spark, locations, stations, depth=5) == all_pairs(locations, stations, 600)


def test_close_locations_go_down_together(spark, monkeypatch):
    """Boxes are looked through once per cell of locations, not once per location."""
    g = random.Random(7)
    stations = [(f"S{i:04d}", "T", g.uniform(-60, 60), g.uniform(-180, 180)) for i in range(300)]
    locations = [(i, 40 + g.uniform(0, 0.2), -74 + g.uniform(0, 0.2)) for i in range(1000)]
    kept = {}

    def staged(df, name):
        kept[name] = nearest_staged(df, name)
        return kept[name]

    nearest_staged = nearest.staged
    monkeypatch.setattr(nearest, "staged", staged)
    assert search(spark, locations, stations, cutoff=None) == all_pairs(locations, stations, None)
    assert kept["cell-boxes"].select("cell_level", "cell").distinct().count() <= 100
    assert kept["cell-boxes"].count() <= 1500


@pytest.mark.parametrize("cell, leaf, cutoff", [(3, 2, None), (1, 16, 600), (200, 1, 600), (200, 3, None)])
def test_cells_and_boxes_of_any_size(spark, monkeypatch, cell, leaf, cutoff):
    monkeypatch.setattr(nearest, "CELL", cell)
    monkeypatch.setattr(nearest, "LEAF", leaf)
    locations, stations = scattered(cell + leaf, 120, 150)
    locations += [(1000 + i, 40.0, -74.0) for i in range(3)]
    assert search(spark, locations, stations, cutoff=cutoff) == all_pairs(locations, stations, cutoff)


def test_infinite_coordinates_spoil_no_neighbours(spark):
    locations = [(1, 10.0, 20.0), (2, 10.1, 20.0), (3, math.inf, 20.0)]
    stations = [("a", "T", 10.0, 20.5), ("b", "T", 10.0, 20.6), ("c", "T", 10.0, -math.inf)]
    assert search(spark, locations, stations) == {(1, "T", "a"), (2, "T", "a")}


def test_cleared_pairs_are_scoped_by_element(spark):
    mapping = spark.createDataFrame(
        [("SNOW", "PR", "FL", "s1"), ("PRCP", "PR", "FL", "s2"), ("SNOW", "PR", None, "s3")],
        "measured string, location_state string, station_state string, station_id string",
    )
    pairs = mapping.where("station_id = 's1'")
    cleared = {(r.measured, r.station_state): r.station_id for r in clear_state_pairs(mapping, pairs, ["station_id"]).collect()}
    assert cleared == {("SNOW", "FL"): None, ("PRCP", "FL"): "s2", ("SNOW", None): "s3"}
