"""Case counts on hand-written rows: nulls, revisions, gaps, overlapping batches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.operators import incremental, joins, latest, timeseries
from tallyfold.operators.locations import with_location_id

D = datetime.date


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.fixture(scope="module")
def cumulated(spark):
    data = [
        (D(2020, 3, 30), "Kent", "Delaware", "10001", 1, 0),
        (D(2020, 3, 31), "Kent", "Delaware", "10001", 4, None),
        (D(2020, 4, 3), "Kent", "Delaware", "10001", 3, 2),
        (D(2020, 3, 31), "Kent", "Michigan", "26081", 5, 1),
        (D(2020, 3, 31), "Unknown", "Guam", None, 7, 0),
        (D(2020, 4, 1), "Unknown", "Guam", None, 9, 1),
        (D(2020, 4, 1), "Nowhere", "Guam", None, 9, 1),
    ]
    return spark.createDataFrame(data, schemas.CASES_CUMULATED)


@pytest.fixture(scope="module")
def locations(spark):
    data = [("Delaware", "Kent", "10001"), ("Michigan", "Kent", "26081"), ("Guam", "Unknown", None)]
    return with_location_id(spark.createDataFrame(data, "state string, county string, fips string"))


@pytest.mark.parametrize("block", [False, True])
@pytest.mark.parametrize(
    "first, expected",
    [
        ("zero", [(1, 0), (3, None), (-1, None)]),
        ("null", [(None, None), (3, None), (-1, None)]),
        ("self", [(1, 0), (3, None), (-1, 2)]),
    ],
)
def test_first_row_rules(cumulated, first, expected, block):
    daily = timeseries.daily_increments(
        cumulated.where("state = 'Delaware'"),
        ["state", "county", "fips"],
        ["cases", "deaths"],
        first=first,
        block=timeseries.month_of("date") if block else None,
    )
    got = [(r.daily_cases, r.daily_deaths) for r in daily.orderBy("date").collect()]
    assert got == expected


def test_null_code_is_one_series(cumulated):
    daily = timeseries.daily_increments(cumulated, ["state", "county", "fips"], ["cases"], block=timeseries.month_of("date"))
    assert rows(daily.where("county = 'Unknown'"), "date", "daily_cases") == [(D(2020, 3, 31), 7), (D(2020, 4, 1), 2)]


def test_unknown_first_rule(cumulated):
    with pytest.raises(ValueError):
        timeseries.daily_increments(cumulated, ["state"], ["cases"], first="other")


def test_full_load_reports_unmatched_places(cumulated, locations):
    result = incremental.full_load(cumulated, locations)
    assert rows(result.unmatched, "county", "state") == [("Nowhere", "Guam")]
    assert result.daily.count() == 6
    assert rows(result.snapshot, "state", "cases") == [("Delaware", 3), ("Guam", 9), ("Michigan", 5)]


def test_batch_keeps_new_location_and_drops_loaded_days(spark, cumulated, locations):
    loaded = cumulated.where("state <> 'Michigan' AND date <= '2020-03-31'")
    start = incremental.full_load(loaded, locations)
    result = incremental.load_batch(start.snapshot, cumulated, locations)
    named = result.daily.join(locations, "location_id")
    assert rows(named, "state", "date", "daily_cases") == [
        ("Delaware", D(2020, 4, 3), -1),
        ("Guam", D(2020, 4, 1), 2),
        ("Michigan", D(2020, 3, 31), None),
    ]


def test_snapshot_row_counts_even_inside_the_batch_window(spark, locations):
    """The batch straddles the snapshot day without holding that row."""
    schema = schemas.CASES_CUMULATED
    loaded = spark.createDataFrame([(D(2020, 4, 2), "Kent", "Delaware", "10001", 10, 0)], schema)
    start = incremental.full_load(loaded, locations).snapshot
    batch = spark.createDataFrame(
        [(D(2020, 4, 1), "Kent", "Delaware", "10001", 6, 0), (D(2020, 4, 3), "Kent", "Delaware", "10001", 13, 0)], schema
    )
    assert rows(incremental.load_batch(start, batch, locations).daily, "date", "daily_cases") == [(D(2020, 4, 3), 3)]


def test_any_split_equals_one_load(spark):
    generator = random.Random(7)
    places = [("S", f"C{i}", None if i % 3 == 0 else f"{i:05d}") for i in range(6)]
    data = []
    for state, county, fips in places:
        total, day = 0, D(2020, 1, 25)
        for _ in range(30):
            day += datetime.timedelta(days=generator.randint(1, 4))
            total += generator.randint(-2, 9)
            data.append((day, county, state, fips, total, total // 3))
    frame = spark.createDataFrame(data, schemas.CASES_CUMULATED)
    locations = with_location_id(spark.createDataFrame(places, "state string, county string, fips string"))
    whole = incremental.full_load(frame, locations, first="null")
    cuts = ["2020-02-10", "2020-02-29", "2020-03-20", "2021-01-01"]
    step = incremental.full_load(frame.where(F.col("date") <= cuts[0]), locations, first="null")
    parts = step.daily
    for cut in cuts[1:]:
        # Each batch starts a week before the last one ended.
        batch = frame.where(F.col("date") <= cut)
        step = incremental.load_batch(step.snapshot, batch, locations)
        parts = parts.unionByName(step.daily)
    columns = ["date", "location_id"]
    key = lambda r: (r[0], r[1], str(r[2]), str(r[3]))
    got = sorted((tuple(r) for r in parts.select(*columns, "daily_cases", "daily_deaths").collect()), key=key)
    expected = sorted((tuple(r) for r in whole.daily.select(*columns, "daily_cases", "daily_deaths").collect()), key=key)
    assert got == expected
    assert rows(step.snapshot, "location_id", "cases") == rows(whole.snapshot, "location_id", "cases")


def test_validated_join_fails_on_a_repeated_key(spark):
    once = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    twice = spark.createDataFrame([(1, "c"), (1, "d")], "k int, y string")
    assert rows(joins.join_one_to_one(once, twice.limit(1), ["k"]), "k", "x") == [(1, "a")]
    with pytest.raises(Exception, match="repeats: 1"):
        joins.join_one_to_one(once, twice, ["k"]).collect()


def test_latest_keeps_ties_and_null_keys(spark):
    data = [(None, 1, "a"), (None, 2, "b"), (1, 5, "c"), (1, 5, "d"), (1, 4, "e")]
    frame = spark.createDataFrame(data, "k int, date int, v string")
    expected = ["b", "c", "d"]
    assert [r[0] for r in rows(latest.latest_rows(frame, ["k"]), "v")] == expected
    assert [r[0] for r in rows(latest.rows_at_extreme(frame, ["k"], "date"), "v")] == expected
