"""Repeated, late, missing and cut-off input of the stored jobs, and sizes beyond one level."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import incremental, nearest, ordered, report, stats, timeseries
from tallyfold.operators.locations import with_location_id
from tallyfold.plans import weather
from tallyfold.session import scratch_path
from tallyfold.sinks import files as sinks
from tallyfold.streaming import feeds

FACT = "measured string, station_id string, date string, value int"
D = datetime.date


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def stored(spark, path):
    rows = weather.read_fact(spark, path).select("measured", "station_id", "date", "value").collect()
    return sorted((tuple(r) for r in rows), key=str)


def none(spark):
    return fact(spark, [])


def test_null_dates_survive_a_delta(spark):
    path = scratch_path(spark, "fact")
    rows = [("PRCP", "a", None, 1), ("PRCP", "b", None, 2), (None, "c", "20200101", 3), ("SNOW", "d", "20200101", 4)]
    weather.write_fact(fact(spark, rows), path)
    new = ("PRCP", "e", None, 5)
    weather.apply_deltas_to_path(spark, path, {"delete": none(spark), "insert": fact(spark, [new]), "update": none(spark)})
    assert stored(spark, path) == sorted([*rows, new], key=str)
    gone = {"delete": fact(spark, [*rows[:2], new]), "insert": none(spark), "update": fact(spark, [(None, "c", "20200101", 9)])}
    weather.apply_deltas_to_path(spark, path, gone)
    assert stored(spark, path) == sorted([(None, "c", "20200101", 9), rows[3]], key=str)


@pytest.mark.parametrize("finish", ["repeat", "other"])
def test_replacement_that_was_cut_off_leaves_the_fact_as_it_was(spark, monkeypatch, finish):
    path = scratch_path(spark, "fact")
    rows = [("PRCP", "a", "20200101", 1), ("PRCP", "b", "20200102", 2), ("SNOW", "c", "20200101", 3)]
    weather.write_fact(fact(spark, rows), path)
    delta = {"delete": fact(spark, rows[2:]), "insert": fact(spark, [("PRCP", "n", "20200103", 5)]), "update": none(spark)}

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as cut, pytest.raises(OSError):
        cut.setattr(weather.CommittedTable, "_publish", fail)
        weather.apply_deltas_to_path(spark, path, delta)
    assert stored(spark, path) == rows
    expected = [rows[0], rows[1], ("PRCP", "n", "20200103", 5)]
    if finish == "repeat":
        weather.apply_deltas_to_path(spark, path, delta)
    else:
        added = ("TMIN", "z", "20200101", 7)
        weather.apply_deltas_to_path(spark, path, {"delete": none(spark), "insert": fact(spark, [added]), "update": none(spark)})
        expected = [*rows, added]
    assert stored(spark, path) == expected
    weather.fact_table(spark, path).vacuum(grace_seconds=-1)
    assert stored(spark, path) == expected


def test_late_directory_is_refused(spark):
    path, incoming, checkpoint = (scratch_path(spark, n) for n in ("fact", "incoming", "checkpoint"))
    weather.write_fact(fact(spark, [("PRCP", "s1", "20200101", 1)]), path)
    selected = spark.createDataFrame([("s1", "PRCP")], "station_id string, measured string")

    def deliver(number, value):
        row = ("s1", "20200101", "PRCP", value, None, None, None, None)
        frame = spark.createDataFrame([row], weather.schemas.WEATHER_RAW)
        frame.write.csv(f"{incoming}/seq={number}/op=update")

    deliver(2, "20")
    feeds.weather_delta_stream(spark, incoming, path, selected, checkpoint).awaitTermination()
    deliver(1, "10")
    with pytest.raises(Exception, match="seq=1 came after seq=2"):
        feeds.weather_delta_stream(spark, incoming, path, selected, checkpoint).awaitTermination()
    assert stored(spark, path) == [("PRCP", "s1", "20200101", 20)]


def test_newer_rows_prune_directories_and_row_groups(spark):
    path = scratch_path(spark, "dated")
    frame = spark.createDataFrame([(D(2020, 1, d), D(2020, 1, d), d) for d in range(1, 10)], "date date, day date, v int")
    sinks.write_partitioned(frame, path, ["date"])
    table = spark.read.parquet(path)
    for column, mark in (("date", "PartitionFilters: [isnotnull(date"), ("day", "PushedFilters: [IsNotNull(day), GreaterThan(day,2020-01-07)]")):
        last = spark.createDataFrame([(D(2020, 1, 7),)], "last date")
        fresh = timeseries.newer_than(table, last, column)
        assert mark in fresh._jdf.queryExecution().toString()
        assert sorted(r.v for r in fresh.collect()) == [8, 9]
    assert timeseries.newer_than(table, spark.createDataFrame([(None,)], "last date")).count() == 9


def cases(spark, rows):
    return spark.createDataFrame([("NY", "Kings", "36047", *r) for r in rows], "state string, county string, fips string, date date, cases int, deaths int")


def test_repeated_days_count_once_or_fail(spark):
    places = spark.createDataFrame([("NY", "Kings", "36047", 1)], "state string, county string, fips string, location_id int")
    start = incremental.full_load(cases(spark, [(D(2020, 1, 1), 1, 0), (D(2020, 1, 1), 1, 0)]), places)
    assert [(r.daily_cases) for r in start.daily.collect()] == [1]
    same = cases(spark, [(D(2020, 1, 2), 5, 0), (D(2020, 1, 2), 5, 0), (D(2020, 1, 3), 7, 1)])
    result = incremental.load_batch(start.snapshot, same, places)
    assert sorted((r.date, r.daily_cases) for r in result.daily.collect()) == [(D(2020, 1, 2), 4), (D(2020, 1, 3), 2)]
    other = cases(spark, [(D(2020, 1, 2), 5, 0), (D(2020, 1, 2), 8, 0)])
    with pytest.raises(Exception, match="different rows for key"):
        incremental.load_batch(start.snapshot, other, places).daily.collect()
    for block in ("month", None):
        with pytest.raises(Exception, match="different counts on one day"):
            timeseries.daily_increments(other, ["state"], ["cases"], block=block).collect()


def test_dense_places_at_any_depth(spark):
    n = 600
    points = [(i, 40 + (i * 7919 % 1000) * 1e-6, -100 + (i * 104729 % 1000) * 1e-6) for i in range(n)]
    stations = [(str(i), "T", 40 + (i * 6101 % 1000) * 1e-6, -100 + (i * 91193 % 1000) * 1e-6) for i in range(n)]
    places = spark.createDataFrame(points, "location_id int, latitude double, longitude double")
    ends = spark.createDataFrame(stations, "station_id string, measured string, latitude double, longitude double")
    found = [
        sorted((r.location_id, r.station_id) for r in nearest.nearest_per_element(places, ends, cutoff, depth=depth).collect())
        for cutoff, depth in ((600, None), (0.5, None), (600, 40), (None, 3))
    ]
    assert found[0] == found[1] == found[2] == found[3]

    def chord(a, b):
        return math.dist(*([math.cos(math.radians(p)) * math.cos(math.radians(q)), math.cos(math.radians(p)) * math.sin(math.radians(q)), math.sin(math.radians(p))] for p, q in (a, b)))

    for i, lat, lon in points[:20]:
        best = min(chord((lat, lon), s[2:]) for s in stations)
        got = [s for s in stations if (i, s[0]) in set(found[0])]
        assert got and all(chord((lat, lon), s[2:]) <= best + 1e-11 for s in got)


def test_one_name_per_station(spark):
    mapping = spark.createDataFrame([(1, "s")], "location_id int, station_id string")
    places = spark.createDataFrame([(1, "f", "c", "NY")], "location_id int, fips string, county string, state string")
    ends = spark.createDataFrame([("s", "b", "NJ"), ("s", "a", "NY"), ("s", "a", "CT")], "station_id string, station_name string, state string")
    for frame in (ends, ends.repartition(3)):
        row = nearest.enrich_mapping(mapping, places, frame).first()
        assert (row.station_name, row.station_state) == ("a", "CT")


def test_bounds_in_several_levels(spark, monkeypatch):
    frame = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("v"), F.lit(1).cast("long").alias("one"))
    expected = {r.v: r.before for r in ordered.running_totals(frame, "v", "one", blocks=64).collect()}
    monkeypatch.setattr(ordered, "_FAN", 4)
    placed = ordered.with_value_block(frame, "v", 64).orderBy("v").select(ordered._BLOCK).collect()
    numbers = [r[0] for r in placed]
    assert numbers == sorted(numbers) and len(set(numbers)) > 40 and max(numbers) < 64
    assert {r.v: r.before for r in ordered.running_totals(frame, "v", "one", blocks=64).collect()} == expected


def test_nan_is_skipped(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0), (float("nan"), 1.0), (4.0, float("nan")), (None, 3.0)], "x double, y double")
    assert [(r.bin, r["count"]) for r in report.histogram(rows, "x", 3).orderBy("bin").collect()] == [(0, 1), (1, 1), (2, 2)]
    assert stats.correlation(rows, "x", "y").first().corr == pytest.approx(0.9933992677987828)
    fit = stats.simple_regression(rows, "x", "y").first()
    assert fit.n == 3 and fit.slope == pytest.approx(2.5)


def test_lags_of_any_step(spark):
    data = [(D(2020, 1, 1) + datetime.timedelta(days=i), float(i * i % 17), float(i * 5 % 13)) for i in range(60)]
    frame = spark.createDataFrame(data, "date date, a double, b double")
    for lags in (range(-6, 7, 3), range(2, 9)):
        found = {r.lag: r.corr for r in stats.lagged_correlation(frame, "a", "b", lags).collect()}
        assert set(found) == set(lags)
        for lag, corr in found.items():
            pairs = [(data[i][1], data[i - lag][2]) for i in range(60) if 0 <= i - lag < 60]
            n = len(pairs)
            mx, my = sum(p[0] for p in pairs) / n, sum(p[1] for p in pairs) / n
            top = sum((p[0] - mx) * (p[1] - my) for p in pairs)
            assert corr == pytest.approx(top / math.sqrt(sum((p[0] - mx) ** 2 for p in pairs) * sum((p[1] - my) ** 2 for p in pairs)))


def test_order_of_sorted_results(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("c",), (None,)], "k string").repartition(4)
    assert [(r.k, r["count"]) for r in report.value_counts(frame, ["k"]).collect()] == [("a", 2), ("c", 2), (None, 1), ("b", 1)]
    numbers = spark.range(50).repartition(7)
    assert [r.id for r in report.top_rows(numbers, [F.desc("id")], 4).collect()] == [49, 48, 47, 46]
    sizes = report.group_summary(spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 3.0)], "k int, v double").repartition(3), "v", ["k"])
    assert [(r.k, r.len) for r in sizes.collect()] == [(2, 2), (1, 1)]


def test_location_ids_do_not_depend_on_partitions(spark):
    rows = [(f"S{i % 4}", f"county {i}", f"{i:05d}", float(i), float(-i)) for i in range(40)]
    frame = spark.createDataFrame(rows, "state string, county string, fips string, latitude double, longitude double")
    found = [
        sorted((r.state, r.county, r.location_id) for r in with_location_id(f).collect())
        for f in (frame, frame.repartition(7), frame.orderBy(F.desc("fips")))
    ]
    assert found[0] == found[1] == found[2]
    assert len({i for _, _, i in found[0]}) == 40
