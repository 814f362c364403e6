"""Deltas on hand-written facts, in memory, stored and streamed."""

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.operators import delta
from tallyfold.plans import weather
from tallyfold.session import scratch_path
from tallyfold.sources import files
from tallyfold.streaming import feeds


def frame(spark, data):
    return spark.createDataFrame(data, schemas.WEATHER_FACT)


def rows(df):
    key = lambda r: tuple(str(x) for x in r)
    return sorted((tuple(r) for r in df.select("measured", "station_id", "date", "value").collect()), key=key)


FACT = [
    ("PRCP", "s1", "20200101", 1),
    ("PRCP", "s1", "20200102", None),
    ("PRCP", "s2", "20200101", 3),
    ("TMIN", "s1", "20200301", 4),
]


def test_delete_needs_every_column_and_matches_null(spark):
    deletes = frame(spark, [("PRCP", "s1", "20200102", None), ("PRCP", "s2", "20200101", 9)])
    assert rows(delta.delete_rows(frame(spark, FACT), deletes)) == [FACT[0], FACT[2], FACT[3]]


def test_order_decides_a_key_in_insert_and_update(spark):
    fact, none = frame(spark, FACT), frame(spark, [])
    insert, update = frame(spark, [("PRCP", "s1", "20200101", 10)]), frame(spark, [("PRCP", "s1", "20200101", 20)])
    assert ("PRCP", "s1", "20200101", 20) in rows(delta.apply_delta(fact, none, insert, update))
    last_insert = delta.apply_delta(fact, none, insert, update, order=("delete", "update", "insert"))
    assert ("PRCP", "s1", "20200101", 10) in rows(last_insert) and last_insert.count() == 4
    with pytest.raises(ValueError):
        delta.apply_delta(fact, none, insert, update, order=("insert", "update", "delete"))


def test_equal_delta_rows_collapse_and_different_ones_fail(spark):
    fact = frame(spark, FACT)
    twice = [("PRCP", "s9", "20200101", 5), ("PRCP", "s9", "20200101", 5)]
    assert delta.upsert(fact, frame(spark, twice)).count() == 5
    with pytest.raises(Exception, match="different rows for key PRCP, s9"):
        delta.upsert(fact, frame(spark, [twice[0], ("PRCP", "s9", "20200101", 6)])).collect()
    with pytest.raises(Exception, match="different rows"):
        delta.upsert(fact, frame(spark, [twice[0], ("PRCP", "s9", "20200101", None)])).collect()


def test_applying_twice_changes_nothing(spark):
    parts = [
        frame(spark, [FACT[0], FACT[2]]),
        frame(spark, [FACT[0], ("TMIN", "s2", "20200301", 7)]),
        frame(spark, [("TMIN", "s1", "20200301", 8)]),
    ]
    once = delta.apply_delta(frame(spark, FACT), *parts)
    assert rows(delta.apply_delta(once, *parts)) == rows(once)


def raw(spark, data):
    return spark.createDataFrame([(s, d, m, v, None, q, "7", None) for m, s, d, v, q in data], schemas.WEATHER_RAW)


def test_irrelevant_and_flagged_rows_are_left_out(spark):
    selected = spark.createDataFrame([("s1", "PRCP"), ("s1", "PRCP")], "station_id string, measured string")
    data = [("PRCP", "s1", "20200101", "1", None), ("PRCP", "s1", "20200102", "1", "X"), ("PRCP", "s2", "20200101", "1", None)]
    clean = weather.clean_deltas({"insert": raw(spark, data)}, selected)["insert"]
    assert rows(clean) == [("PRCP", "s1", "20200101", 1)]


def test_missing_delta_file_is_empty(spark):
    directory = scratch_path(spark, "deltas")
    raw(spark, [("PRCP", "s1", "20200101", "1", None)]).write.csv(f"{directory}/insert.csv")
    counts = {name: df.count() for name, df in files.read_deltas(spark, directory).items()}
    assert counts == {"delete": 0, "insert": 1, "update": 0}


def test_stored_fact_drops_emptied_partitions_and_keeps_the_rest(spark):
    path = scratch_path(spark, "fact")
    weather.write_fact(frame(spark, FACT), path)
    parts = {
        "delete": frame(spark, [FACT[3]]),
        "insert": frame(spark, [("SNOW", "s3", "20200201", 2)]),
        "update": frame(spark, [("PRCP", "s2", "20200101", 30)]),
    }
    expected = [FACT[0], FACT[1], ("PRCP", "s2", "20200101", 30), ("SNOW", "s3", "20200201", 2)]
    for _ in range(2):
        weather.apply_deltas_to_path(spark, path, parts)
        assert rows(weather.read_fact(spark, path)) == expected


def test_stream_applies_directories_in_order(spark):
    path, incoming = scratch_path(spark, "fact"), scratch_path(spark, "incoming")
    weather.write_fact(frame(spark, FACT), path)
    raw(spark, [("PRCP", "s1", "20200101", "50", None)]).write.csv(f"{incoming}/seq=2/op=update")
    raw(spark, [("PRCP", "s1", "20200101", "40", None)]).write.csv(f"{incoming}/seq=1/op=update")
    raw(spark, [("PRCP", "s2", "20200101", "3", None)]).write.csv(f"{incoming}/seq=1/op=delete")
    selected = spark.createDataFrame([("s1", "PRCP"), ("s2", "PRCP")], "station_id string, measured string")
    checkpoint = scratch_path(spark, "checkpoint")
    feeds.weather_delta_stream(spark, incoming, path, selected, checkpoint).awaitTermination()
    expected = [("PRCP", "s1", "20200101", 50), FACT[1], FACT[3]]
    assert rows(weather.read_fact(spark, path)) == expected
    # Nothing new has arrived: a second run changes nothing.
    feeds.weather_delta_stream(spark, incoming, path, selected, checkpoint).awaitTermination()
    assert rows(weather.read_fact(spark, path)) == expected


def test_weather_jobs_end_to_end(spark):
    days = [f"202001{d:02d}" for d in range(1, 13)]
    data = [("PRCP", "US1", d, "5", None) for d in days] + [("PRCP", "US2", d, "6", None) for d in days[:10]]
    data += [("PRCP", "CA1", d, "7", None) for d in days] + [("TOBS", "US1", d, "7", None) for d in days]
    data += [("PRCP", "US2", days[10], "6", "X"), ("PRCP", "US1", days[0], "5", None)]
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "converted")
    raw(spark, data).write.option("compression", "gzip").csv(source)
    weather.convert_raw(spark, source, target)
    observed = files.read_parquet(spark, target, schemas.T.StructType([*schemas.WEATHER_RAW, *schemas.columns("month string")]))
    assert observed.where(F.col("month") == "202001").count() == len(data)
    selected = weather.select_stations(observed, min_days=10)
    assert [tuple(r) for r in selected.collect()] == [("PRCP", "US1")]
    stations = spark.createDataFrame([("US1", 40.0, -74.0, None, "NY", "x"), ("US2", 40.0, -73.0, 1.0, "NY", "y")], schemas.STATIONS)
    places = spark.createDataFrame([("NY", "Kings", "36047", 40.1, -73.1, 1)], schemas.LOCATIONS)
    mapping = weather.map_locations(places, stations, selected)
    assert [(r.location_id, r.station_id) for r in mapping.collect()] == [(1, "US1")]
    assert weather.weather_fact(observed, mapping).count() == 13
