"""Observations in buckets: which side of the join moves, and what it gives."""

import re
import uuid

from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.plans import weather
from tallyfold.session import scratch_path
from tallyfold.sinks.bucketed import BUCKET_KEY, bucket_key, open_bucketed


def frames(spark):
    observed = [("NY", "2020-01-01", "PRCP", 1.0), ("NY", "2020-01-01", "SNOW", 2.0), (None, "2020-01-01", "PRCP", 3.0), ("", None, "SNOW", 4.0)]
    cases = [("NY", "2020-01-01", 5), ("NY", "2020-01-02", 6), (None, "2020-01-01", 7), ("", None, 8), ("NY", "2020-01-01", 5)]
    return spark.createDataFrame(cases, "state string, date string, cases int"), spark.createDataFrame(observed, "state string, date string, element string, value double")


def held(rows):
    return sorted((tuple(r) for r in rows.select("state", "date", "cases", "element", "value").collect()), key=str)


def test_only_the_cases_move(spark):
    cases, observed = frames(spark)
    name, path = f"observed_{uuid.uuid4().hex}", scratch_path(spark, "buckets")
    weather.store_weather_by_place(observed, name, path, ["state"], buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = weather.cases_with_stored_weather(spark, cases, name, ["state"])
        expected = held(weather.cases_with_weather(cases, observed, ["state"]))
        assert held(joined) == expected and len(expected) == 10
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.rindex("SortMergeJoin") :]
    assert len(re.findall(rf"Exchange hashpartitioning\({BUCKET_KEY}", join)) == 1
    fact = join[join.rindex("FileScan parquet") :]
    assert "Bucketed: true" in fact and "Exchange" not in join[join.rindex("Sort [") : join.rindex("FileScan parquet")]
    # Another session only needs the description.
    spark.sql(f"DROP TABLE {name}")
    again = open_bucketed(spark, name, path, schemas.columns("state string, date string, element string, value double"), 16)
    assert again.count() == 4 and held(weather.cases_with_stored_weather(spark, cases, name, ["state"])) == expected


def test_bucket_keys_tell_null_from_empty(spark):
    cases, _ = frames(spark)
    keys = cases.select("state", "date").distinct().withColumn("k", bucket_key(["state", "date"]))
    assert keys.where(F.col("k").isNull()).count() == 0
    assert keys.select("k").distinct().count() == keys.count() == 4


def test_elements_are_few(spark, monkeypatch):
    import pytest

    cases, observed = frames(spark)
    monkeypatch.setattr(weather, "MOST_ELEMENTS", 1)
    with pytest.raises(Exception, match="more than 1 elements"):
        weather.cases_with_weather(cases, observed, ["state"]).collect()
