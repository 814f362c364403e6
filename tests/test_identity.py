"""Ids that survive a collision of hashes, reruns and growing input."""

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.columns import seeded_id, surrogate_id
from tallyfold.operators.identity import new_ids
from tallyfold.plans import locations
from tallyfold.session import scratch_path
from tallyfold.sinks.committed import LostCommit

COLUMNS = ["state", "county", "fips"]
SCHEMA = "state string, county string, fips string"
PLACES = [("NY", "Kings", "36047"), ("NY", "Bronx", None), ("NY", "", None), (None, "x", "1"), ("PR", None, None)]


def places(spark, rows=PLACES):
    return spark.createDataFrame(rows, SCHEMA)


def ids(rows):
    return {tuple(r)[:3]: r.location_id for r in rows.collect()}


def known(spark, rows=()):
    return spark.createDataFrame(list(rows), f"{SCHEMA}, location_id long")


def colliding(seed, *columns):
    """All keys share the first hash and fall into two or three under the next ones."""
    return F.lit(7).cast("long") if seed == 0 else F.pmod(seeded_id(seed, *columns), F.lit(3)) + 100 * seed


def test_without_collisions_the_hash_is_the_id(spark):
    expected = ids(places(spark).withColumn("location_id", surrogate_id(*COLUMNS)))
    assert ids(new_ids(places(spark, PLACES * 2), known(spark), COLUMNS, "location_id")) == expected
    assert new_ids(places(spark, []), known(spark), COLUMNS, "location_id").collect() == []


def test_colliding_keys_get_ids_of_their_own(spark):
    first = ids(new_ids(places(spark, PLACES[:2]), known(spark), COLUMNS, "location_id", colliding))
    assert len(set(first.values())) == 2 and 7 in first.values()
    # Grown input: known keys are not numbered again, new ones avoid their ids.
    held = known(spark, [(*k, v) for k, v in first.items()])
    more = ids(new_ids(places(spark), held, COLUMNS, "location_id", colliding))
    assert set(more) == set(PLACES[2:]) and len({*first.values(), *more.values()}) == 5
    again = ids(new_ids(places(spark, PLACES[::-1]).repartition(3), held, COLUMNS, "location_id", colliding))
    assert again == more


def test_hashes_that_never_part_fail(spark):
    with pytest.raises(ValueError, match="collide"):
        new_ids(places(spark, PLACES[:2]), known(spark), COLUMNS, "location_id", lambda seed, *c: F.lit(1).cast("long"))


def test_stored_ids_stay(spark, monkeypatch):
    path = scratch_path(spark, "ids")
    monkeypatch.setattr(locations, "new_ids", lambda *a, **k: new_ids(*a, hashed=colliding, **k))
    locations.add_location_ids(spark, path, places(spark, PLACES[:3]), "one")
    first = ids(locations.location_ids(spark, path).read())
    for _ in range(2):
        locations.add_location_ids(spark, path, places(spark), "two")
    whole = ids(locations.location_ids(spark, path).read())
    assert {k: whole[k] for k in first} == first and len(whole) == len(set(whole.values())) == 5
    found = ids(locations.with_stored_id(spark, path, places(spark, [*PLACES, ("ZZ", "unknown", None)])))
    assert found == whole | {("ZZ", "unknown", None): None}


def test_a_run_that_was_overtaken_fails(spark, monkeypatch):
    path = scratch_path(spark, "ids")
    locations.add_location_ids(spark, path, places(spark, PLACES[:1]), "one")

    def overtaken(*args, **options):
        monkeypatch.setattr(locations, "new_ids", new_ids)
        locations.add_location_ids(spark, path, places(spark, PLACES[1:3]), "two")
        return new_ids(*args, **options)

    monkeypatch.setattr(locations, "new_ids", overtaken)
    with pytest.raises(LostCommit):
        locations.add_location_ids(spark, path, places(spark, PLACES[1:]), "three")
    assert len(ids(locations.location_ids(spark, path).read())) == 3
