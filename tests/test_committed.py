"""Stored tables with a commit log: readers in between, competing writers, repeated batches, compaction."""

import threading

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.plans import weather
from tallyfold.session import scratch_path
from tallyfold.sinks.committed import CommittedTable, LostCommit

SCHEMA = schemas.columns("n bigint, kind string, day date")


def table(spark, path=None, by=("kind", "day")):
    return CommittedTable(spark, path or scratch_path(spark, "committed"), SCHEMA, by)


def rows(spark, *values):
    return spark.createDataFrame([(n, kind, day) for n, kind, day in values], "n long, kind string, day string").withColumn("day", F.col("day").cast("date"))


def held(stored, version=None):
    return sorted(((r.n, r.kind, r.day and str(r.day)) for r in stored.read(version).collect()), key=str)


A, B, C = (1, "a", "2020-01-01"), (2, "b", None), (3, None, "2020-01-02")


def test_a_reader_keeps_the_version_it_began_with(spark):
    stored = table(spark)
    assert held(stored) == [] and stored.version().number == -1
    stored.overwrite(rows(spark, A, B))
    reader, seen = stored.read(), stored.version()
    part = stored.part(("a", "2020-01-01"))
    stored.replace(rows(spark, (9, "a", "2020-01-01"), C), [part], seen)
    assert sorted(r.n for r in reader.collect()) == [1, 2]
    assert held(stored) == sorted([(9, "a", "2020-01-01"), B, C], key=str)
    assert held(stored, stored.version(0)) == [A, B]
    assert [r.n for r in stored.read(parts=[part, "kind=none/day=none"]).collect()] == [9]


def test_of_two_writers_of_a_partition_one_loses(spark):
    stored = table(spark)
    stored.overwrite(rows(spark, A, B))
    seen = stored.version()
    first, other = stored.part(("a", "2020-01-01")), stored.part(("b", None))
    stored.replace(rows(spark, (5, "a", "2020-01-01")), [first], seen)
    with pytest.raises(LostCommit):
        stored.replace(rows(spark, (6, "a", "2020-01-01")), [first], seen)
    # Another partition has not changed since, so both changes stand.
    stored.replace(rows(spark, (7, "b", None)), [other], seen)
    assert held(stored) == [(5, "a", "2020-01-01"), (7, "b", None)]


def test_only_one_manifest_of_a_number_is_put_in_place(spark):
    stored = table(spark)
    now = stored.version()
    results = []
    threads = [threading.Thread(target=lambda i=i: results.append(stored._publish(now, {}, str(i)))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(results) == [False] * 7 + [True]
    assert stored.numbers() == [0] and len(stored.version().batches) == 1


def test_concurrent_appends_all_count_once(spark):
    stored = table(spark, by=())
    batches = [rows(spark, (i, "x", None)) for i in range(4)]
    threads = [threading.Thread(target=stored.append, args=(batches[i % 4], f"batch {i % 4}")) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [r[0] for r in held(stored)] == [0, 1, 2, 3]
    assert sorted(stored.version().batches) == [f"batch {i}" for i in range(4)]


@pytest.mark.parametrize("by", [(), ("kind", "day")])
def test_append_repeat_and_compact(spark, by):
    stored = table(spark, by=by)
    for i in range(3):
        for _ in range(2):
            stored.append(rows(spark, (i, "a", "2020-01-01"), (i, "b", None)), f"b{i}")
    expected = sorted([(i, *r[1:]) for i in range(3) for r in (A, B)], key=str)
    assert held(stored) == expected and stored.version().number == 2
    assert stored.compact(1) is None
    assert stored.compact(1 << 20) == 3
    assert held(stored) == expected and all(len(c) == 1 for c in stored.version().parts.values())
    stored.append(rows(spark, A), "b1")  # still known after the compaction
    assert held(stored) == expected and stored.compact(1 << 20) is None
    stored.vacuum(grace_seconds=-1)
    assert stored.numbers() == [3] and held(stored) == expected


def test_partitions_without_rows_disappear(spark):
    stored = table(spark)
    stored.overwrite(rows(spark, A, B, C))
    seen = stored.version()
    stored.replace(rows(spark), [stored.part(("a", "2020-01-01")), stored.part((None, "2020-01-02"))], seen)
    assert held(stored) == [B] and len(stored.version().parts) == 1
    stored.overwrite(rows(spark))
    assert held(stored) == []


def test_an_overtaken_delta_changes_nothing(spark, monkeypatch):
    """A second delta is applied while the first one is being computed."""
    path = scratch_path(spark, "fact")
    schema = "measured string, station_id string, date string, value int"
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    old, one, two = ("PRCP", "a", "20200101", 1), ("PRCP", "b", "20200102", 2), ("PRCP", "c", "20200103", 3)
    weather.write_fact(frame(old), path)
    whole, none = weather.apply_delta, frame()

    def overtaken(*args):
        monkeypatch.setattr(weather, "apply_delta", whole)
        weather.apply_deltas_to_path(spark, path, {"delete": none, "insert": frame(two), "update": none})
        return whole(*args)

    monkeypatch.setattr(weather, "apply_delta", overtaken)
    with pytest.raises(LostCommit):
        weather.apply_deltas_to_path(spark, path, {"delete": none, "insert": frame(one), "update": none})
    assert sorted(tuple(r) for r in weather.read_fact(spark, path).select(*schema.replace(",", "").split()[::2]).collect()) == [old, two]
