"""Batches with new, inserted and revised days against one load of the latest counts."""

import datetime
import random

import pytest

from tallyfold.plans import ledger
from tallyfold.session import scratch_path
from tallyfold.sinks.committed import LostCommit
from tallyfold.streaming import feeds

D = datetime.date
COUNTS = "location_id long, date date, cases int, deaths int"


def frame(spark, rows):
    return spark.createDataFrame(list(rows), COUNTS)


def expected(counts, first):
    """(location, date, cases, deaths, daily_cases, daily_deaths) from {(location, date): (cases, deaths)}."""
    out = []
    for place in {p for p, _ in counts}:
        previous = None
        for day in sorted(d for p, d in counts if p == place):
            now = counts[place, day]
            steps = []
            for i, value in enumerate(now):
                earlier = previous[i] if previous else (0 if first == "zero" else None)
                step = None if value is None or earlier is None else value - earlier
                steps.append(value if step is None and first == "self" else step)
            out.append((place, day, *now, *steps))
            previous = now
    return sorted(out, key=str)


def days(spark, path):
    return sorted((tuple(r) for r in ledger.read_days(spark, path).collect()), key=str)


@pytest.mark.parametrize("first, seed", [("zero", 1), ("null", 2), ("self", 3)])
def test_any_batches_give_what_one_load_gives(spark, first, seed):
    rng = random.Random(seed)
    path, counts = scratch_path(spark, "ledger"), {}
    for batch in range(5):
        rows = {}
        for _ in range(rng.randint(1, 25)):
            place, day = rng.randint(1, 4), D(2020, 1, 1) + datetime.timedelta(rng.choice([rng.randint(0, 20), rng.randint(0, 400)]))
            rows[place, day] = (rng.randint(0, 99), rng.choice([None, rng.randint(0, 9)]))
        if batch == 3:  # days that are known, with the same counts
            rows |= dict(rng.sample(sorted(counts.items()), 5))
        counts |= rows
        delivered = [(*k, *v) for k, v in rows.items()]
        ledger.load_counts(spark, path, frame(spark, delivered + delivered[:2]), str(batch), first)
        assert days(spark, path) == expected(counts, first)
    latest = {(r.location_id, r.date, r.cases, r.deaths) for r in ledger.read_latest(spark, path).collect()}
    assert latest == {(p, d, *counts[p, d]) for p, d in counts if d == max(x for q, x in counts if q == p)}
    # A repeated batch, and one without news, change nothing.
    version = ledger.ledger(spark, path).version().number
    assert ledger.load_counts(spark, path, frame(spark, [(1, D(2020, 1, 1), 7, 7)]), "0") == []
    assert ledger.load_counts(spark, path, frame(spark, [(*k, *v) for k, v in list(counts.items())[:3]]), "again", first) == []
    assert ledger.ledger(spark, path).version().number == version


def test_only_the_months_that_change_are_rewritten(spark):
    path = scratch_path(spark, "ledger")
    rows = [(1, D(2020, m, d), 10 * m + d, 0) for m in (1, 3, 4, 7) for d in (1, 5, 9)] + [(2, D(2020, 2, 1), 1, 0), (2, D(2020, 3, 1), 4, 0)]
    assert ledger.load_counts(spark, path, frame(spark, rows), "0") == ["2020-01", "2020-02", "2020-03", "2020-04", "2020-07"]
    before = ledger.ledger(spark, path).version().parts
    # A day inside a month changes the month alone; its last day changes the place's next month too.
    assert ledger.load_counts(spark, path, frame(spark, [(1, D(2020, 3, 5), 34, 1)]), "1") == ["2020-03"]
    assert ledger.load_counts(spark, path, frame(spark, [(1, D(2020, 4, 9), 50, 2)]), "2") == ["2020-04", "2020-07"]
    assert ledger.load_counts(spark, path, frame(spark, [(1, D(2020, 5, 2), 60, 2)]), "3") == ["2020-05", "2020-07"]
    after = ledger.ledger(spark, path).version().parts
    untouched = {p for p in before if after.get(p) == before[p]}
    assert untouched == {f"kind=day/month=2020-0{m}" for m in (1, 2)} | {f"kind=end/month=2020-0{m}" for m in (1, 2, 7)}
    counts = {(p, d): (c, n) for p, d, c, n in rows}
    counts |= {(1, D(2020, 3, 5)): (34, 1), (1, D(2020, 4, 9)): (50, 2), (1, D(2020, 5, 2)): (60, 2)}
    assert days(spark, path) == expected(counts, "zero")


def test_conflicting_and_undated_rows_fail(spark):
    path = scratch_path(spark, "ledger")
    with pytest.raises(Exception, match="different rows for key"):
        ledger.load_counts(spark, path, frame(spark, [(1, D(2020, 1, 1), 1, 0), (1, D(2020, 1, 1), 2, 0)]), "0")
    with pytest.raises(Exception, match="without a date"):
        ledger.load_counts(spark, path, frame(spark, [(1, None, 1, 0)]), "0")
    assert days(spark, path) == [] and ledger.load_counts(spark, path, frame(spark, []), "0") == []


def test_a_replayed_directory_counts_once(spark, monkeypatch):
    """The load is in place when the stream fails, before it can note so."""
    path, incoming, checkpoint = (scratch_path(spark, n) for n in ("ledger", "incoming", "checkpoint"))
    places = spark.createDataFrame([("NY", "Kings", "36047", 1)], "state string, county string, fips string, location_id long")
    columns = "date string, county string, state string, fips string, cases int, deaths int"
    delivered = [[("2020-01-02", 4), ("2020-01-05", 9)], [("2020-01-03", 6), ("2020-01-05", 10), ("2020-02-01", 12)]]
    for seq, rows in enumerate(delivered):
        frame = spark.createDataFrame([(d, "Kings", "NY", "36047", c, 0) for d, c in rows], columns)
        frame.write.option("header", True).csv(f"{incoming}/seq={seq}")
    mark, calls = feeds.mark_version, []

    def cut(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        mark(*args)

    monkeypatch.setattr(feeds, "mark_version", cut)
    with pytest.raises(Exception, match="lost"):
        feeds.correction_stream(spark, incoming, places, path, checkpoint).awaitTermination()
    feeds.correction_stream(spark, incoming, places, path, checkpoint).awaitTermination()
    counts = {(1, D(2020, 1, 2)): (4, 0), (1, D(2020, 1, 3)): (6, 0), (1, D(2020, 1, 5)): (10, 0), (1, D(2020, 2, 1)): (12, 0)}
    assert days(spark, path) == expected(counts, "zero")
    assert ledger.ledger(spark, path).version().batches == ("seq 0", "seq 1")


def test_of_two_loads_from_one_version_the_second_fails(spark, monkeypatch):
    path, first, increments = scratch_path(spark, "ledger"), [(1, D(2020, 1, 1), 5, 0)], ledger._increments
    ledger.load_counts(spark, path, frame(spark, first), "0")

    def overtaken(*args):
        monkeypatch.setattr(ledger, "_increments", increments)
        ledger.load_counts(spark, path, frame(spark, [(1, D(2020, 1, 20), 8, 0)]), "1")
        return increments(*args)

    monkeypatch.setattr(ledger, "_increments", overtaken)
    late = frame(spark, [(1, D(2020, 2, 1), 9, 0)])
    with pytest.raises(LostCommit):
        ledger.load_counts(spark, path, late, "2")
    ledger.load_counts(spark, path, late, "2")  # run again, it starts from the newer version
    counts = {(1, D(2020, 1, 1)): (5, 0), (1, D(2020, 1, 20)): (8, 0), (1, D(2020, 2, 1)): (9, 0)}
    assert days(spark, path) == expected(counts, "zero")
