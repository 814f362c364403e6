"""Days as bits, merged batch by batch; and frame fingerprints."""

import datetime
import random

from pyspark.sql import functions as F

from tallyfold.operators import reshape
from tallyfold.operators.daybits import count_days, day_bits, merge_bits
from tallyfold.operators.quality import reporting_days
from tallyfold.plans import stations
from tallyfold.session import scratch_path

SCHEMA = "station_id string, measured string, date date"


def reports(spark, seed, n=600):
    rng = random.Random(seed)
    days = [datetime.date(2019, 12, 30) + datetime.timedelta(i) for i in range(800)]  # a leap year inside
    rows = [(rng.choice("abc"), rng.choice(["PRCP", None]), rng.choice([*days[:40], *days, None])) for _ in range(n)]
    return spark.createDataFrame(rows + [("z", "PRCP", None), ("y", "SNOW", datetime.date(2020, 12, 31)), ("y", "SNOW", datetime.date(2020, 1, 1))], SCHEMA)


def test_merged_bits_count_distinct_days(spark):
    one, two = reports(spark, 1), reports(spark, 2)
    expected = sorted(reporting_days(one.unionByName(two)).collect(), key=str)
    assert sorted(count_days(merge_bits(day_bits(one), day_bits(two))).collect(), key=str) == expected
    assert count_days(day_bits(one.where("false"))).collect() == []


def test_folding_batches_in_any_order(spark):
    path, batches = scratch_path(spark, "days"), [reports(spark, s, 200) for s in range(4)]
    for i in (2, 0, 3, 0, 1, 2):
        stations.fold_days(spark, path, batches[i], str(i))
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2]).unionByName(batches[3])
    expected = sorted(reporting_days(whole).collect(), key=str)
    assert sorted(stations.reported_days(spark, path).collect(), key=str) == expected
    most = stations.significant_stations(spark, path, 100)
    assert sorted(most.collect(), key=str) == [r for r in expected if r.nb_days > 100]
    # A batch of one year rewrites that year alone.
    before = stations.days_table(spark, path).version().parts
    stations.fold_days(spark, path, whole.where(F.year("date") == 2021), "late")
    after = stations.days_table(spark, path).version().parts
    assert {p for p in before if before[p] != after[p]} == {"year=2021"}


def test_fingerprints_tell_frames_apart(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, 0.5), (None, "2", 0.5)]
    frame = lambda r: spark.createDataFrame(r, "n long, s string, x double")
    same = reshape.same_rows(frame(rows), frame(rows[::-1]).repartition(3))
    assert same.first().equal
    assert "hashpartitioning" not in same._jdf.queryExecution().toString()
    plan = reshape.fingerprint(frame(rows))._jdf.queryExecution().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan
    for other in (rows[1:], rows[1:] + rows[2:3], [*rows[:3], (None, "2", None)], [(1, None, None), (1, "a", None), (2, "a", 0.5), (None, "2", 0.5)]):
        assert not reshape.same_rows(frame(rows), frame(other)).first().equal
    # Equal values that hash apart are settled by the rows.
    assert reshape.same_rows(frame([(1, "a", 0.0)]), frame([(1, "a", -0.0)])).first().equal
    assert reshape.same_rows(frame([]), frame([])).first().equal
