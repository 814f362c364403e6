"""Parsers, readers and writers on hand-written lines."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.functions import columns as fx
from tallyfold.operators import quality, reshape, star
from tallyfold.operators.locations import place_overrides, rename_states, resolve_locations, territory_overrides
from tallyfold.plans import groups as group_jobs
from tallyfold.session import scratch_path
from tallyfold.sinks import database as database_sink
from tallyfold.sinks import files as sinks
from tallyfold.sources import database, files, text


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_station_register(spark):
    parsed = text.parse_stations(
        lines(
            spark,
            "USC00010063  34.2553  -87.1814  239.6 AL ADDISON, NEAR",
            "AQC00914000 -14.3167 -170.7667 -999.9    AASUFOU",
        ).select(F.regexp_replace("value", r"^(.{11}) ", "$1 ").alias("value"))
    ).collect()
    assert parsed[0].station_id == "USC00010063" and parsed[0].latitude == 34.2553
    assert parsed[1].longitude == -170.7667 and parsed[1].elevation is None


def test_station_register_by_position(spark):
    fields = ("USC00010063", 34.2553, -87.1814, 239.6, "AL", "ADDISON, NEAR")
    line = f"{fields[0]}  {fields[1]:7.4f} {fields[2]:9.4f} {fields[3]:7.1f}{fields[4]:2s} {fields[5]}"
    blank = line.replace("239.6AL", "     AL").replace("AL ADD", "   ADD")
    full, empty = text.parse_stations(lines(spark, line, blank)).collect()
    assert tuple(full) == fields
    assert empty.elevation is None and empty.state is None and empty.station_name == "ADDISON, NEAR"


def test_token_parser_keeps_words_of_the_name(spark):
    row = text.parse_stations_by_token(lines(spark, "US1 1.5  -2.5 -999.9 AL TWO  WORDS")).first()
    assert tuple(row) == ("US1", 1.5, -2.5, None, "AL", "TWO WORDS")


def test_gazetteer_names_codes_and_header(spark):
    tail = "1\t2\t3.0\t4.0\t32.5\t-86.6"
    parsed = text.parse_gazetteer(
        lines(
            spark,
            "USPS\tGEOID\tANSICODE\tNAME\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG",
            f"AL\t01001\t00161526\tAutauga\t{tail}",
            f"VA\t51093\t00161526\tIsle of Wight County\t{tail}",
        )
    )
    assert [(r.county, r.fips, r.longitude) for r in parsed.collect()] == [
        ("Autauga", "01001", -86.6),
        ("Isle of Wight County", "51093", -86.6),
    ]


def test_typed_reads_null_what_does_not_parse(spark):
    path = scratch_path(spark, "cases")
    lines(spark, "date,county,state,fips,cases,deaths", "2020-03-01,Kent,Delaware,10001,x,", "bad,Kent,Delaware,,3,1").coalesce(
        1
    ).write.text(path)
    got = files.read_text_then_cast(spark, path, schemas.CASES_CUMULATED).collect()
    assert [(str(r.date), r.fips, r.cases, r.deaths) for r in got] == [("2020-03-01", "10001", None, None), ("None", None, 3, 1)]


GROUPS = [
    ("2020-03-01T00:00:00.000", "Male", "0 - 9 Years", "Asian, Non-Hispanic", "Yes", "3"),
    ("2020-03-01T00:00:00.000", "Male", "0 - 9 Years", "Asian, Non-Hispanic", "No", "4"),
    ("2020-03-01T00:00:00.000", "Female", "80+ Years", "Hispanic/Latino", "No", "5"),
    ("2020-03-02T00:00:00.000", "Female", "80+ Years", "Martian", "No", "6"),
    ("2020-03-02T00:00:00.000", "Female", "80+ Years", None, "No", "1"),
]


def test_population_groups_from_json_array_to_fact(spark, tmp_path):
    source = os.path.join(tmp_path, "groups.json")
    with open(source, "w") as out:
        json.dump([dict(zip(schemas.POPULATION_GROUPS.names, g)) for g in GROUPS], out, indent=1)
    fact, dims = scratch_path(spark, "fact"), scratch_path(spark, "dims")
    group_jobs.full_load(spark, source, fact, dims)
    got = group_jobs.fact_table(spark, fact).read()
    assert sorted(tuple(r)[1:] for r in got.collect() if r.race_ethnicity_id is not None) == [(0, 80, 5, 5), (1, 0, 1, 7)]
    assert got.agg(F.sum("count")).first()[0] == 19
    missing = star.uncovered(got, star.population_dimensions(spark)).first()
    assert missing.race_ethnicity_id == 1 and missing.sex_id == 0
    assert spark.read.parquet(f"{dims}/race_ethnicity").count() == 10

    fresh = files.rows_frame(
        spark, [{"cdc_case_earliest_dt": "2020-03-05T00:00:00.000", "sex": "Other", "age_group": "NA",
                 "race_ethnicity_combined": "Unknown", "count": "2"}], schemas.POPULATION_GROUPS
    )
    group_jobs.append_new(spark, fresh, fact)
    assert group_jobs.fact_table(spark, fact).read().where("sex_id = 2").first()["count"] == 2
    with pytest.raises(ValueError, match="no group counts"):
        group_jobs.append_new(spark, fresh, fact)


def test_records_in_memory_become_a_typed_frame(spark):
    schema = schemas.columns("n bigint, s string")
    frame = files.rows_frame(spark, [{"n": 1, "s": "a"}, {"s": "b", "extra": 0}], schema)
    assert frame.schema == schema and sorted(map(tuple, frame.collect()), key=str) == [(1, "a"), (None, "b")]
    assert files.rows_frame(spark, [], schema).collect() == []


def test_locations_resolve_in_order(spark):
    reported = spark.createDataFrame(
        [
            ("Delaware", "Kent", "10001"),
            ("Washington", "Unknown", None),
            ("Guam", "Unknown", None),
            ("New York", "New York City", None),
            ("Alaska", "Valdez-Cordova Census Area", "02261"),
            ("Guam", "Elsewhere", None),
        ],
        "state string, county string, fips string",
    )
    gazetteer = spark.createDataFrame([("DE", "Kent County", "10001", 39.1, -75.5)], schemas.GAZETTEER)
    states = rename_states(spark.createDataFrame([("Washington State", 47.75, -120.74)], schemas.STATE_COORDINATES))
    resolved = resolve_locations(reported, gazetteer, states, territory_overrides(spark), place_overrides(spark))
    got = {(r.state, r.county): (r.resolved_by, r.latitude) for r in resolved.collect()}
    assert got == {
        ("Delaware", "Kent"): ("fips", 39.1),
        ("Washington", "Unknown"): ("state", 47.75),
        ("Guam", "Unknown"): ("territory", 13.444),
        ("New York", "New York City"): ("place", 40.71274),
        ("Alaska", "Valdez-Cordova Census Area"): ("place", 61.12905),
        ("Guam", "Elsewhere"): (None, None),
    }
    doubled = gazetteer.unionByName(gazetteer)
    with pytest.raises(Exception, match="repeats: 10001"):
        resolve_locations(reported, doubled, states, territory_overrides(spark), place_overrides(spark)).collect()


def test_write_modes(spark):
    path = scratch_path(spark, "modes")
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.write_new_partitioned(frame, path, ["k"])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_new_partitioned(frame, path, ["k"])
    fewer = spark.createDataFrame([("b", 9)], "k string, v int")
    sinks.replace_partitions(fewer, path, ["k"])
    assert sorted((r.k, r.v) for r in files.read_parquet(spark, path).collect()) == [("a", 1), ("b", 9)]
    sinks.write_partitioned(fewer, path, ["k"])
    assert [(r.k, r.v) for r in files.read_parquet(spark, path).collect()] == [("b", 9)]


def test_unfinished_version_is_not_current(spark):
    path = scratch_path(spark, "versions")
    frame = spark.createDataFrame([(1,)], "v int")
    assert sinks.read_version(spark, path, frame.schema) is None
    assert [sinks.replace_snapshot(frame, path) for _ in range(2)] == [1, 2]
    os.makedirs(f"{path}/version={3:010d}")
    assert sinks.current_version(spark, path) == 2
    assert sinks.current_version(spark, path, before=2) == 1


class _Recorder:
    """Stands in for a reader or writer and keeps what it is told; no database is opened."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.told[name] = kwargs or args
            return self

        return call


def test_jdbc_options():
    recorder = _Recorder()

    class Frame:
        write = read = recorder

    database_sink.write_table(Frame, "jdbc:x", "facts", mode="append", connections=4, user="u")
    assert recorder.told["options"] == {"url": "jdbc:x", "dbtable": "facts", "user": "u", "numPartitions": "4"}
    assert recorder.told["mode"] == ("append",)
    database.read_table(Frame, "jdbc:x", "facts", "id", (0, 99), 8)
    assert recorder.told["options"]["partitionColumn"] == "id" and recorder.told["options"]["upperBound"] == "99"
    with pytest.raises(ValueError):
        database.read_table(Frame, "jdbc:x", "facts", "id")


def test_small_column_functions(spark):
    row = spark.range(1).select(
        fx.fips_text(F.lit(1001)).alias("fips"),
        fx.before_comma(F.lit("Asian, Non-Hispanic")).alias("race"),
        fx.before_comma(F.lit(None).cast("string")).alias("none"),
        fx.scientific(F.lit(0.00125)).alias("sci"),
        fx.ratio(F.lit(1), F.lit(0)).alias("ratio"),
        fx.iso_date(F.lit("2020-03-01T00:00:00.000")).cast("string").alias("day"),
        fx.parse_date(F.lit("20200301")).cast("string").alias("compact"),
        fx.surrogate_id(F.lit("a"), F.lit(None).cast("string")).alias("null_id"),
        fx.surrogate_id(F.lit("a"), F.lit("")).alias("blank_id"),
    ).first()
    assert (row.fips, row.race, row.none, row.ratio) == ("01001", "Asian", None, None)
    assert (row.sci, row.day, row.compact) == ("1.25e-03", "2020-03-01", "2020-03-01")
    assert row.null_id != row.blank_id


def test_quality_helpers(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    report = quality.quality_report(frame, ["k"], {"missing": F.col("v").isNull()}).first()
    assert (report.rows, report.distinct_keys, report.repeated_keys, report.missing) == (3, 2, 1, 1)
    empty = quality.quality_report(frame.limit(0), ["k"], {"missing": F.col("v").isNull()}).first()
    assert (empty.rows, empty.missing) == (0, 0)
    assert reshape.same_rows(frame, frame.orderBy("v")).first().equal
    assert not reshape.same_rows(frame, frame.unionByName(frame.limit(1))).first().equal
    with pytest.raises(ValueError, match="nothing"):
        quality.require_rows(frame.limit(0), "nothing")


def test_published_locations(spark):
    from tallyfold.plans import locations as jobs

    cases, gazetteer, states = (scratch_path(spark, name) for name in ("cases", "gazetteer", "states"))
    tail = "1\t2\t3.0\t4.0\t39.1\t-75.5"
    lines(
        spark,
        "date,county,state,fips,cases,deaths",
        "2020-03-01,Kent,Delaware,10001,1,0",
        "2020-03-02,Kent,Delaware,10001,2,0",
        "2020-03-02,Unknown,Washington,,2,",
        "2020-03-02,Atlantis,Guam,,2,",
    ).coalesce(1).write.text(cases)
    lines(spark, "USPS\tGEOID\tX", f"DE\t10001\t00161526\tKent County\t{tail}").coalesce(1).write.text(gazetteer)
    lines(spark, "state,latitude,longitude", "Washington State,47.75,-120.74").coalesce(1).write.text(states)
    target = scratch_path(spark, "locations")
    for _ in range(2):
        jobs.publish_locations(spark, cases, gazetteer, states, target)
    rows = jobs.read_locations(spark, target).collect()
    assert sorted((r.state, r.fips, r.latitude) for r in rows) == [("Delaware", "10001", 39.1), ("Washington", None, 47.75)]
    assert len({r.location_id for r in rows}) == 2


def test_staged_tables_go_with_their_job(spark):
    from tallyfold.session import staging

    with staging(spark) as stage:
        table = stage(spark.range(3).toDF("id"), "numbers")
        path = table.inputFiles()[0]
        assert table.count() == 3
    assert not os.path.exists(path.removeprefix("file:"))


def test_arrays_of_records_stay_small(spark):
    from tallyfold.plans.queries.sources import record_arrays

    arrays = [json.loads(r.value) for r in record_arrays(spark.range(1000), "id", about=50).collect()]
    assert sorted(x["id"] for a in arrays for x in a) == list(range(1000))
    assert len(arrays) > 10 and max(map(len, arrays)) < 150
