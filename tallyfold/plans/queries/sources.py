"""Queries through files: parsers, writers, stored facts and streams.

Inputs are derived from the test tables, written to the shared scratch folder and read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.fixed_values import UNKNOWN_ELEVATION
from tallyfold.functions import columns as fx
from tallyfold.operators import locations, quality, star, timeseries
from tallyfold.plans import cases as case_jobs
from tallyfold.plans import ledger
from tallyfold.plans import weather as weather_jobs
from tallyfold.plans.queries.cases import (
    _DAILY,
    _KNOWN,
    FIRST_FROM,
    FIRST_TO,
    LOADED_TO,
    PLACE,
    SECOND_FROM,
    _between,
    _known,
)
from tallyfold.plans.queries.weather import _ROLES, _roles, _without
from tallyfold.plans.registry import query
from tallyfold.plans.standins import cumulated, iso_day, nation_locations, observations, table, with_sql
from tallyfold.session import scratch_path, staged
from tallyfold.sinks import files as sinks
from tallyfold.sinks.committed import CommittedTable
from tallyfold.sources import files, text
from tallyfold.streaming import feeds



def _register(spark, sf):
    """Suppliers as register rows: some without state, some of unknown elevation, names with commas."""
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("USC"), F.lpad(key.cast("string"), 8, "0")).alias("station_id"),
        (((key * 6101) % 17000 - 8500) / 100.0).alias("latitude"),
        (((key * 91193) % 36000 - 18000) / 100.0).alias("longitude"),
        F.when(F.col("s_acctbal") < 0, UNKNOWN_ELEVATION).otherwise(F.round("s_acctbal", 1)).alias("elevation"),
        F.when(F.col("s_nationkey") != 0, F.lpad(F.col("s_nationkey").cast("string"), 2, "N")).alias("state"),
        F.concat("s_name", F.lit(", field  B")).alias("station_name"),
    )


_REGISTER = """SELECT 'USC' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS station_id,
       ((s_suppkey * 6101) % 17000 - 8500) / 100.0 AS latitude, ((s_suppkey * 91193) % 36000 - 18000) / 100.0 AS longitude,
       CASE WHEN s_acctbal >= 0 THEN round(s_acctbal, 1) END AS elevation,
       {state} AS state, s_name || '{name}' AS station_name FROM supplier"""


@query(
    "a6_parse_fixed_width",
    "A6 C14 J1 C3 C4 N1",
    _REGISTER.format(
        state="CASE WHEN s_nationkey <> 0 THEN lpad(CAST(s_nationkey AS VARCHAR), 2, 'N') END", name=", field  B"
    ),
)
def a6_parse_fixed_width(spark, sf):
    line = F.concat(
        "station_id",
        F.lit("  "),
        F.lpad(F.col("latitude").cast("string"), 7, " "),
        F.lit(" "),
        F.lpad(F.col("longitude").cast("string"), 9, " "),
        F.lit(" "),
        F.lpad(F.col("elevation").cast("string"), 7, " "),
        F.coalesce("state", F.lit("  ")),
        F.lit(" "),
        "station_name",
    )
    path = scratch_path(spark, "register")
    _register(spark, sf).select(line.alias("value")).write.text(path)
    return text.parse_stations(text.read_lines(spark, path))


@query(
    "a7_parse_by_token",
    "A7 J2",
    _REGISTER.format(state="lpad(CAST(s_nationkey AS VARCHAR), 2, 'N')", name=", field B"),
)
def a7_parse_by_token(spark, sf):
    stated = _register(spark, sf).withColumn("state", F.coalesce("state", F.lit("N0")))
    line = F.concat_ws("  ", "station_id", "latitude", "longitude", "elevation", "state", "station_name")
    return text.parse_stations_by_token(stated.select(line.alias("value")))


@query(
    "a8_parse_gazetteer",
    "A8 J2 J14 N2",
    """SELECT 'S' || CAST(c_nationkey AS VARCHAR) AS state,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Kent County' WHEN 'HOUSEHOLD' THEN 'Isle of Wight County' ELSE c_mktsegment END AS county,
       lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS fips,
       ((c_custkey * 7919) % 17000 - 8500) / 100.0 AS latitude, ((c_custkey * 104729) % 36000 - 18000) / 100.0 AS longitude
FROM customer""",
)
def a8_parse_gazetteer(spark, sf):
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    county = (
        F.when(segment == "BUILDING", "Kent County")
        .when(segment == "HOUSEHOLD", "Isle of Wight County")
        .otherwise(segment)
    )
    line = F.concat_ws(
        "\t",
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")),
        F.lpad(key.cast("string"), 5, "0"),
        F.lit("00161526"),
        county,
        *[F.lit(x) for x in ("1539602137", "25706961", "594.444", "9.926")],
        ((key * 7919) % 17000 - 8500) / 100.0,
        ((key * 104729) % 36000 - 18000) / 100.0,
    )
    header = spark.createDataFrame(
        [("USPS\tGEOID\tANSICODE\tNAME\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG",)], "value string"
    )
    return text.parse_gazetteer(table(spark, sf, "customer").select(line.alias("value")).unionByName(header))


def _raw_weather(spark, sf):
    """Observations in the delivered layout; one value does not parse."""
    rows = observations(spark, sf)
    value = F.when(F.col("event_id") == 5, "n/a").otherwise(F.round(F.col("value") * 10).cast("int").cast("string"))
    return rows.select(
        "station_id",
        F.date_format("date", "yyyyMMdd").alias("date"),
        "measured",
        value.alias("value"),
        F.lit(None).cast("string").alias("measurement_flag"),
        "quality_flag",
        F.lit("7").alias("source_flag"),
        F.lpad(F.col("event_id").cast("string"), 8, "0").alias("hour"),
    )


@query(
    "a1_weather_csv",
    "A1 B4 C3 C4 J7",
    with_sql(
        "observations",
        """SELECT station_id, CAST(date AS VARCHAR) AS date, measured, quality_flag,
       CASE WHEN event_id <> 5 THEN CAST(round(value * 10) AS INT) END AS value FROM observations""",
    ),
)
def a1_weather_csv(spark, sf):
    path = scratch_path(spark, "weather-csv")
    _raw_weather(spark, sf).write.option("compression", "gzip").csv(path)
    rows = fx.cast_all(files.read_weather(spark, path), {"value": "int"})
    return rows.select(
        "station_id", fx.parse_date("date").cast("string").alias("date"), "measured", "quality_flag", "value"
    )


@query(
    "a2_cases_csv",
    "A2 B4",
    with_sql("cumulated", "SELECT CAST(date AS VARCHAR) AS date, county, state, fips, cases, deaths FROM cumulated"),
)
def a2_cases_csv(spark, sf):
    path = scratch_path(spark, "cases-csv")
    sinks.write_csv(cumulated(spark, sf).select(*schemas.CASES_CUMULATED.names), path)
    return files.read_cases(spark, path).select(iso_day(), "county", "state", "fips", "cases", "deaths")


@query(
    "a3_surveillance_csv",
    "A3 E17",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS cdc_report_dt, o_orderstatus AS current_status, o_orderpriority AS age_group, count(*) AS count
FROM orders GROUP BY ALL""",
)
def a3_surveillance_csv(spark, sf):
    day = F.col("o_orderdate").cast("date")
    lines = table(spark, sf, "orders").select(
        day.alias("cdc_report_dt"),
        day.alias("pos_spec_dt"),
        F.lit(None).cast("date").alias("onset_dt"),
        F.col("o_orderstatus").alias("current_status"),
        F.lit("NA").alias("sex"),
        F.col("o_orderpriority").alias("age_group"),
        *[F.lit("Missing").alias(c) for c in ("race", "hosp", "icu", "death", "medcond")],
    )
    path = scratch_path(spark, "surveillance")
    sinks.write_csv(lines, path)
    counted = star.group_counts(files.read_surveillance(spark, path), ["cdc_report_dt", "current_status", "age_group"])
    return counted.withColumn("cdc_report_dt", F.col("cdc_report_dt").cast("string"))


@query(
    "a4_json_groups",
    "B8 E6",
    """SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS count FROM events GROUP BY ALL""",
)
def a4_json_groups(spark, sf):
    path = scratch_path(spark, "groups-json")
    props = schemas.columns("k bigint")
    rows = files.parse_json_column(table(spark, sf, "events").select("event_type", "props"), "props", props)
    sinks.write_json(star.group_counts(rows, ["event_type", "k"]), path)
    return files.read_json_lines(spark, path, schemas.columns("event_type string, k bigint, count bigint"))


_FACT_SCHEMA = schemas.columns("event_id bigint, station_id string, value double, measured string, date string")


def _stored_observations(spark, sf, write):
    path = scratch_path(spark, "observations")
    write(observations(spark, sf).drop("quality_flag").withColumn("date", F.col("date").cast("string")), path, ["measured", "date"])
    return path


@query(
    "b1_partitioned_parquet",
    "A10 B1",
    with_sql(
        "observations", "SELECT event_id, station_id, value, measured, CAST(date AS VARCHAR) AS date FROM observations"
    ),
)
def b1_partitioned_parquet(spark, sf):
    path = _stored_observations(spark, sf, sinks.write_partitioned)
    return files.read_parquet(spark, path, _FACT_SCHEMA)


@query(
    "a11_one_partition",
    "A11 B2",
    with_sql(
        "observations",
        """SELECT event_id, station_id, value, measured, CAST(date AS VARCHAR) AS date FROM observations
WHERE measured = 'SNOW' AND date = DATE '2024-01-15'""",
    ),
)
def a11_one_partition(spark, sf):
    path = _stored_observations(spark, sf, sinks.write_new_partitioned)
    present = files.read_partition(spark, path, _FACT_SCHEMA, measured="SNOW", date="2024-01-15")
    return present.unionByName(files.read_partition(spark, path, _FACT_SCHEMA, measured="SNOW", date="1999-01-01"))


@query(
    "a14_delta_files",
    "A14 B9",
    with_sql(
        "observations",
        """SELECT 'delete' AS operation, count(*) AS n FROM observations WHERE measured = 'TOBS'
UNION ALL SELECT 'insert', count(*) FROM observations WHERE measured = 'SNOW'
UNION ALL SELECT 'update', 0""",
    ),
)
def a14_delta_files(spark, sf):
    directory = scratch_path(spark, "delta-files")
    raw = _raw_weather(spark, sf)
    for operation, element in (("delete", "TOBS"), ("insert", "SNOW")):
        raw.where(F.col("measured") == element).write.csv(f"{directory}/{operation}.csv")
    parts = [
        rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("operation"), "n")
        for name, rows in files.read_deltas(spark, directory).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "b3_flat_parquet",
    "A10 B3 B9 H1",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def b3_flat_parquet(spark, sf):
    path = scratch_path(spark, "suppliers")
    rows = table(spark, sf, "supplier")
    sinks.write_flat(rows, path)
    return files.read_parquet(spark, path).unionByName(files.empty_like(spark, rows))


@query(
    "b4_csv_per_element",
    "B4 A12",
    with_sql("observations", "SELECT event_id, station_id, measured, value FROM observations"),
)
def b4_csv_per_element(spark, sf):
    path = scratch_path(spark, "element-csv")
    sinks.write_csv(observations(spark, sf).select("event_id", "station_id", "measured", "value"), path, ["measured"])
    schema = schemas.columns("event_id bigint, station_id string, value double, measured string")
    return files.read_csv(spark, path, schema)


@query(
    "b6_append",
    "B6 A10",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def b6_append(spark, sf):
    path = scratch_path(spark, "appended")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        sinks.append(orders.where(F.col("o_orderstatus") == status), path)
    return files.read_parquet(spark, path)


@query(
    "b6_repeated_append",
    "B6 K5",
    "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS VARCHAR)[:4] AS year FROM orders",
)
def b6_repeated_append(spark, sf):
    """Batches appended to a committed table, each of them twice, then compacted and appended once more."""
    schema = schemas.columns("o_orderkey bigint, o_orderstatus string, year string")
    stored = CommittedTable(spark, scratch_path(spark, "orders"), schema, ["year"])
    orders = table(spark, sf, "orders").withColumn("year", F.col("o_orderdate").cast("string").substr(1, 4))
    for status in ("F", "O", "P", "F"):
        stored.append(orders.where(F.col("o_orderstatus") == status), f"status {status}")
    stored.compact(small=128 << 20)
    stored.append(orders.where(F.col("o_orderstatus") == "O"), "status O")
    return stored.read()


@query(
    "b7_committed_snapshot",
    "B7 K1",
    "SELECT o_custkey, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS latest FROM orders GROUP BY 1",
)
def b7_committed_snapshot(spark, sf):
    """A snapshot replaced as one version; what was read before stays what it was."""
    stored = CommittedTable(spark, scratch_path(spark, "snapshot"), _SNAPSHOT)
    days = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("latest"))
    cut = F.lit("1998-12-31").cast("date")

    def latest(rows):
        return rows.groupBy("o_custkey").agg(F.max("latest").alias("latest"))

    stored.overwrite(latest(days.where(F.col("latest") <= cut)))
    seen = stored.version()
    merged = latest(stored.read(seen).unionByName(days.where(F.col("latest") > cut)))
    stored.replace(merged, seen.parts, seen)
    return stored.read().withColumn("latest", F.col("latest").cast("string"))


_SNAPSHOT = schemas.columns("o_custkey bigint, latest date")


@query(
    "b7_replace_snapshot",
    "B7 K1",
    "SELECT o_custkey, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS latest FROM orders GROUP BY 1",
)
def b7_replace_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    days = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("latest"))
    cut = F.lit("1998-12-31").cast("date")

    def latest(rows):
        return rows.groupBy("o_custkey").agg(F.max("latest").alias("latest"))

    sinks.replace_snapshot(latest(days.where(F.col("latest") <= cut)), path)
    current = sinks.read_version(spark, path, _SNAPSHOT)
    sinks.replace_snapshot(latest(current.unionByName(days.where(F.col("latest") > cut))), path)
    return sinks.read_version(spark, path, _SNAPSHOT).withColumn("latest", F.col("latest").cast("string"))


def _whole_values(frames):
    return [f.withColumn("value", F.round(F.col("value") * 100).cast("int")) for f in frames]


_DELTA_RESULT = with_sql(
    "observations",
    f"""SELECT measured, station_id, date, CAST(round(value * 100) AS INT) AS value
FROM (SELECT * FROM upd UNION ALL {_without('base', 'upd')})""",
    *_ROLES,
    f"base AS (SELECT * FROM ins UNION ALL {_without('kept', 'ins')})",
)
_FACT_COLUMNS = ["measured", "station_id", "date", "value"]


@query("k8_stored_fact", "K8 B1 A10", _DELTA_RESULT)
def k8_stored_fact(spark, sf):
    fact, gone, insert, update = _whole_values(_roles(spark, sf))
    path = scratch_path(spark, "fact")
    weather_jobs.write_fact(fact, path)
    weather_jobs.apply_deltas_to_path(spark, path, {"delete": gone, "insert": insert, "update": update})
    return weather_jobs.read_fact(spark, path).select(*_FACT_COLUMNS)


@query("stream_delta", "K8 K9 C25", _DELTA_RESULT)
def stream_delta(spark, sf):
    """The same deltas, arriving as files of a stream."""
    fact, gone, insert, update = _whole_values(_roles(spark, sf))
    path, incoming = scratch_path(spark, "fact"), scratch_path(spark, "incoming")
    weather_jobs.write_fact(fact, path)
    flags = [F.lit(None).cast("string").alias(c) for c in schemas.WEATHER_RAW.names[4:]]
    for operation, rows in (("delete", gone), ("insert", insert), ("update", update)):
        delivered = rows.select("station_id", "date", "measured", F.col("value").cast("string"), *flags)
        delivered.write.csv(f"{incoming}/seq=1/op={operation}")
    selected = observations(spark, sf).select("station_id", "measured").distinct()
    stream = feeds.weather_delta_stream(spark, incoming, path, selected, scratch_path(spark, "checkpoint"))
    stream.awaitTermination()
    return weather_jobs.read_fact(spark, path).select(*_FACT_COLUMNS)


@query(
    "stream_cases",
    "K12 A2 B6 B7",
    with_sql(
        "cumulated nation_locations",
        _DAILY.format(cases="cases - lag(cases, 1, 0) OVER w", deaths="deaths - lag(deaths, 1, 0) OVER w").replace(
            "FROM cumulated", "FROM known"
        ),
        _KNOWN,
    ),
)
def stream_cases(spark, sf):
    """First load up to a day, then the later counts as two overlapping batches of a stream."""
    rows, known = staged(cumulated(spark, sf), "cumulated"), nation_locations(spark, sf)
    daily, snapshot = scratch_path(spark, "daily"), scratch_path(spark, "snapshot")
    incoming = scratch_path(spark, "incoming")
    case_jobs.first_load(rows.where(F.col("date") <= F.lit(LOADED_TO).cast("date")), known, daily, snapshot)
    for seq, batch in ((1, _between(rows, FIRST_FROM, FIRST_TO)), (2, _between(rows, SECOND_FROM))):
        sinks.write_csv(batch.select(*schemas.CASES_CUMULATED.names), f"{incoming}/seq={seq}")
    stream = feeds.case_batch_stream(spark, incoming, known, daily, snapshot, scratch_path(spark, "checkpoint"))
    stream.awaitTermination()
    named = case_jobs.read_daily(spark, daily).join(known, "location_id")
    return named.select(*PLACE, iso_day(), "daily_cases", "daily_deaths")


# The first delivery lacks the Mondays and understates the first day of each month; the second brings
# both, for all days, and the days after the first.
_CORRECTED = _DAILY.format(cases="cases - lag(cases, 1, 0) OVER w", deaths="deaths - lag(deaths, 1, 0) OVER w").replace(
    "FROM cumulated", "FROM known"
)


def _deliveries(rows):
    day = F.col("date")
    understated = F.when(F.dayofmonth(day) == 1, F.col("cases") - 1).otherwise(F.col("cases"))
    early = rows.where((day <= F.lit(FIRST_TO).cast("date")) & (F.weekday(day) != 0)).withColumn("cases", understated)
    late = rows.where((day > F.lit(FIRST_TO).cast("date")) | (F.weekday(day) == 0) | (F.dayofmonth(day) == 1))
    return early, late


def _corrected_ledger(spark, sf):
    places, path = nation_locations(spark, sf), scratch_path(spark, "ledger")
    early, late = _deliveries(staged(_known(cumulated(spark, sf), places), "known"))
    for number, rows in enumerate((early, late, late)):
        ledger.load_counts(spark, path, rows, f"batch {min(number, 1)}")
    return path, places


@query("k12_corrections", "K12 K7", with_sql("cumulated nation_locations", _CORRECTED, _KNOWN))
def k12_corrections(spark, sf):
    """A batch that inserts and revises days already loaded gives what a full load gives."""
    path, places = _corrected_ledger(spark, sf)
    return ledger.read_days(spark, path).join(places, "location_id").select(*PLACE, iso_day(), "daily_cases", "daily_deaths")


@query("stream_corrections", "K12 K7", with_sql("cumulated nation_locations", _CORRECTED, _KNOWN))
def stream_corrections(spark, sf):
    """The same deliveries, arriving as files of a stream."""
    places, path = nation_locations(spark, sf), scratch_path(spark, "ledger")
    incoming = scratch_path(spark, "incoming")
    for seq, batch in enumerate(_deliveries(staged(cumulated(spark, sf), "cumulated"))):
        sinks.write_csv(batch.select(*schemas.CASES_CUMULATED.names), f"{incoming}/seq={seq}")
    feeds.correction_stream(spark, incoming, places, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return ledger.read_days(spark, path).join(places, "location_id").select(*PLACE, iso_day(), "daily_cases", "daily_deaths")


@query(
    "k12_corrected_snapshot",
    "K12 K1 B7",
    with_sql(
        "cumulated nation_locations",
        "SELECT CAST(date AS VARCHAR) AS date, state, county, fips, cases, deaths FROM known QUALIFY rank() OVER (PARTITION BY state ORDER BY date DESC) = 1",
        _KNOWN,
    ),
)
def k12_corrected_snapshot(spark, sf):
    path, places = _corrected_ledger(spark, sf)
    return ledger.read_latest(spark, path).join(places, "location_id").select(iso_day(), *PLACE, "cases", "deaths")


@query(
    "a12_lookup_csv",
    "A12 D11 C15",
    """SELECT n_name, CASE n_name WHEN 'NATION_3' THEN 'Washington' ELSE n_name END AS state, (n_nationkey * 617 % 17000 - 8500) / 100.0 AS latitude
FROM nation""",
)
def a12_lookup_csv(spark, sf):
    """State coordinates read back from CSV, one state renamed, joined to the states by name."""
    key = F.col("n_nationkey")
    listed = table(spark, sf, "nation").select(
        F.when(F.col("n_name") == "NATION_3", "Washington State").otherwise(F.col("n_name")).alias("state"),
        ((key * 617 % 17000 - 8500) / 100.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
    )
    path = scratch_path(spark, "states")
    sinks.write_csv(listed, path)
    states = locations.rename_states(files.read_state_coordinates(spark, path))
    reported = table(spark, sf, "nation").select(
        "n_name", F.when(F.col("n_name") == "NATION_3", "Washington").otherwise(F.col("n_name")).alias("state")
    )
    return reported.join(states, "state", "left").select("n_name", "state", "latitude")


@query(
    "a15_census_sums",
    "A15 E6",
    """SELECT c_nationkey % 3 AS SEX, c_nationkey AS ORIGIN, CAST(sum(c_custkey) AS BIGINT) AS POPULATION FROM customer GROUP BY ALL""",
)
def a15_census_sums(spark, sf):
    people = table(spark, sf, "customer").select(
        (F.col("c_nationkey") % 3).alias("SEX"),
        F.col("c_nationkey").alias("ORIGIN"),
        F.lit(1).alias("RACE"),
        (F.col("c_custkey") % 90).cast("int").alias("AGE"),
        F.col("c_custkey").alias("POPULATION"),
    )
    path = scratch_path(spark, "census")
    sinks.write_csv(people, path)
    return star.sum_fact(files.read_census(spark, path), ["SEX", "ORIGIN"], "POPULATION")


@query(
    "a16_distinct_locations",
    "A16 H6",
    with_sql("cumulated", "SELECT DISTINCT state, county, fips FROM cumulated"),
)
def a16_distinct_locations(spark, sf):
    path = scratch_path(spark, "cases-csv")
    sinks.write_csv(cumulated(spark, sf).select(*schemas.CASES_CUMULATED.names), path)
    return locations.distinct_locations(files.read_cases(spark, path))


@query(
    "c3_generated_casts",
    "C3 C4",
    """SELECT o_orderkey, CAST(round(o_totalprice) AS INT) AS whole, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
)
def c3_generated_casts(spark, sf):
    """Text columns, one with unreadable entries, cast by a field-to-type table."""
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.round("o_totalprice").cast("bigint").cast("string").alias("whole"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).otherwise("n/a").alias("price"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )
    typed = fx.cast_all(texts, {"whole": "int", "price": "double", "day": "date"})
    return typed.withColumn("day", F.col("day").cast("string"))


@query(
    "c14_sentinel_to_null",
    "C14",
    "SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN round(s_acctbal, 1) END AS elevation FROM supplier",
)
def c14_sentinel_to_null(spark, sf):
    reported = F.when(F.col("s_acctbal") < 0, UNKNOWN_ELEVATION).otherwise(F.round("s_acctbal", 1))
    return table(spark, sf, "supplier").select("s_suppkey", fx.null_if(reported, UNKNOWN_ELEVATION).alias("elevation"))


@query(
    "c18_rows_with_gaps",
    "C18",
    with_sql("observations", "SELECT event_id, quality_flag FROM observations WHERE value IS NULL OR quality_flag IS NULL"),
)
def c18_rows_with_gaps(spark, sf):
    rows = observations(spark, sf).select("event_id", "value", "quality_flag")
    return rows.where(fx.any_null(["value", "quality_flag"])).select("event_id", "quality_flag")


@query(
    "c25_parameterised_query",
    "C25 C26",
    with_sql(
        "observations",
        """SELECT o.measured, o.station_id, CAST(o.date AS VARCHAR) AS date, o.value FROM observations o
WHERE quality_flag IS NULL AND measured IN ('SNOW', 'PRCP')""",
    ),
)
def c25_parameterised_query(spark, sf):
    """The filter as an SQL template: the tables are arguments."""
    rows = observations(spark, sf)
    chosen = rows.where(F.col("measured").isin("SNOW", "PRCP")).select("station_id", "measured").distinct()
    return spark.sql(
        """WITH passed AS (SELECT * FROM {full} WHERE quality_flag IS NULL)
        SELECT measured, station_id, CAST(date AS STRING) AS date, value
        FROM passed LEFT SEMI JOIN {selected} USING (station_id, measured)""",
        full=rows,
        selected=chosen,
    )


@query(
    "k8_null_dates",
    "K8 B1",
    """SELECT measured, station_id, CAST(date AS VARCHAR) AS date, CASE WHEN n % 15 = 0 THEN value + 1 ELSE value END AS value
FROM (SELECT event_id AS n, event_type AS measured, 'S' || CAST(event_id AS VARCHAR) AS station_id,
             CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y%m%d') END AS date, CAST(event_id % 1000 AS INT) AS value FROM events)
WHERE NOT (n % 3 = 1 AND n % 11 = 0)""",
)
def k8_null_dates(spark, sf):
    """Two deliveries on a stored fact in which one row in seven has no date."""
    events = table(spark, sf, "events")
    rows = events.select(
        F.col("event_id").alias("n"),
        F.col("event_type").alias("measured"),
        F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("station_id"),
        F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyyMMdd")).alias("date"),
        (F.col("event_id") % 1000).cast("int").alias("value"),
    )
    third = F.col("n") % 3

    def part(condition):
        return rows.where(condition).select(*_FACT_COLUMNS)

    path = scratch_path(spark, "fact")
    weather_jobs.write_fact(part(third != 2), path)
    none = files.empty_like(spark, part(third == 2))
    first = {"delete": part((third == 1) & (F.col("n") % 11 == 0)), "insert": part((third == 2) & (F.col("n") % 2 == 0)), "update": none}
    raised = rows.where((third == 0) & (F.col("n") % 5 == 0)).withColumn("value", F.col("value") + 1).select(*_FACT_COLUMNS)
    second = {"delete": none, "insert": part((third == 2) & (F.col("n") % 2 != 0)), "update": raised}
    for deltas in (first, second):
        weather_jobs.apply_deltas_to_path(spark, path, deltas)
    return weather_jobs.read_fact(spark, path).select(*_FACT_COLUMNS)


@query(
    "b1_overwrite",
    "B1",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
)
def b1_overwrite(spark, sf):
    """A second write with fewer partitions leaves none of the first."""
    path = scratch_path(spark, "overwritten")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_partitioned(orders, path, ["o_orderstatus"])
    sinks.write_partitioned(orders.where(F.col("o_orderstatus") != "P"), path, ["o_orderstatus"])
    return files.read_parquet(spark, path, schemas.columns("o_orderkey bigint, o_orderstatus string"))


def record_arrays(rows, key, about=10_000):
    """(``bucket``, ``value``): JSON arrays of about so many records each, dealt by the hash of ``key``."""
    buckets = max(1, -(-rows.count() // about))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")
    return rows.groupBy(bucket).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))


@query(
    "a4_json_array",
    "A4",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
)
def a4_json_array(spark, sf):
    """Arrays of records, one to a file; their number follows the table, so that each stays small."""
    path = scratch_path(spark, "array-json")
    columns = ["c_custkey", "c_mktsegment", "c_acctbal"]
    record_arrays(table(spark, sf, "customer").select(*columns), "c_custkey").write.partitionBy("bucket").text(path)
    read = files.read_json_array(spark, path, schemas.columns("c_custkey bigint, c_mktsegment string, c_acctbal double"))
    return read.select(*columns)


_RECORDS = schemas.columns("o_orderkey bigint, o_custkey bigint, o_totalprice double")


@query("a5_record_page", "A5 L10", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def a5_record_page(spark, sf):
    """The records of an interface, landed as JSON lines, read by their schema and checked for rows."""
    path = scratch_path(spark, "records")
    sinks.write_json(table(spark, sf, "orders").select(*_RECORDS.names), path)
    return quality.require_rows(files.read_json_lines(spark, path, _RECORDS), "no records")


@query(
    "l10_empty_batches",
    "L10 A5",
    """SELECT status, count(o_orderkey) AS records, count(o_orderkey) > 0 AS loaded
FROM (VALUES ('F'), ('O'), ('P'), ('none')) s(status) LEFT JOIN orders ON o_orderstatus = status GROUP BY 1""",
)
def l10_empty_batches(spark, sf):
    """Landed batches, of which one is empty: the guard stops it before anything is written."""
    stored = CommittedTable(spark, scratch_path(spark, "guarded"), _RECORDS)
    orders, seen = table(spark, sf, "orders"), []
    for status in ("F", "O", "P", "none"):
        path = scratch_path(spark, "records")
        sinks.write_json(orders.where(F.col("o_orderstatus") == status).select(*_RECORDS.names), path)
        try:
            records = quality.require_rows(files.read_json_lines(spark, path, _RECORDS), "no records")
            stored.append(records, status)
            seen.append(records.agg(F.lit(status).alias("status"), F.count(F.lit(1)).alias("records"), F.lit(True).alias("loaded")))
        except ValueError:
            seen.append(spark.range(1).select(F.lit(status).alias("status"), F.lit(0).cast("long").alias("records"), F.lit(False).alias("loaded")))
    counted = reduce(DataFrame.unionByName, seen)
    # What was stored agrees with what the guard let through.
    return counted.where(F.lit(stored.read().count()) == F.lit(orders.count()))


@query(
    "k5_append_daily",
    "K5 B6",
    with_sql("cumulated", _DAILY.format(cases="cases - lag(cases, 1, 0) OVER w", deaths="deaths - lag(deaths, 1, 0) OVER w")),
)
def k5_append_daily(spark, sf):
    """Daily rows appended to a stored table in two loads."""
    daily = staged(
        timeseries.daily_increments(cumulated(spark, sf), PLACE, ["cases", "deaths"]).select(*PLACE, "date", "daily_cases", "daily_deaths"),
        "daily",
    )
    path, cut = scratch_path(spark, "appended-daily"), F.lit(LOADED_TO).cast("date")
    sinks.append(daily.where(F.col("date") <= cut), path)
    sinks.append(daily.where(F.col("date") > cut), path)
    return files.read_parquet(spark, path).select(*PLACE, iso_day(), "daily_cases", "daily_deaths")


@query(
    "j5_map_element",
    "J5",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
def j5_map_element(spark, sf):
    """One entry of a map column."""
    entries = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select("event_id", entries["k"].try_cast("int").alias("k"))
