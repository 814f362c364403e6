"""Explicit schemas of every table; nothing here is inferred from files.

FIXED VALUES: the names and types are those of the delivered and published tables.
"""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def columns(text: str) -> T.StructType:
    """Schema of flat columns given as ``name type, ...``; needs no session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Observations as delivered: all text, date as yyyyMMdd.
WEATHER_RAW = columns(
    "station_id string, date string, measured string, value string, "
    "measurement_flag string, quality_flag string, source_flag string, hour string"
)
WEATHER_FACT = columns("measured string, station_id string, date string, value int")
STATIONS = columns(
    "station_id string, latitude double, longitude double, elevation double, state string, station_name string"
)
GAZETTEER = columns("state string, county string, fips string, latitude double, longitude double")
CASES_CUMULATED = columns("date date, county string, state string, fips string, cases int, deaths int")
CASES_DAILY = columns("date date, location_id bigint, daily_cases int, daily_deaths int")
CASES_SNAPSHOT = columns(
    "date date, location_id bigint, fips string, county string, state string, deaths int, cases int"
)
LOCATIONS = columns(
    "state string, county string, fips string, latitude double, longitude double, location_id bigint"
)
LOCATION_STATIONS = columns("location_id bigint, measured string, station_id string, distance double")
SURVEILLANCE = columns(
    "cdc_report_dt date, pos_spec_dt date, onset_dt date, current_status string, sex string, "
    "age_group string, race string, hosp string, icu string, death string, medcond string"
)
POPULATION_GROUPS = columns(
    "cdc_case_earliest_dt string, sex string, age_group string, "
    "race_ethnicity_combined string, death_yn string, count string"
)
POPULATION_FACT = columns(
    "cdc_case_earliest_dt date, sex_id int, age_group_id int, race_ethnicity_id int, count bigint"
)
STATE_COORDINATES = columns("state string, latitude double, longitude double")
STATE_ABBREVIATIONS = columns("State string, Postal string")
CLOSEST_STATIONS = columns(
    "element string, fips string, county string, state_gazeeter string, station_id string, "
    "station_name string, state_station string, latitude_station double, "
    "longitude_station double, distance double"
)
CENSUS = columns("SEX int, ORIGIN int, RACE int, AGE int, POPULATION bigint")
AGE_DIMENSION = columns("age_group_id int, age_group string")
RACE_DIMENSION = columns("race_ethnicity_id int, race string, Hispanic_Latino boolean")
SEX_DIMENSION = columns("sex_id int, sex string")
