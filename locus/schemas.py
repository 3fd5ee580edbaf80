"""Typed schemas of every staging and final table, plus their keys.

The pipeline never infers a schema at load time: raw files are read into
these declared types (positional for delimited files, by name for JSON).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

S, D, L, I, DT, TS = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.TimestampNTZType(),
)

MOBILITY_MEASURES = [
    "retail_and_recreation_percent_change_from_baseline",
    "grocery_and_pharmacy_percent_change_from_baseline",
    "parks_percent_change_from_baseline",
    "transit_stations_percent_change_from_baseline",
    "workplaces_percent_change_from_baseline",
    "residential_percent_change_from_baseline",
]


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


COVID_STAGING = _struct(
    ("fips", S, True),
    ("admin2", S, True),
    ("province_state", S, True),
    ("country_region", S, True),
    ("last_update_dts", TS, True),
    ("latitude", D, True),
    ("longitude", D, True),
    ("confirmed", L, True),
    ("deaths", L, True),
    ("recovered", L, True),
    ("active", D, True),
    ("combined_key", S, True),
    ("incident_rate", D, True),
    ("case_fatality_ratio", D, True),
    ("file_date", DT, True),
)

LOOKUP_STAGING = _struct(
    ("uid", I, True),
    ("iso2", S, True),
    ("iso3", S, True),
    ("code3", S, True),
    ("fips", D, True),
    ("admin2", S, True),
    ("province_state", S, True),
    ("country_region", S, True),
    ("latitude", D, True),
    ("longitude", D, True),
    ("combined_key", S, True),
    ("population", D, True),
)

MOBILITY_STAGING = _struct(
    ("country_region_code", S, True),
    ("country_region", S, True),
    ("sub_region_1", S, True),
    ("sub_region_2", S, True),
    ("metro_area", S, True),
    ("iso_3166_2_code", S, True),
    ("census_fips_code", D, True),
    ("date", DT, True),
    *[(m, D, True) for m in MOBILITY_MEASURES],
)

MOBILITY_CONFORMED = _struct(
    ("location_identifier", I, False),
    ("last_update_dt", DT, False),
    *[(m, D, True) for m in MOBILITY_MEASURES],
    ("location_granularity", S, True),
)

LOCATION_LOOKUP = _struct(
    ("location_identifier", I, False),
    ("iso2_code", S, True),
    ("iso3_code", S, True),
    ("country_region", S, False),
    ("province_or_state", S, True),
    ("county_or_city", S, True),
    ("fips_code", I, True),
    ("location_latitude", D, True),
    ("location_longitude", D, True),
    ("location_name", S, True),
    ("location_population", D, True),
)

MOBILITY_FACT = _struct(
    ("location_identifier", I, False),
    ("file_date", DT, False),
    *[(m, D, True) for m in MOBILITY_MEASURES],
    ("location_granularity", S, True),
)

COVID_FACT = _struct(
    ("location_identifier", I, False),
    ("file_date", DT, False),
    ("ttl_confirmed_cases", L, True),
    ("ttl_deaths", L, True),
    ("ttl_active_cases", L, True),
    ("ttl_recovered_cases", L, True),
    ("incident_rate", D, True),
    ("case_fatality_ratio", D, True),
    ("new_confirmed_cases", I, True),
    ("new_deaths", I, True),
    ("new_recoveries", I, True),
    ("location_granularity", S, True),
)

# Raw case-report file as landed (JSON lines): source header -> staging column.
# The public daily-report column names.
CASE_REPORT_FIELDS = {
    "FIPS": "fips",
    "Admin2": "admin2",
    "Province_State": "province_state",
    "Country_Region": "country_region",
    "Last_Update": "last_update_dts",
    "Lat": "latitude",
    "Long_": "longitude",
    "Confirmed": "confirmed",
    "Deaths": "deaths",
    "Recovered": "recovered",
    "Active": "active",
    "Combined_Key": "combined_key",
    "Incident_Rate": "incident_rate",
    "Case_Fatality_Ratio": "case_fatality_ratio",
    "file_date": "file_date",
}


def raw_report_schema(fields: Mapping[str, str] = CASE_REPORT_FIELDS) -> T.StructType:
    """Landed JSON is read as text (a number's literal as it stands) and parsed
    with checks, so that no value is lost to a wrong declared type."""
    return T.StructType([T.StructField(src, S, True) for src in fields])


CASE_REPORT_RAW = raw_report_schema()

# Columns of the landed report that are numbers there.
CASE_REPORT_NUMBERS = {
    src: COVID_STAGING[dst].dataType
    for src, dst in CASE_REPORT_FIELDS.items()
    if COVID_STAGING[dst].dataType in (D, L)
}

STAGING_TABLES = {
    "covid_data_staging": COVID_STAGING,
    "location_lookup_staging": LOOKUP_STAGING,
    "google_mobility_data_staging": MOBILITY_STAGING,
    "google_mobility_data_non_us_staging": MOBILITY_CONFORMED,
    "google_mobility_data_us_staging": MOBILITY_CONFORMED,
}

FINAL_TABLES = {
    "location_lookup": LOCATION_LOOKUP,
    "google_mobility_data_non_us": MOBILITY_FACT,
    "google_mobility_data_us": MOBILITY_FACT,
    "covid_data_non_us": COVID_FACT,
    "covid_data_us": COVID_FACT,
}

ALL_TABLES = {**STAGING_TABLES, **FINAL_TABLES}

# Kept beside the facts: of a case fact each location's last row of every month
# (carry), of every fact each location's sums of every month (totals).
CARRY_TABLES = {f"{name}_carry" for name, schema in FINAL_TABLES.items() if schema is COVID_FACT}
TOTALS_TABLES = {f"{name}_totals" for name, schema in FINAL_TABLES.items() if schema is not LOCATION_LOOKUP}
HELPER_TABLES = CARRY_TABLES | TOTALS_TABLES

FACT_KEY = ["location_identifier", "file_date"]

TABLE_KEYS = {
    "location_lookup": ["location_identifier"],
    "google_mobility_data_non_us": FACT_KEY,
    "google_mobility_data_us": FACT_KEY,
    "covid_data_non_us": FACT_KEY,
    "covid_data_us": FACT_KEY,
    "google_mobility_data_non_us_staging": ["location_identifier", "last_update_dt"],
    "google_mobility_data_us_staging": ["location_identifier", "last_update_dt"],
}
