"""Case reports: conform to the location dimension, dedup, upsert, deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.functions.columns import level_key, norm_key, null_of
from locus.operators.dedup import dedup_latest, latest_load
from locus.operators.deltas import daily_deltas, refresh_deltas
from locus.operators.dml import upsert
from locus.operators.routing import attach_places, latest_routed, lookup_route_keys
from locus.operators.validity import LOAD_DAY
from locus.schemas import COVID_FACT, FACT_KEY
from locus.session import materialize

SCOPES = ("us", "non_us")

# Latest report first; the last three columns only break remaining ties.
COVID_DEDUP_ORDER = [
    "last_update_dts",
    "confirmed",
    "deaths",
    "recovered",
    "active",
    "incident_rate",
    "case_fatality_ratio",
]


def route_covid(covid: DataFrame, exclude_us_country: bool = False) -> DataFrame:
    """Level and scope per case-report row.

    country (no province, no county) -> non-US fact, US included (as in the
    original; ``exclude_us_country`` leaves that row out);
    state (province, no county) -> US or non-US fact by country = 'US';
    county (province and county) -> US fact only, non-US counties dropped.
    """
    country, prov, county = F.col("country_region"), F.col("province_state"), F.col("admin2")
    level = (
        F.when(prov.isNull() & county.isNull(), F.lit("country"))
        .when(prov.isNotNull() & county.isNull(), F.lit("state"))
        .when(prov.isNotNull() & county.isNotNull() & (country == "US"), F.lit("county"))
    )
    scope = (
        F.when((level == "country") & (F.lit(not exclude_us_country) | (country != "US")), F.lit("non_us"))
        .when(level == "county", F.lit("us"))
        .when((level == "state") & (country == "US"), F.lit("us"))
        .when((level == "state") & (country != "US"), F.lit("non_us"))
    )
    return covid.select("*", level.alias("_level"), scope.alias("_scope")).select(
        "*",
        norm_key(country).alias("_k1"),
        F.when(F.col("_level") == "country", F.lit("")).otherwise(level_key(prov)).alias("_k2"),
        F.when(F.col("_level") == "county", level_key(county)).otherwise(F.lit("")).alias("_k3"),
    )


def covid_batch(covid: DataFrame, lookup: DataFrame, exclude_us_country: bool = False) -> DataFrame:
    """Conformed, de-duplicated fact rows of one batch for both scopes
    (column ``_scope``; deltas still NULL): one scan, one join, one dedup.

    Dedup is per (granularity, location, file_date), i.e. per level branch.
    Rows that carry their load day are the batches of several days at once: a
    place is that of the day, and a later day's rows replace an earlier day's.
    """
    routed = route_covid(covid, exclude_us_country).filter(F.col("_scope").isNotNull() & F.col("_level").isNotNull())
    day = [LOAD_DAY] if LOAD_DAY in covid.columns else []
    places = lookup_route_keys(lookup, "country_region")
    rows = attach_places(latest_routed(routed, places, "file_date", COVID_DEDUP_ORDER), places).select(
        *day,
        "_scope",
        "location_identifier",
        "file_date",
        F.col("_level").alias("location_granularity"),
        *COVID_DEDUP_ORDER,
    )
    keys = ["_scope", "location_granularity", "location_identifier", "file_date"]
    latest = dedup_latest(rows, keys, [*day, *COVID_DEDUP_ORDER])
    if day:
        latest = latest_load(latest, ["_scope", "location_identifier", "file_date"], LOAD_DAY)
    return latest.select(
        "_scope",
        "location_identifier",
        "file_date",
        F.col("confirmed").alias("ttl_confirmed_cases"),
        F.col("deaths").alias("ttl_deaths"),
        F.bround("active").cast("long").alias("ttl_active_cases"),
        F.col("recovered").alias("ttl_recovered_cases"),
        "incident_rate",
        "case_fatality_ratio",
        null_of("int").alias("new_confirmed_cases"),
        null_of("int").alias("new_deaths"),
        null_of("int").alias("new_recoveries"),
        "location_granularity",
    )


def conform_covid(covid: DataFrame, lookup: DataFrame, scope: str) -> DataFrame:
    """One scope's rows of ``covid_batch``, in fact shape."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    return covid_batch(covid, lookup).filter(F.col("_scope") == scope).drop("_scope")


def upsert_covid_fact(final: DataFrame, batch: DataFrame, deltas: str = "full") -> DataFrame:
    """Keyed upsert of a conformed batch (a written table: it is used twice
    and more), then daily deltas.

    ``deltas='full'`` recomputes every location (original behaviour);
    ``'touched'`` only the locations present in the batch (same result when
    ``final`` already carries correct deltas).
    """
    # After the dedup the rows are unique (the dedup keys are columns), so the
    # INSERT's DISTINCT is a no-op; an anti join needs no distinct keys.
    merged = upsert(final.select(*COVID_FACT.fieldNames()), batch, FACT_KEY, unique_keys=True)
    if deltas == "full":
        return daily_deltas(merged)
    if deltas == "touched":
        return refresh_deltas(merged, batch.select("location_identifier", "file_date"))
    raise ValueError("deltas must be 'full' or 'touched'")


def load_covid_fact(
    final: DataFrame,
    covid: DataFrame,
    lookup: DataFrame,
    scope: str,
    deltas: str = "full",
) -> DataFrame:
    """conform -> dedup -> keyed upsert -> daily deltas, for one scope."""
    batch = materialize(conform_covid(covid, lookup, scope), f"covid_batch_{scope}")
    return upsert_covid_fact(final, batch, deltas)
