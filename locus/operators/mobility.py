"""Mobility reports: conform to the location dimension, dedup, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.functions.columns import level_key, norm_key, to_int_rounded
from locus.operators.dedup import dedup_latest
from locus.operators.dml import upsert
from locus.operators.routing import ROUTE_KEYS, attach_places, granularity, latest_routed, lookup_route_keys
from locus.operators.validity import LOAD_DAY
from locus.schemas import FACT_KEY, MOBILITY_FACT, MOBILITY_MEASURES
from locus.session import materialize

SCOPES = ("us", "non_us")


def route_mobility(mobility: DataFrame) -> DataFrame:
    """Add _scope, _level and the routing key parts to each mobility row.

    US: a census code routes by code alone ('fips'); else state / country.
    Non-US: county / state / country by the null pattern of the regions.
    Metro-area rows and (outside 'fips') census-coded rows route nowhere; the
    ISO 3166-2 code must be absent for non-US county and country rows.
    """
    code = F.col("country_region_code")
    sub1, sub2 = F.col("sub_region_1"), F.col("sub_region_2")
    metro, iso, census = F.col("metro_area"), F.col("iso_3166_2_code"), F.col("census_fips_code")
    plain = metro.isNull() & census.isNull()
    us_level = (
        F.when(census.isNotNull(), F.lit("fips"))
        .when(plain & sub1.isNotNull() & sub2.isNull(), F.lit("state"))
        .when(plain & sub1.isNull() & sub2.isNull(), F.lit("country"))
    )
    non_us_level = (
        F.when(plain & sub1.isNotNull() & sub2.isNotNull() & iso.isNull(), F.lit("county"))
        .when(plain & sub1.isNotNull() & sub2.isNull(), F.lit("state"))
        .when(plain & sub1.isNull() & sub2.isNull() & iso.isNull(), F.lit("country"))
    )
    level = F.when(code == "US", us_level).when(code != "US", non_us_level)
    return mobility.select(
        "*",
        F.when(code == "US", F.lit("us")).when(code != "US", F.lit("non_us")).alias("_scope"),
        level.alias("_level"),
    ).select(
        "*",
        F.when(F.col("_level") == "fips", to_int_rounded(census).cast("string"))
        .otherwise(norm_key(code))
        .alias("_k1"),
        F.when(F.col("_level").isin("county", "state"), level_key(sub1)).otherwise(F.lit("")).alias("_k2"),
        F.when(F.col("_level") == "county", level_key(sub2)).otherwise(F.lit("")).alias("_k3"),
    )


def conform_mobility_all(mobility: DataFrame, lookup: DataFrame) -> DataFrame:
    """Attach location id and granularity, both scopes at once (column
    ``_scope``): one scan, one equi-join on the routing keys. Census codes
    route US rows only, so one key table serves both scopes. A load day goes
    along."""
    return _placed(_routed(mobility), lookup_route_keys(lookup, "iso2_code", with_fips=True))


def _routed(mobility: DataFrame) -> DataFrame:
    return route_mobility(mobility).filter(F.col("_scope").isNotNull() & F.col("_level").isNotNull())


def _placed(routed: DataFrame, keys: DataFrame) -> DataFrame:
    return attach_places(routed, keys).select(
        *[c for c in (LOAD_DAY,) if c in routed.columns],
        "_scope",
        "location_identifier",
        F.col("date").alias("last_update_dt"),
        *MOBILITY_MEASURES,
        granularity(F.col("_level")).alias("location_granularity"),
    )


def conform_mobility(mobility: DataFrame, lookup: DataFrame, scope: str, distinct: bool = True) -> DataFrame:
    """One scope's conformed rows (secondary staging table)."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    out = conform_mobility_all(mobility, lookup).filter(F.col("_scope") == scope).drop("_scope")
    return out.distinct() if distinct else out


def distinct_routed(mobility: DataFrame) -> DataFrame:
    """What the places of a routing key get of its reports, each row once: a
    few reports instead of reports times places go through the DISTINCT."""
    return _routed(mobility).select("_scope", *ROUTE_KEYS, "date", *MOBILITY_MEASURES).distinct()


def place_routed(routed: DataFrame, lookup: DataFrame, scope: str) -> DataFrame:
    """One scope's conformed rows of ``distinct_routed``, distinct for a lookup
    whose ids are unique: a place has one routing key of a level in each scope."""
    keys = lookup_route_keys(lookup, "iso2_code", with_fips=True)
    return _placed(routed.filter(F.col("_scope") == scope), keys).drop("_scope")


# Winner among rows of one (location, day): the declared order is constant
# inside the partition, so granularity and the measures break the tie.
MOBILITY_DEDUP_ORDER = ["last_update_dt", "location_granularity", *MOBILITY_MEASURES]


def latest_mobility(conformed: DataFrame) -> DataFrame:
    """Conformed rows -> one row per location and day, in fact shape (with
    ``_scope`` if they carry it). Of several load days the last wins."""
    scope = [c for c in ("_scope",) if c in conformed.columns]
    day = [c for c in (LOAD_DAY,) if c in conformed.columns]
    latest = dedup_latest(conformed, [*scope, "location_identifier", "last_update_dt"], [*day, *MOBILITY_DEDUP_ORDER])
    return latest.withColumnRenamed("last_update_dt", "file_date").select(*scope, *MOBILITY_FACT.fieldNames())


def latest_mobility_all(mobility: DataFrame, lookup: DataFrame) -> DataFrame:
    """``latest_mobility`` of ``conform_mobility_all``, without the rows of all
    reports at each of the places that share a name."""
    keys = lookup_route_keys(lookup, "iso2_code", with_fips=True)
    return latest_mobility(_placed(latest_routed(_routed(mobility), keys, "date", MOBILITY_MEASURES), keys))


def mobility_batch(mobility: DataFrame, lookup: DataFrame, scope: str) -> DataFrame:
    """Conformed, de-duplicated rows of one batch, in fact-table shape."""
    # DISTINCT before the dedup would not change the winner: skip that shuffle.
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    keys = lookup_route_keys(lookup, "iso2_code", with_fips=True)
    routed = latest_routed(_routed(mobility).filter(F.col("_scope") == scope), keys, "date", MOBILITY_MEASURES)
    return latest_mobility(_placed(routed, keys).drop("_scope"))


def load_mobility_fact(final: DataFrame, mobility: DataFrame, lookup: DataFrame, scope: str) -> DataFrame:
    """conform -> dedup -> keyed upsert into the fact (location, file_date).

    The batch feeds both the upsert's key set and the inserted rows, so it is
    written once to the shared folder.
    """
    batch = materialize(mobility_batch(mobility, lookup, scope), f"mobility_batch_{scope}")
    # one row per (location, day) after the dedup: skip the DISTINCT shuffles
    return upsert(final.select(*MOBILITY_FACT.fieldNames()), batch, FACT_KEY, unique_keys=True)


def unmatched_mobility_places(mobility: DataFrame, lookup: DataFrame) -> DataFrame:
    """Routed mobility places that no dimension row matches (they vanish
    from the facts silently); one row per place with its row count.

    Rows are counted per place before the join, map-side first: neither the
    reports of a large place nor their measures meet in one task."""
    routed = route_mobility(mobility).filter(F.col("_level").isNotNull())
    place = ["country_region_code", "sub_region_1", "sub_region_2"]
    places = routed.groupBy("_scope", *ROUTE_KEYS, *place).agg(F.count(F.lit(1)).alias("_rows"))
    keys = lookup_route_keys(lookup, "iso2_code", with_fips=True).select(*ROUTE_KEYS).distinct()
    missing = places.join(keys, ROUTE_KEYS, "left_anti")
    return missing.groupBy(
        F.col("_scope").alias("scope"), granularity(F.col("_level")).alias("location_granularity"), *place,
    ).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"))
