"""Level routing: one CASE per row picks the location level, one broadcast
equi-join on (level, k1, k2, k3) attaches the dimension id.

This replaces one scan + join per level with a single pass. It is exact
because the levels are disjoint by null pattern on both sides, and the level
is part of the join key, so the '' placeholder of a NULL key part can only
ever meet the placeholder of the same level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.functions.columns import level_key, norm_key
from locus.operators.dedup import dedup_latest
from locus.operators.validity import LOAD_DAY, VALIDITY, as_of

ROUTE_KEYS = ["_level", "_k1", "_k2", "_k3"]


def attach_places(routed: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with the id of their place; rows that carry their load day, against
    keys that carry validity, with that of the place as of that day."""
    joined = routed.join(keys, ROUTE_KEYS)
    return as_of(joined) if VALIDITY[0] in keys.columns else joined


def latest_routed(routed: DataFrame, keys: DataFrame, date: str, order: Sequence[str]) -> DataFrame:
    """The routed rows that can win at their place: per routing key, day and
    load day the first by ``order`` (each DESC NULLS FIRST).

    Places that share a routing key (one county name twice in a province) each
    get all of the key's rows, so that without this the join would make as many
    rows as reports times places before any dedup. All rows of a key meet the
    same places, hence only the first of a day can win at any of them. Where no
    key has two places, nothing is gained and the rows are left to the dedup."""
    ids = keys.groupBy(*ROUTE_KEYS).agg(F.min("location_identifier").alias("_min"), F.max("location_identifier").alias("_max"))
    if ids.where("_min < _max").isEmpty():
        return routed
    day = [c for c in (LOAD_DAY,) if c in routed.columns]
    used = [*day, "_scope", *ROUTE_KEYS, date, *order]
    return dedup_latest(routed.select(*used), [*day, "_scope", *ROUTE_KEYS, date], order)


def dimension_level(province: Column, county: Column) -> Column:
    """Level of a dimension row from its null pattern."""
    return (
        F.when(province.isNotNull() & county.isNotNull(), F.lit("county"))
        .when(province.isNotNull() & county.isNull(), F.lit("state"))
        .when(province.isNull() & county.isNull(), F.lit("country"))
    )


def lookup_route_keys(lookup: DataFrame, by: str, with_fips: bool = False) -> DataFrame:
    """(level, k1, k2, k3, location_identifier) for every dimension row.

    ``by`` is the country key: ``iso2_code`` (mobility) or ``country_region``
    (case reports). ``with_fips`` adds a 'fips' level keyed by the numeric
    code, whatever the row's own level. Validity days go along.
    """
    prov, county = F.col("province_or_state"), F.col("county_or_city")
    level = dimension_level(prov, county)
    validity = [c for c in VALIDITY if c in lookup.columns]
    names = lookup.select(
        "location_identifier", *validity,
        level.alias("_level"),
        norm_key(by).alias("_k1"),
        F.when(level == "country", F.lit("")).otherwise(level_key(prov)).alias("_k2"),
        F.when(level == "county", level_key(county)).otherwise(F.lit("")).alias("_k3"),
    ).filter(F.col("_level").isNotNull() & F.col("_k1").isNotNull())
    if not with_fips:
        return names
    codes = lookup.filter(F.col("fips_code").isNotNull()).select(
        "location_identifier", *validity,
        F.lit("fips").alias("_level"),
        F.col("fips_code").cast("string").alias("_k1"),
        F.lit("").alias("_k2"),
        F.lit("").alias("_k3"),
    )
    return names.unionByName(codes)


def granularity(level: Column) -> Column:
    return F.when(level == "fips", F.lit("county")).otherwise(level)
