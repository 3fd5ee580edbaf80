"""The shared location dimension: upsert from staging, add missing places."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.functions.columns import norm_key, null_of, to_int_rounded
from locus.operators.dml import patch_rows, upsert
from locus.operators.keys import global_row_number
from locus.schemas import LOCATION_LOOKUP

# The known data issue patched after every dimension load
# (location id -> corrected attributes).
KNOWN_FIXES: tuple[tuple[int, Mapping[str, str]], ...] = (
    (84036061, {"county_or_city": "New York City", "location_name": "New York, New York City, US"}),
)

# Added places get ids above the current maximum by this much.
NEW_LOCATION_OFFSET = 100_000_000
INT_MAX = 2**31 - 1


def staging_to_dimension(staging: DataFrame, *more: str) -> DataFrame:
    """Rename staged lookup columns to the dimension's names and types
    (``more`` columns go along)."""
    return staging.select(
        *more,
        F.col("uid").cast("int").alias("location_identifier"),
        F.col("iso2").alias("iso2_code"),
        F.col("iso3").alias("iso3_code"),
        F.col("country_region"),
        F.col("province_state").alias("province_or_state"),
        F.col("admin2").alias("county_or_city"),
        to_int_rounded("fips").alias("fips_code"),
        F.col("latitude").alias("location_latitude"),
        F.col("longitude").alias("location_longitude"),
        F.col("combined_key").alias("location_name"),
        F.col("population").alias("location_population"),
    )


def apply_known_fixes(dim: DataFrame, fixes: Sequence[tuple[int, Mapping[str, str]]] = KNOWN_FIXES) -> DataFrame:
    for loc, values in fixes:
        dim = patch_rows(dim, F.col("location_identifier") == F.lit(loc), values)
    return dim


def upsert_location_dim(
    final: DataFrame,
    staging: DataFrame,
    fixes: Sequence[tuple[int, Mapping[str, str]]] = KNOWN_FIXES,
) -> DataFrame:
    """Replace every dimension row whose id arrives in staging, insert the
    distinct staged rows, then patch the known issues over the whole table.
    Duplicate ids with different attributes are all kept (the quality gate
    reports them)."""
    merged = upsert(final.select(*LOCATION_LOOKUP.fieldNames()), staging_to_dimension(staging), ["location_identifier"])
    return apply_known_fixes(merged, fixes)


def missing_locations(
    lookup: DataFrame,
    mobility: DataFrame,
    key_offset: int = NEW_LOCATION_OFFSET,
    null_safe: bool = True,
) -> DataFrame:
    """Dimension rows for mobility places with a county name, no census code
    and no dimension match. Ids: max(id) + key_offset + rank, ranked by
    (country code, region 1, region 2) ascending, NULLs last.

    ``null_safe`` matches a NULL country code / region 1 to a NULL dimension
    value, so a re-run does not insert the same place again (with False, the
    plain '=' of the original SQL).
    """
    places = (
        mobility.filter(F.col("sub_region_2").isNotNull() & F.col("census_fips_code").isNull())
        .select("country_region_code", "country_region", "sub_region_1", "sub_region_2")
        .distinct()
    )
    # Only dimension rows with a county can match (county is a join key).
    known = lookup.filter(F.col("county_or_city").isNotNull()).select(
        F.col("iso2_code").alias("_c"),
        norm_key("country_region").alias("_r"),
        norm_key("province_or_state").alias("_p"),
        norm_key("county_or_city").alias("_s"),
    )
    p = places.select("*", norm_key("country_region").alias("_pr"), norm_key("sub_region_1").alias("_p1"),
                      norm_key("sub_region_2").alias("_p2"))
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = [
        eq(p["country_region_code"], known["_c"]),
        p["_pr"] == known["_r"],
        eq(p["_p1"], known["_p"]),
        p["_p2"] == known["_s"],
    ]
    new_places = p.join(known, cond, "left_anti").drop("_pr", "_p1", "_p2")

    # One row: the current maximum id (a missing maximum is an error, not NULL).
    top = lookup.agg(F.max("location_identifier").cast("long").alias("_max"))
    top = top.select(
        F.when(F.col("_max").isNull(), F.raise_error(F.lit("location lookup is empty"))).otherwise(F.col("_max")).alias("_max")
    )
    ranked = global_row_number(
        new_places,
        [
            F.col("country_region_code").asc_nulls_last(),
            F.col("sub_region_1").asc_nulls_last(),
            F.col("sub_region_2").asc_nulls_last(),
            F.col("country_region").asc_nulls_last(),
        ],
        name="_rank",
    )
    key = F.col("_max") + F.lit(key_offset) + F.col("_rank")
    checked = F.when(key > F.lit(INT_MAX), F.raise_error(F.lit("location identifier overflows INT"))).otherwise(key)
    return ranked.crossJoin(F.broadcast(top)).select(
        checked.cast("int").alias("location_identifier"),
        F.col("country_region_code").alias("iso2_code"),
        null_of("string").alias("iso3_code"),
        F.col("country_region"),
        F.col("sub_region_1").alias("province_or_state"),
        F.col("sub_region_2").alias("county_or_city"),
        null_of("int").alias("fips_code"),
        null_of("double").alias("location_latitude"),
        null_of("double").alias("location_longitude"),
        null_of("string").alias("location_name"),
        null_of("double").alias("location_population"),
    )


def with_missing_locations(lookup: DataFrame, mobility: DataFrame, **kw) -> DataFrame:
    """INSERT INTO lookup the rows of ``missing_locations``."""
    return lookup.select(*LOCATION_LOOKUP.fieldNames()).unionByName(missing_locations(lookup, mobility, **kw))
