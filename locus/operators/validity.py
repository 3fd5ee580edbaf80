"""Dimension rows with the days on which they hold, and as-of joins on them.

A load of one day sees the dimension as that day's lookup file leaves it. With
a validity interval on every dimension row, the rows of many days find the
place they would have found on their day by one equi-join with a range test,
so many days are one job. A row's interval starts at the first of consecutive
days that bring it unchanged, so a place has as many versions as it has
changes, not as there are days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.functions.columns import norm_key, null_of
from locus.operators.keys import global_row_number
from locus.operators.locations import INT_MAX, NEW_LOCATION_OFFSET, apply_known_fixes, staging_to_dimension
from locus.schemas import LOCATION_LOOKUP

#: The day whose file a row came in.
LOAD_DAY = "_load_day"
VALIDITY = ["valid_from", "valid_to"]  # the second day is exclusive
ALWAYS, NEVER = dt.date(1000, 1, 1), dt.date(9999, 12, 31)
DIMENSION = LOCATION_LOOKUP.fieldNames()


def as_of(joined: DataFrame) -> DataFrame:
    """Of an equi-join of dated rows with versions, the version of the row's day."""
    day = F.col(LOAD_DAY)
    return joined.where((F.col("valid_from") <= day) & (day < F.col("valid_to"))).drop(*VALIDITY)


def staged_versions(staging: DataFrame) -> DataFrame:
    """Distinct dimension rows per day of lookup files (with ``LOAD_DAY``)."""
    return staging_to_dimension(staging, LOAD_DAY).distinct()


def dimension_versions(final: DataFrame, staging: DataFrame) -> DataFrame:
    """All dimension rows that daily upserts of ``staging`` give in turn: those
    of ``final`` until a file brings their id, a file's until the next file
    with the id. Rows without an id replace nothing and stay."""
    dated = staging_to_dimension(staging, LOAD_DAY)
    no_id = F.col("location_identifier").isNull()
    # rows meet by id once: all that follows keeps an id's rows together
    rows = dated.where(~no_id).repartition("location_identifier").distinct()
    by_id = Window.partitionBy("location_identifier")
    later = by_id.orderBy(F.unix_date(LOAD_DAY).desc()).rangeBetween(Window.unboundedPreceding, -1)
    brought = rows.select("*", F.dense_rank().over(by_id.orderBy(LOAD_DAY)).alias("_nth"),
                          F.min(LOAD_DAY).over(later).alias("_next"))
    # consecutive days that bring a row unchanged are one version of it
    same_row = Window.partitionBy(*DIMENSION).orderBy("_nth")
    brought = brought.withColumn("_run", F.col("_nth") - F.row_number().over(same_row))
    new = brought.groupBy(*DIMENSION, "_run").agg(
        F.min(LOAD_DAY).alias("valid_from"), F.max(F.coalesce("_next", F.lit(NEVER))).alias("valid_to")).drop("_run")
    loose = dated.where(no_id).distinct().select(*DIMENSION, F.col(LOAD_DAY).alias("valid_from"),
                                                 F.lit(NEVER).alias("valid_to"))
    ends = dated.where(~no_id).groupBy("location_identifier").agg(F.min(LOAD_DAY).alias("_end"))
    old = final.select(*DIMENSION).join(ends, "location_identifier", "left").select(
        *DIMENSION, F.lit(ALWAYS).alias("valid_from"), F.coalesce("_end", F.lit(NEVER)).alias("valid_to"))
    return apply_known_fixes(old.unionByName(new).unionByName(loose))


def new_places_by_day(versions: DataFrame, mobility: DataFrame) -> DataFrame:
    """The mobility places that each day's load would add to the dimension: a
    place is added on the first day on which no version of that day matches
    it, and known from then on. Places without a country name match nothing
    and are added every day, as daily loads add them."""
    places = mobility.filter(F.col("sub_region_2").isNotNull() & F.col("census_fips_code").isNull()).select(
        LOAD_DAY, "country_region_code", "country_region", "sub_region_1", "sub_region_2").distinct()
    p = places.select("*", norm_key("country_region").alias("_region"), norm_key("sub_region_1").alias("_sub1"),
                      norm_key("sub_region_2").alias("_sub2"))
    known = versions.filter(F.col("county_or_city").isNotNull()).select(
        F.col("iso2_code").alias("_code"), norm_key("country_region").alias("_country"),
        norm_key("province_or_state").alias("_province"), norm_key("county_or_city").alias("_county"), *VALIDITY)
    unmatched = p.join(known, [
        p["country_region_code"].eqNullSafe(known["_code"]), p["_region"] == known["_country"],
        p["_sub1"].eqNullSafe(known["_province"]), p["_sub2"] == known["_county"],
        known["valid_from"] <= p[LOAD_DAY], p[LOAD_DAY] < known["valid_to"]], "left_anti")
    first = F.min(LOAD_DAY).over(Window.partitionBy("country_region_code", "_region", "_sub1", "_sub2"))
    return unmatched.withColumn("_first", first).where(
        F.col("_region").isNull() | (F.col(LOAD_DAY) == F.col("_first"))).drop("_region", "_sub1", "_sub2", "_first")


def added_versions(final: DataFrame, versions: DataFrame, staging: DataFrame, mobility: DataFrame,
                   key_offset: int = NEW_LOCATION_OFFSET) -> DataFrame:
    """Dimension rows of new places, with the ids that daily loads would give:
    each day's follow from the largest id as of that day.

    Only a few numbers per day come to the driver (largest id, new places)."""
    order = [F.col(LOAD_DAY).asc(), *[F.col(c).asc_nulls_last() for c in (
        "country_region_code", "sub_region_1", "sub_region_2", "country_region")]]
    ranked = global_row_number(new_places_by_day(versions, mobility), order, name="_rank")
    counts = {r[0]: r[1] for r in ranked.groupBy(LOAD_DAY).count().collect()}
    tops = {r[0]: r[1] for r in staging.groupBy(LOAD_DAY).agg(F.max(F.col("uid").cast("long"))).collect()}
    largest = final.agg(F.max("location_identifier")).first()[0]
    bases = _bases(counts, tops, largest, key_offset)
    spark = versions.sparkSession
    offset = spark.createDataFrame(sorted(bases.items()), f"{LOAD_DAY} date, _base long")
    key = F.col("_base") + F.col("_rank")
    checked = F.when(key > F.lit(INT_MAX), F.raise_error(F.lit("location identifier overflows INT"))).otherwise(key)
    return ranked.join(F.broadcast(offset), LOAD_DAY).select(  # one row a day
        checked.cast("int").alias("location_identifier"),
        F.col("country_region_code").alias("iso2_code"), null_of("string").alias("iso3_code"), "country_region",
        F.col("sub_region_1").alias("province_or_state"), F.col("sub_region_2").alias("county_or_city"),
        null_of("int").alias("fips_code"), null_of("double").alias("location_latitude"),
        null_of("double").alias("location_longitude"), null_of("string").alias("location_name"),
        null_of("double").alias("location_population"),
        F.col(LOAD_DAY).alias("valid_from"), F.lit(NEVER).alias("valid_to"))


def _bases(counts: Mapping[dt.date, int], tops: Mapping[dt.date, int | None], largest: int | None,
           key_offset: int) -> dict[dt.date, int]:
    """Per day with new places what to add to a place's rank over all days."""
    out, before = {}, 0
    for day in sorted({*counts, *tops}):
        known = [x for x in (largest, tops.get(day)) if x is not None]
        largest = max(known) if known else None
        n = counts.get(day, 0)
        if n:
            if largest is None:
                raise ValueError("location lookup is empty")
            out[day] = largest + key_offset - before
            largest += key_offset + n
            before += n
    return out
