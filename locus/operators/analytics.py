"""Analytics over the conformed facts: table stats, top-N, incident rate,
mobility averages and the case-versus-mobility trend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.operators.dedup import dedup_latest
from locus.schemas import FACT_KEY, MOBILITY_MEASURES

ROUND = 6  # doubles are compared at 6 decimals (summation order varies)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- A1-A3: table statistics --------------------------------------------------

def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table (one aggregate per table, one job)."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("count_of_records")).select(F.lit(name).alias("table_name"), "count_of_records")
        for name, df in sorted(tables.items())
    ])


def distinct_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct primary keys per table (rows with a NULL key part skipped)."""
    return _union([
        df.agg(F.count_distinct(*[F.col(k) for k in keys[name]]).alias("count_of_distinct_primary_key"))
        .select(F.lit(name).alias("table_name"), "count_of_distinct_primary_key")
        for name, df in sorted(tables.items())
    ])


def latest_dates(tables: Mapping[str, DataFrame], date_col: str = "file_date") -> DataFrame:
    """Most recent date per fact table (tables without the column skipped)."""
    return _union([
        df.agg(F.max(date_col).alias("max_file_date")).select(F.lit(name).alias("table_name"), "max_file_date")
        for name, df in sorted(tables.items())
        if date_col in df.columns
    ])


# -- A4-A5: top-N ---------------------------------------------------------------

def _labelled(fact: DataFrame, lookup: DataFrame, granularity: str, cols: Sequence[str]) -> DataFrame:
    dim = lookup.select("location_identifier", *cols)
    return fact.filter(F.col("location_granularity") == granularity).join(dim, "location_identifier", "left")


def top_countries(covid_non_us: DataFrame, lookup: DataFrame, n: int = 5) -> DataFrame:
    """Countries with the most new confirmed cases (country-level rows).

    orderBy + limit plans as TakeOrderedAndProject: every task keeps its
    own top n, no global sort. Ties break on the name.
    """
    return (
        _labelled(covid_non_us, lookup, "country", ["country_region"])
        .groupBy(F.col("country_region").alias("country"))
        .agg(F.sum("new_confirmed_cases").alias("total_cases"))
        .orderBy(F.col("total_cases").desc_nulls_first(), F.col("country").asc_nulls_last())
        .limit(n)
    )


def top_us_counties(covid_us: DataFrame, lookup: DataFrame, n: int = 10) -> DataFrame:
    """US counties with the most new confirmed cases."""
    return (
        _labelled(covid_us, lookup, "county", ["county_or_city", "province_or_state", "country_region"])
        .groupBy("county_or_city", "province_or_state", "country_region")
        .agg(F.sum("new_confirmed_cases").alias("ttl_confirmed_cases"))
        .select(F.col("county_or_city").alias("county"), F.col("province_or_state").alias("state"),
                "ttl_confirmed_cases")
        .orderBy(F.col("ttl_confirmed_cases").desc_nulls_first(), F.col("county").asc_nulls_last(),
                 F.col("state").asc_nulls_last())
        .limit(n)
    )


# -- A6-A10: incident rate and mobility -----------------------------------------

def _latest_cumulative(fact: DataFrame, granularity: str) -> DataFrame:
    rows = fact.filter(F.col("location_granularity") == granularity).select(
        "location_identifier", "file_date", "ttl_confirmed_cases")
    # latest row per location, as a partial+final aggregate (skew safe)
    return dedup_latest(rows, ["location_identifier"], ["file_date"])


def incident_rate(fact: DataFrame, lookup: DataFrame, granularity: str, name_col: str) -> DataFrame:
    """Latest cumulative confirmed / population x 100 per location; a zero
    or missing population gives NULL."""
    dim = lookup.select("location_identifier", name_col, "location_population")
    return _latest_cumulative(fact, granularity).join(dim, "location_identifier", "left").select(
        F.col(name_col).alias("state" if name_col == "province_or_state" else "country"),
        "location_identifier",
        F.col("file_date").alias("latest_file_date"),
        "ttl_confirmed_cases",
        F.col("location_population").alias("population"),
        F.round(F.try_divide(F.col("ttl_confirmed_cases").cast("double"), F.col("location_population")) * 100,
                ROUND).alias("incident_rate_pct"),
    )


def incident_rate_by_state(covid_us: DataFrame, lookup: DataFrame) -> DataFrame:
    return incident_rate(covid_us, lookup, "state", "province_or_state")


def incident_rate_extremes(rates: DataFrame, n: int = 5, name_col: str = "state") -> DataFrame:
    """Top n and bottom n locations by incident rate, tagged with side and
    rank. Each side is a bounded top-k; only its n rows are numbered."""
    rated = rates.filter(F.col("incident_rate_pct").isNotNull())

    def side(tag: str, rate_order) -> DataFrame:
        order = [rate_order, F.col(name_col).asc_nulls_last(), F.col("location_identifier").asc()]
        top = rated.orderBy(*order).limit(n)
        return top.select(
            F.lit(tag).alias("side"),
            F.row_number().over(Window.partitionBy(F.lit(tag)).orderBy(*order)).alias("rank"),
            name_col,
            "location_identifier",
            "incident_rate_pct",
        )

    return side("top", F.col("incident_rate_pct").desc()).unionByName(
        side("bottom", F.col("incident_rate_pct").asc()))


def avg_mobility(mobility: DataFrame, lookup: DataFrame, granularity: str, name_col: str,
                 names: Sequence[str] | None = None) -> DataFrame:
    """Average change from baseline of each measure per location."""
    dim = lookup.select("location_identifier", name_col)
    avgs = (
        mobility.filter(F.col("location_granularity") == granularity)
        .groupBy("location_identifier")
        .agg(*[F.round(F.avg(m), ROUND).alias(f"avg_{m}") for m in MOBILITY_MEASURES],
             F.count(F.lit(1)).alias("days"))
    )
    out = avgs.join(dim, "location_identifier", "left").withColumnRenamed(
        name_col, "state" if name_col == "province_or_state" else "country")
    if names is not None:
        out = out.filter(F.col(out.columns[-1]).isin(list(names)))
    return out


def avg_mobility_by_state(mobility_us: DataFrame, lookup: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    return avg_mobility(mobility_us, lookup, "state", "province_or_state", states)


def parks_vs_incident(covid_us: DataFrame, mobility_us: DataFrame, lookup: DataFrame) -> DataFrame:
    """Average parks change against incident rate, per US state."""
    rates = incident_rate_by_state(covid_us, lookup).select("location_identifier", "state", "incident_rate_pct")
    parks = avg_mobility_by_state(mobility_us, lookup).select(
        "location_identifier", "avg_parks_percent_change_from_baseline")
    return rates.join(parks, "location_identifier", "inner")


def country_profile(covid_non_us: DataFrame, mobility_non_us: DataFrame, lookup: DataFrame) -> DataFrame:
    """Incident rate and mobility averages per country (non-US facts)."""
    rates = incident_rate(covid_non_us, lookup, "country", "country_region")
    mob = avg_mobility(mobility_non_us, lookup, "country", "country_region").drop("country")
    return rates.join(mob, "location_identifier", "left")


def covid_mobility_trend(covid: DataFrame, mobility: DataFrame) -> DataFrame:
    """Cases and mobility of one location and day side by side (fact-to-fact
    equi-join on the shared key; AQE splits a hot location)."""
    c = covid.select(*FACT_KEY, "location_granularity", "ttl_confirmed_cases", "new_confirmed_cases")
    m = mobility.select(*FACT_KEY, *MOBILITY_MEASURES)
    return c.join(m, FACT_KEY, "inner")


def covid_mobility_trend_colocated(covid: Sequence[DataFrame], mobility: Sequence[DataFrame]) -> DataFrame:
    """``covid_mobility_trend`` of facts in several tables that are bucketed
    alike by location (read in a ``colocated_session``): every pair of tables
    joins bucket by bucket, since a union would lose the buckets. No fact is
    shuffled; each is scanned once per table of the other kind."""
    pairs = [covid_mobility_trend(c, m) for c in covid for m in mobility]
    return reduce(DataFrame.unionByName, pairs)
