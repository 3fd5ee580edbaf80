"""Adapter views: the driver's star-schema test tables reshaped into the
pipeline's three raw sources (lookup, case reports, mobility reports).

Every expression here has a twin in ``locus.plans.oracle`` (DuckDB SQL);
both must give equal values, so integer conversions use floor() explicitly
and names are built with concat_ws (NULL parts skipped in both engines).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.functions.columns import null_of
from locus.schemas import COVID_STAGING, LOOKUP_STAGING, MOBILITY_STAGING

# Two test provinces renamed so that the province-conditional
# correction rules have something to match; both belong to the US region.
PROVINCE_RENAMES = {"NATION_1": "Tennessee", "NATION_6": "Alaska"}
US_REGION = "AMERICA"

# Declared schemas of the driver's tables: no inference job per read.
TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


# Tables that grow with the scale factor (the others are dimensions).
LARGE_TABLES = {"orders", "lineitem"}


def spread(df: DataFrame) -> DataFrame:
    """Round-robin rebalance a scan that yields fewer partitions than there
    are cores (one unsplittable file -> one task for the whole fused
    pipeline). A large input already has many splits and is left alone, so
    no shuffle is added at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass
class Adapters:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str, *cols: str) -> DataFrame:
        reader = self.spark.read
        if name in TEST_TABLES:
            reader = reader.schema(TEST_TABLES[name])
        df = reader.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        df = df.select(*cols) if cols else df
        return spread(df) if name in LARGE_TABLES else df

    @staticmethod
    def _country(r_name):
        return F.when(r_name == US_REGION, F.lit("US")).otherwise(r_name)

    @staticmethod
    def _iso2(r_name):
        return F.when(r_name == US_REGION, F.lit("US")).otherwise(F.substring(r_name, 1, 2))

    @cached_property
    def geo(self) -> DataFrame:
        """nation x region: country name, ISO-2-like code, province name."""
        n = self.table("nation", "n_nationkey", "n_name", "n_regionkey")
        r = self.table("region", "r_regionkey", "r_name")
        province = F.col("n_name")
        expr = None
        for src, dst in PROVINCE_RENAMES.items():
            expr = (F.when if expr is None else expr.when)(F.col("n_name") == src, F.lit(dst))
        province = expr.otherwise(F.col("n_name"))
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            "n_nationkey",
            self._country(F.col("r_name")).alias("country_region"),
            self._iso2(F.col("r_name")).alias("iso2"),
            province.alias("province"),
        )

    @cached_property
    def location_lookup_staging(self) -> DataFrame:
        """5 country rows (regions), 25 state rows (nations), one county row
        per customer."""
        r = self.table("region", "r_regionkey", "r_name")
        countries = r.select(
            (F.col("r_regionkey") + 1).cast("int").alias("uid"),
            self._iso2(F.col("r_name")).alias("iso2"),
            null_of("string").alias("iso3"),
            null_of("string").alias("code3"),
            null_of("double").alias("fips"),
            null_of("string").alias("admin2"),
            null_of("string").alias("province_state"),
            self._country(F.col("r_name")).alias("country_region"),
            F.lit(0.0).alias("latitude"),
            F.lit(0.0).alias("longitude"),
            self._country(F.col("r_name")).alias("combined_key"),
            F.lit(1000000.0).alias("population"),
        )
        g = self.geo
        states = g.select(
            (F.col("n_nationkey") + 1000).cast("int").alias("uid"),
            "iso2",
            null_of("string").alias("iso3"),
            null_of("string").alias("code3"),
            null_of("double").alias("fips"),
            null_of("string").alias("admin2"),
            F.col("province").alias("province_state"),
            "country_region",
            F.lit(0.0).alias("latitude"),
            F.lit(0.0).alias("longitude"),
            F.concat_ws(", ", "province", "country_region").alias("combined_key"),
            (F.col("n_nationkey") + 50000).cast("double").alias("population"),
        )
        c = self.table("customer", "c_custkey", "c_name", "c_nationkey")
        counties = c.join(g, c.c_nationkey == g.n_nationkey).select(
            (F.col("c_custkey") + 100000).cast("int").alias("uid"),
            "iso2",
            null_of("string").alias("iso3"),
            null_of("string").alias("code3"),
            F.when(F.col("country_region") == "US", (F.col("c_custkey") + 10000).cast("double")).alias("fips"),
            F.col("c_name").alias("admin2"),
            F.col("province").alias("province_state"),
            "country_region",
            F.lit(0.0).alias("latitude"),
            F.lit(0.0).alias("longitude"),
            F.concat_ws(", ", "c_name", "province", "country_region").alias("combined_key"),
            (F.col("c_custkey") + 1000).cast("double").alias("population"),
        )
        return countries.unionByName(states).unionByName(counties).select(*LOOKUP_STAGING.fieldNames())

    @cached_property
    def covid_data_staging(self) -> DataFrame:
        """One case report per order; month of the order date is the file
        date, so several reports share a (location, file_date) key."""
        o = self.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                       "o_orderpriority")
        c = self.table("customer", "c_custkey", "c_name", "c_nationkey")
        rows = o.join(c, o.o_custkey == c.c_custkey).join(self.geo, F.col("c_nationkey") == F.col("n_nationkey"))
        prio = F.col("o_orderpriority")
        admin2 = F.when(~prio.isin("1-URGENT", "2-HIGH"), F.col("c_name"))
        province = F.when(prio != "1-URGENT", F.upper("province"))
        price = F.col("o_totalprice")
        return rows.select(
            F.when(F.col("country_region") == "US", (F.col("c_custkey") + 10000).cast("string")).alias("fips"),
            admin2.alias("admin2"),
            province.alias("province_state"),
            F.col("country_region"),
            F.col("o_orderdate").alias("last_update_dts"),
            F.lit(0.0).alias("latitude"),
            F.lit(0.0).alias("longitude"),
            F.floor(price).cast("long").alias("confirmed"),
            F.col("o_orderkey").alias("deaths"),
            F.when(F.col("o_orderstatus") != "P", F.floor(price / 3).cast("long")).alias("recovered"),
            F.floor(price / 2).cast("double").alias("active"),
            F.concat_ws(", ", admin2, province, F.col("country_region")).alias("combined_key"),
            (price / 7).alias("incident_rate"),
            (price / 11).alias("case_fatality_ratio"),
            F.trunc(F.to_date("o_orderdate"), "month").alias("file_date"),
        ).select(*COVID_STAGING.fieldNames())

    @cached_property
    def google_mobility_data_staging(self) -> DataFrame:
        """One mobility report per line item; line numbers choose the region
        depth, supplier names give counties unknown to the lookup."""
        li = self.table("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
        o = self.table("orders", "o_orderkey", "o_custkey")
        c = self.table("customer", "c_custkey", "c_name", "c_nationkey")
        s = self.table("supplier", "s_suppkey", "s_name")
        # a report's place comes with its order, so that the line items, many to an
        # order, meet it once and are not shuffled again for a large customer table
        placed = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(
            self.geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "o_orderkey", "c_custkey", "c_name", "country_region", "iso2", "province")
        rows = li.join(placed, li.l_orderkey == F.col("o_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        ln = F.col("l_linenumber")
        return rows.select(
            F.col("iso2").alias("country_region_code"),
            F.col("country_region"),
            F.when(ln != 1, F.col("province")).alias("sub_region_1"),
            F.when(ln.between(3, 5), F.col("c_name")).when(ln >= 6, F.col("s_name")).alias("sub_region_2"),
            # column derivations (no row is filtered): a few metro / ISO rows
            F.when(F.col("l_partkey") % 97 == 0, F.lit("metro")).alias("metro_area"),
            F.when(F.col("l_partkey") % 89 == 0, F.lit("X")).alias("iso_3166_2_code"),
            F.when((F.col("country_region") == "US") & ln.between(3, 5),
                   (F.col("c_custkey") + 10000).cast("double")).alias("census_fips_code"),
            F.to_date("l_shipdate").alias("date"),
            F.col("l_quantity").alias("retail_and_recreation_percent_change_from_baseline"),
            F.col("l_extendedprice").alias("grocery_and_pharmacy_percent_change_from_baseline"),
            F.col("l_discount").alias("parks_percent_change_from_baseline"),
            F.col("l_tax").alias("transit_stations_percent_change_from_baseline"),
            F.col("l_partkey").cast("double").alias("workplaces_percent_change_from_baseline"),
            F.col("l_suppkey").cast("double").alias("residential_percent_change_from_baseline"),
        ).select(*MOBILITY_STAGING.fieldNames())
