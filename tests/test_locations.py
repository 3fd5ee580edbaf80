import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from locus.operators.keys import global_row_number
from locus.operators.locations import missing_locations, upsert_location_dim, with_missing_locations
from locus.operators.mobility import unmatched_mobility_places
from locus.schemas import LOCATION_LOOKUP, LOOKUP_STAGING, MOBILITY_STAGING


def lookup(spark, data):
    return spark.createDataFrame(data, LOCATION_LOOKUP)


def dim_row(i, iso2, country, prov, county, fips=None):
    return (i, iso2, None, country, prov, county, fips, None, None, None, None)


def mobility(spark, data):
    full = [(c, r, s1, s2, None, None, fips, None, *([0.0] * 6)) for c, r, s1, s2, fips in data]
    return spark.createDataFrame(full, MOBILITY_STAGING)


def test_missing_locations_keys_and_idempotence(spark):
    lk = lookup(spark, [dim_row(10, "FR", "France", "Ile", "Paris"), dim_row(20, "FR", "France", None, None)])
    mob = mobility(spark, [
        ("FR", "France", "ILE", "paris", None),  # known (case-insensitive)
        ("FR", "France", "Ile", "Lyon", None),  # new
        ("FR", "France", None, "Nice", None),  # NULL region 1: new
        ("DE", "Germany", "Bayern", "Munich", None),  # new
        ("US", "US", "Texas", "Travis", 48453.0),  # has a census code: never added
        ("FR", "France", "Ile", None, None),  # no county: never added
    ])
    new = missing_locations(lk, mob)
    got = sorted((r["location_identifier"], r["iso2_code"], r["province_or_state"], r["county_or_city"])
                 for r in new.collect())
    # ranked by (code, region 1, region 2) ascending, NULLs last; ids above max(20) + 100000000
    assert got == [(100000021, "DE", "Bayern", "Munich"), (100000022, "FR", "Ile", "Lyon"),
                   (100000023, "FR", None, "Nice")]
    again = missing_locations(with_missing_locations(lk, mob), mob)
    assert again.count() == 0  # NULL-safe match: a re-run inserts nothing
    parity = missing_locations(with_missing_locations(lk, mob), mob, null_safe=False)
    assert [r["county_or_city"] for r in parity.collect()] == ["Nice"]  # the original '=' re-inserts


def test_missing_locations_empty_lookup_and_overflow(spark):
    mob = mobility(spark, [("FR", "France", "Ile", "Lyon", None)])
    with pytest.raises(Exception, match="empty"):
        missing_locations(lookup(spark, []), mob).collect()
    near_max = lookup(spark, [dim_row(2**31 - 100, "FR", "France", None, None)])
    with pytest.raises(Exception, match="overflow"):
        missing_locations(near_max, mob).collect()


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 1000).alias("a"), (F.col("id") % 7).alias("b"),
                                     F.col("id"))
    order = [F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last(), F.col("id").asc()]
    got = global_row_number(df, order, "rn", partitions=6).select("id", "rn")
    want = df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_dimension_upsert_patches_known_issue(spark):
    old = lookup(spark, [dim_row(84036061, "US", "US", "New York", "New York"), dim_row(5, "XX", "X", None, None)])
    staging = spark.createDataFrame(
        [(84036061, "US", "USA", "840", 36061.0, "New York", "New York", "US", 1.0, 2.0, "New York, US", 9.0),
         (84036061, "US", "USA", "840", 36061.0, "New York", "New York", "US", 1.0, 2.0, "New York, US", 9.0)],
        LOOKUP_STAGING)
    out = upsert_location_dim(old, staging).orderBy("location_identifier").collect()
    assert len(out) == 2  # distinct staged row replaces the old one; id 5 kept
    ny = out[1]
    assert (ny["county_or_city"], ny["location_name"], ny["fips_code"]) == (
        "New York City", "New York, New York City, US", 36061)


def test_unmatched_places_are_counted_before_the_join(spark):
    lk = lookup(spark, [dim_row(10, "FR", "France", "Ile", "Paris"), dim_row(20, "FR", "France", None, None)])
    mob = mobility(spark, [
        *[("FR", "France", None, None, None)] * 5, *[("FR", "France", "Ile", "Paris", None)] * 3,
        *[("FR", "France", "Ile", "Lyon", None)] * 4, *[("FR", "France", "Nord", None, None)] * 2,
        ("US", "US", "Ohio", None, 39001.0), (None, "Nowhere", "a", "b", None)])
    got = unmatched_mobility_places(mob.repartition(4), lk)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("non_us", "county", "FR", "Ile", "Lyon", 4), ("non_us", "state", "FR", "Nord", None, 2),
        ("us", "county", "US", "Ohio", None, 1)], key=str)
    assert got.schema["row_count"].dataType.simpleString() == "bigint" and not got.schema["row_count"].nullable
    # what meets the dimension's keys is one row per place
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti", 1)[1].splitlines()
    assert "Aggregate" in plan[1]
