"""A backfill as one load against day-by-day loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from locus.operators.validity import ALWAYS, LOAD_DAY, NEVER, _bases, dimension_versions
from locus.plans.jobs import LOOKUP_SOURCE_HEADER, SourceTemplates, run_backfill, run_backfill_bulk
from locus.plans.scenario import Scenario
from locus.schemas import FINAL_TABLES, LOCATION_LOOKUP
from locus.sources.tables import TableStore
from locus.sources.writers import land_json, land_psv

DAY = [dt.date(2021, 3, d) for d in range(1, 31)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def templates(root):
    return SourceTemplates(*[f"{root}/{n} {{file_date}}" for n in ("covid", "lookup", "mobility")])


def land(s, root, days):
    """Per day the reports and mobility of a stretch (with the day before's
    rows again, measures changed), and a lookup whose rows come, change, move
    to another level and stay away from day to day."""
    from locus.plans.catalog import _normalized

    reports, mob = _normalized(s), s.mobility_staging
    for i, day in enumerate(days):
        at = F.pmod(F.floor(F.datediff(F.to_date("file_date", "MM-dd-yyyy"), F.lit("1992-01-01")) / 30), F.lit(len(days)))
        mob_at = F.pmod(F.floor(F.datediff("date", F.lit("1992-01-01")) / 30), F.lit(len(days)))
        name = day.strftime("%m-%d-%Y")
        land_json(reports.filter(at.isin(i, (i - 1) % len(days))).withColumn("Deaths", F.col("Deaths") + i),
                  f"{root}/covid {name}")
        lookup = s.lookup_staging.withColumn("population", F.col("population") + F.lit(i // 2)).filter(
            (F.col("uid") < 100000) | (F.pmod("uid", F.lit(len(days) + 1)) <= i)).withColumn(
            "admin2", F.when((F.col("uid") == 1001) & F.lit(i % 2 == 1), F.lit("Moved")).otherwise(F.col("admin2")))
        land_psv(lookup.toDF(*LOOKUP_SOURCE_HEADER), f"{root}/lookup {name}")
        land_psv(mob.filter(mob_at.isin(i, (i - 1) % len(days))).withColumn(
            "residential_percent_change_from_baseline", F.col("residential_percent_change_from_baseline") + i),
            f"{root}/mobility {name}")
    return templates(root)


@pytest.fixture(scope="module")
def s(spark):
    return Scenario(spark, "/root/testdata/sf0.001")


def test_bulk_equals_day_by_day(spark, s, tmp_dir):
    days = DAY[:3]
    where = land(s, tmp_dir, days)
    one, bulk = (TableStore(spark, f"{tmp_dir}/{n}") for n in ("one", "bulk"))
    run_backfill(spark, one, days, where, key_offset=1000)
    run_backfill_bulk(spark, bulk, reversed(days), where, key_offset=1000)
    for table in FINAL_TABLES:
        assert rows(one.read(table)) == rows(bulk.read(table)), table
    # and again on tables that have rows
    run_backfill(spark, one, days[1:2], where, key_offset=1000)
    run_backfill_bulk(spark, bulk, days[1:2], where, key_offset=1000)
    for table in FINAL_TABLES:
        assert rows(one.read(table)) == rows(bulk.read(table)), table


def jobs_so_far(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_jobs_do_not_grow_with_the_days(spark, s, tmp_dir):
    counts = {}
    for n in (3, 12):
        where = land(s, f"{tmp_dir}/{n}", DAY[:n])
        before = jobs_so_far(spark)
        run_backfill_bulk(spark, TableStore(spark, f"{tmp_dir}/{n}/store"), DAY[:n], where, key_offset=1000)
        counts[n] = jobs_so_far(spark) - before
    assert abs(counts[12] - counts[3]) <= 0.1 * counts[3], counts


def test_a_day_without_rows_stops_the_backfill(spark, s, tmp_dir):
    where = land(s, tmp_dir, DAY[:2])
    third = DAY[2].strftime("%m-%d-%Y")
    from locus.plans.catalog import _normalized

    land_json(_normalized(s).limit(0), f"{tmp_dir}/covid {third}")
    land_psv(s.lookup_staging.toDF(*LOOKUP_SOURCE_HEADER), f"{tmp_dir}/lookup {third}")
    land_psv(s.mobility_staging, f"{tmp_dir}/mobility {third}")
    store = TableStore(spark, f"{tmp_dir}/store")
    with pytest.raises(ValueError, match=f"covid {third} is empty"):
        run_backfill_bulk(spark, store, DAY[:3], where)
    assert not store.exists("location_lookup")


def test_duplicates_of_one_day_refuse_all_days(spark, s, tmp_dir):
    where = land(s, tmp_dir, DAY[:2])
    third = DAY[2].strftime("%m-%d-%Y")
    from locus.plans.catalog import _normalized

    twice = s.lookup_staging.unionByName(s.lookup_staging.filter("uid = 1").withColumn("latitude", F.lit(1.0)))
    land_json(_normalized(s), f"{tmp_dir}/covid {third}")
    land_psv(twice.toDF(*LOOKUP_SOURCE_HEADER), f"{tmp_dir}/lookup {third}")
    land_psv(s.mobility_staging, f"{tmp_dir}/mobility {third}")
    store = TableStore(spark, f"{tmp_dir}/store")
    with pytest.raises(ValueError, match="check_duplicates of lookup_days gave 1"):
        run_backfill_bulk(spark, store, DAY[:3], where, key_offset=1000)
    assert not store.exists("location_lookup")


def test_versions_follow_changes_not_days(spark):
    def place(uid, name):
        return (uid, None, None, "US", name, None, None, None, None, None, None)

    final = spark.createDataFrame([place(1, "old"), place(9, "stays")], LOCATION_LOOKUP)
    schema = "uid int, iso2 string, iso3 string, fips double, admin2 string, province_state string, " \
             f"country_region string, latitude double, longitude double, combined_key string, population double, {LOAD_DAY} date"
    staging = spark.createDataFrame(
        [(1, None, None, None, None, name, "US", None, None, None, None, DAY[d]) for d, name in
         ((1, "a"), (2, "a"), (2, "a"), (4, "b"), (5, "a"))]
        + [(None, None, None, None, None, "no id", "US", None, None, None, None, DAY[d]) for d in (1, 2)], schema)
    got = sorted(((r["location_identifier"], r["province_or_state"], r["valid_from"], r["valid_to"])
                  for r in dimension_versions(final, staging).collect()), key=repr)
    assert got == sorted([
        (1, "old", ALWAYS, DAY[1]), (1, "a", DAY[1], DAY[4]), (1, "b", DAY[4], DAY[5]), (1, "a", DAY[5], NEVER),
        (9, "stays", ALWAYS, NEVER), (None, "no id", DAY[1], NEVER), (None, "no id", DAY[2], NEVER)], key=repr)


def test_ids_chain_from_day_to_day():
    a, b, c = DAY[:3]
    assert _bases({a: 2, c: 1}, {a: 5, b: 500, c: 7}, 10, 100) == {a: 110, c: 598}
    # day a: 111, 112; day b's files bring 500; day c: 500 + 100 + 1 = 598 + 3
    with pytest.raises(ValueError, match="empty"):
        _bases({a: 1}, {a: None}, None, 100)
