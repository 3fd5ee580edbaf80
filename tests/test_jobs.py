import datetime as dt

import pytest

from locus.functions.recode import recode
from locus.operators.covid import load_covid_fact
from locus.operators.dml import empty_like
from locus.operators.mobility import load_mobility_fact
from locus.operators.deltas import daily_deltas
from locus.plans.jobs import (
    LOOKUP_SOURCE_HEADER, SourceTemplates, gate_and_publish, land_reports, run_backfill, run_daily, run_historical,
    stage_fact_months,
)
from locus.plans.scenario import Scenario
from locus.schemas import COVID_FACT, FINAL_TABLES, LOCATION_LOOKUP, MOBILITY_FACT
from locus.session import materialize
from locus.sources.readers import read_case_reports
from locus.sources.tables import TableStore
from locus.sources.writers import land_json, land_psv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_historical_load_from_files_and_rerun(spark, tmp_dir):
    from locus.plans.catalog import _normalized

    s = Scenario(spark, "/root/testdata/sf0.001")
    land_json(_normalized(s), f"{tmp_dir}/covid")
    land_psv(s.lookup_staging.toDF(*LOOKUP_SOURCE_HEADER), f"{tmp_dir}/lookup")
    land_psv(s.mobility_staging, f"{tmp_dir}/mobility")
    store = TableStore(spark, f"{tmp_dir}/warehouse")
    run_historical(spark, store, f"{tmp_dir}/covid/*.json", f"{tmp_dir}/lookup", f"{tmp_dir}/mobility")

    assert rows(store.read("location_lookup")) == rows(s.lookup)
    fixed = recode(s.covid_staging)
    for scope in ("us", "non_us"):
        want = load_covid_fact(empty_like(spark, COVID_FACT), fixed, s.lookup, scope)
        assert rows(store.read(f"covid_data_{scope}")) == rows(want)
        want = load_mobility_fact(empty_like(spark, MOBILITY_FACT), s.mobility_staging, s.lookup, scope)
        assert rows(store.read(f"google_mobility_data_{scope}")) == rows(want)

    before = {t: rows(store.read(t)) for t in ("location_lookup", "covid_data_us", "google_mobility_data_non_us")}
    run_historical(spark, store, f"{tmp_dir}/covid/*.json", f"{tmp_dir}/lookup", f"{tmp_dir}/mobility")
    assert {t: rows(store.read(t)) for t in before} == before  # a rerun changes nothing
    # staging tables are gone again, and no scratch file stays
    assert [r[0] for r in store.list_tables().collect()] == sorted(
        ["location_lookup", "covid_data_us", "covid_data_non_us", "google_mobility_data_us",
         "google_mobility_data_non_us"])


def land_day(spark, root, day, covid, lookup, mobility):
    name = day.strftime("%m-%d-%Y")
    land_json(covid, f"{root}/covid_{name}")
    land_psv(lookup, f"{root}/lookup_{name}")
    land_psv(mobility, f"{root}/mobility_{name}")


def test_backfill_equals_day_by_day(spark, tmp_dir):
    """Each day's lookup and mobility rows are in that day's files only."""
    from pyspark.sql import functions as F

    from locus.plans.catalog import _normalized

    s = Scenario(spark, "/root/testdata/sf0.001")
    days = [dt.date(2021, 3, 1), dt.date(2021, 3, 2)]
    reports, lookup, mob = _normalized(s), s.lookup_staging.toDF(*LOOKUP_SOURCE_HEADER), s.mobility_staging
    early = F.to_date("file_date", "MM-dd-yyyy") < F.lit("1998-01-01")
    land_day(spark, tmp_dir, days[0], reports.filter(early), lookup.filter("UID < 100100"),
             mob.filter(F.col("date") < F.lit("1998-01-01")))
    land_day(spark, tmp_dir, days[1], reports.filter(~early), lookup.filter("UID < 1000 or UID >= 100050"),
             mob.filter(F.col("date") >= F.lit("1997-10-01")))
    templates = SourceTemplates(*[f"{tmp_dir}/{n}_{{file_date}}" for n in ("covid", "lookup", "mobility")])
    one, two = (TableStore(spark, f"{tmp_dir}/{n}") for n in ("one", "two"))
    run_backfill(spark, one, reversed(days), templates)
    for day in days:
        run_daily(spark, two, day + dt.timedelta(days=1), templates)
    for table in FINAL_TABLES:
        assert rows(one.read(table)) == rows(two.read(table))
    # deltas of a fact that grew by months equal those over its whole history
    for scope in ("us", "non_us"):
        fact = one.read(f"covid_data_{scope}")
        assert rows(fact) == rows(daily_deltas(fact).select(*fact.columns))


def test_late_rows_change_the_delta_of_the_next_month(spark, tmp_dir):
    def fact(*rows_):
        typed = [(loc, dt.date(2020, m, d), n) for loc, m, d, n in rows_]
        df = spark.createDataFrame(typed, "location_identifier int, file_date date, ttl_confirmed_cases long")
        return materialize(empty_like(spark, COVID_FACT).unionByName(df, allowMissingColumns=True), "fact")

    store, table = TableStore(spark, tmp_dir), "covid_data_us"
    everything = []
    for batch in ([(1, 1, 1, 10), (2, 1, 1, 5), (1, 4, 1, 50), (2, 5, 1, 9)], [(1, 2, 1, 20), (3, 2, 2, 1)],
                  [(1, 6, 1, 60), (2, 6, 1, 8)], [(1, 1, 1, 12)]):
        everything = [r for r in everything if r[:3] not in {b[:3] for b in batch}] + batch
        gate_and_publish(store, {table: stage_fact_months(store, table, fact(*batch), with_deltas=True)})
        want = daily_deltas(fact(*everything))
        got = store.read(table)
        assert rows(got) == rows(want.select(*got.columns))


def test_one_late_row_rewrites_two_months(spark, tmp_dir):
    """Rows every month; a late row of an early month rewrites that month and
    the location's next one, whatever lies in between and after."""
    def fact(rows_):
        df = spark.createDataFrame(rows_, "location_identifier int, file_date date, ttl_confirmed_cases long")
        return materialize(empty_like(spark, COVID_FACT).unionByName(df, allowMissingColumns=True), "fact")

    store, table = TableStore(spark, tmp_dir), "covid_data_us"
    old = [(loc, dt.date(2020 + m // 12, m % 12 + 1, d), 10 * m + d) for loc in (1, 2, 3) for m in range(18)
           for d in (1, 9) if not (loc == 1 and m in (3, 4))]
    gate_and_publish(store, {table: stage_fact_months(store, table, fact(old), with_deltas=True)})
    before = store.month_paths(table), store.month_paths(f"{table}_carry")
    late = [(1, dt.date(2020, 3, 20), 77)]
    gate_and_publish(store, {table: stage_fact_months(store, table, fact(late), with_deltas=True)})
    after = store.month_paths(table), store.month_paths(f"{table}_carry")
    for was, now in zip(before, after):
        assert {m for m in now if now[m] != was.get(m)} == {"2020-03", "2020-06"}
    got = store.read(table)
    assert rows(got) == rows(daily_deltas(fact(old + late)).select(*got.columns))


def test_a_refused_load_publishes_nothing(spark, tmp_dir):
    """All tables switch after the gate, or none."""
    from locus.plans.catalog import _normalized
    from locus.plans.jobs import run_load
    from locus.sources.readers import parse_case_reports

    s = Scenario(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, tmp_dir)
    covid = parse_case_reports(_normalized(s))
    run_load(spark, store, covid, s.lookup_staging, s.mobility_staging)
    before = {t: rows(store.read(t)) for t in FINAL_TABLES}
    twice = s.lookup_staging.unionByName(s.lookup_staging.filter("uid = 1").withColumn("population", s.lookup_staging.uid * 2.0))
    with pytest.raises(ValueError, match="check_duplicates of location_lookup gave 1"):
        run_load(spark, store, covid, twice, s.mobility_staging)
    assert {t: rows(store.read(t)) for t in FINAL_TABLES} == before


def test_load_refuses_empty_tables_and_undated_rows(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    undated = materialize(empty_like(spark, COVID_FACT).unionByName(
        spark.createDataFrame([(1, None)], "location_identifier int, file_date date"), allowMissingColumns=True), "fact")
    with pytest.raises(ValueError, match="check_nulls"):
        gate_and_publish(store, {"covid_data_us": stage_fact_months(store, "covid_data_us", undated, True)})
    assert not store.exists("covid_data_us")
    with pytest.raises(ValueError, match="no rows for covid_data_us"):
        gate_and_publish(store, {"covid_data_us": None}, store.stage("location_lookup", empty_like(spark, LOCATION_LOOKUP)))


def test_landing_job(spark, tmp_dir):
    import os

    for name, day in (("a", "03-01-2021"), ("b", "03-02-2021")):
        os.makedirs(f"{tmp_dir}/raw/{day}")
        with open(f"{tmp_dir}/raw/{day}/r.csv", "w") as f:
            f.write(f"Province/State,Country/Region,Last Update,Confirmed\n{name},US,3/1/2021 5:00,4\n")
    days = [dt.date(2021, 3, 1), dt.date(2021, 3, 2)]
    paths = land_reports(spark, f"{tmp_dir}/raw/{{file_date}}", f"{tmp_dir}/landed/{{file_date}}", days)
    got = sorted((r["province_state"], r["file_date"], r["confirmed"]) for r in read_case_reports(spark, paths).collect())
    assert got == [("a", days[0], 4), ("b", days[1], 4)]
