"""What loads keep beside the facts, against scans of the facts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from locus.operators import analytics as A
from locus.operators.dml import empty_like
from locus.operators.quality import metrics_report, quality_report
from locus.operators.totals import month_totals
from locus.plans.jobs import gate_and_publish, kept_metrics, stage_fact_months
from locus.schemas import COVID_FACT, FACT_KEY, MOBILITY_FACT, TABLE_KEYS
from locus.session import materialize
from locus.sources.tables import TableStore

CASES, MOVES = "covid_data_us", "google_mobility_data_us"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def fact(spark, schema, given):
    df = spark.createDataFrame(given, "location_identifier int, file_date date, location_granularity string, value long")
    value = "ttl_confirmed_cases" if schema is COVID_FACT else schema.fieldNames()[2]
    df = df.withColumnRenamed("value", value)
    return materialize(empty_like(spark, schema).unionByName(df, allowMissingColumns=True).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields]), "fact")


@pytest.fixture(scope="module")
def store(spark):
    from locus.session import scratch_path

    store = TableStore(spark, scratch_path(spark, "kept"))
    day = dt.date
    drops = (
        [(1, day(2020, m, d), "state", 10 * m + d) for m in (1, 2, 4) for d in (1, 20)] + [(2, day(2020, 1, 1), "county", None)],
        [(1, day(2020, 2, 20), "state", 3), (3, day(2020, 5, 5), "state", 8)],  # a correction and a new place
        [(1, day(2020, 4, 20), "state", 99)],  # the last day corrected
        [(2, day(2020, 3, 3), "county", 7)],  # late, for a place that had no value
    )
    for drop in drops:
        gate_and_publish(store, {
            CASES: stage_fact_months(store, CASES, fact(spark, COVID_FACT, drop), with_deltas=True),
            MOVES: stage_fact_months(store, MOVES, fact(spark, MOBILITY_FACT, drop), with_deltas=False)})
    return store


def test_totals_equal_sums_over_the_fact(store):
    for table in (CASES, MOVES):
        kept = store.read(f"{table}_totals")
        assert rows(kept) == rows(month_totals(store.read(table)).select(*kept.columns))


def test_latest_rows_follow_corrections(store):
    latest = {r["location_identifier"]: (r["file_date"], r["ttl_confirmed_cases"])
              for r in A._latest_cumulative(store.read(f"{CASES}_carry"), "state").collect()}
    assert latest == {1: (dt.date(2020, 4, 20), 99), 3: (dt.date(2020, 5, 5), 8)}


def test_kept_metrics_equal_scans(spark, store):
    tables = {t: store.read(t) for t in (CASES, MOVES)}
    kept = kept_metrics(store, tables)
    assert rows(metrics_report(kept, list(tables))) == rows(quality_report(tables, TABLE_KEYS))
    counts = kept.groupBy("table_name").agg(F.sum("rows"), F.sum("distinct_keys"), F.max("latest"))
    want = [(t, df.count(), df.select(*FACT_KEY).distinct().count(), str(df.agg(F.max("file_date")).first()[0]))
            for t, df in tables.items()]
    assert rows(counts) == sorted(want, key=repr)


def test_months_published_without_a_check_are_scanned(spark, store):
    assert store.metrics(CASES) is not None
    other = TableStore(spark, f"{store.root}-other")
    other.publish(CASES, store.read(CASES))
    assert other.metrics(CASES) is None
    assert rows(kept_metrics(other, [CASES])) == rows(kept_metrics(store, [CASES]))
