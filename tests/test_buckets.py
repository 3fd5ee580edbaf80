"""Facts bucketed by location: plans without a shuffle of the facts, months
switched like those of other tables, one number of buckets per table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from locus.operators.analytics import covid_mobility_trend, covid_mobility_trend_colocated
from locus.operators.deltas import daily_deltas
from locus.schemas import COVID_FACT, MOBILITY_FACT
from locus.plans.jobs import gate_and_publish, stage_fact_months
from locus.session import colocated_session, materialize
from locus.sources.tables import TableStore, bucket_number

COVID, MOBILITY = ("covid_data_us", "covid_data_non_us"), ("google_mobility_data_us", "google_mobility_data_non_us")
BUCKETS = {name: 4 for name in COVID + MOBILITY}


def fact(spark, schema, locations, days, shift=0):
    """Rows of ``schema`` with a count or measure per location and day."""
    keys = [(loc, dt.date(2020, 1, 1) + dt.timedelta(days=d), "state", loc * 100 + d + shift)
            for loc in locations for d in days]
    rows = spark.createDataFrame(keys, "loc int, day date, level string, n int")
    fixed = {"location_identifier": "loc", "file_date": "day", "location_granularity": "level"}
    return rows.select(*[
        F.col(fixed[f.name]).cast(f.dataType).alias(f.name) if f.name in fixed
        else (F.lit(None) if f.dataType.simpleString() in ("date", "timestamp") else F.col("n")).cast(f.dataType).alias(f.name)
        for f in schema.fields])


@pytest.fixture
def store(spark, tmp_dir):
    store = TableStore(spark, tmp_dir, buckets=BUCKETS)
    for at, name in enumerate(COVID):
        store.publish(name, fact(spark, COVID_FACT, range(at * 20, at * 20 + 20), range(70)))
    for at, name in enumerate(MOBILITY):
        store.publish(name, fact(spark, MOBILITY_FACT, range(at * 20 + 5, at * 20 + 25), range(10, 80)))
    return store


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def colocated(spark):
    session = colocated_session(spark)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables of these sizes would be broadcast
    return session


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_not_shuffled(spark, store, colocated, tmp_dir):
    plain = TableStore(colocated, f"{tmp_dir}-plain")
    mine = TableStore(colocated, store.root)
    for name in BUCKETS:
        plain.publish(name, mine.read(name))

    def facts(store, names):
        return [store.read(n) for n in names]

    trend, want = (covid_mobility_trend_colocated(facts(s, COVID), facts(s, MOBILITY)) for s in (mine, plain))
    assert "Exchange" in plan(want) and "Exchange" not in plan(trend)
    union = [a.unionByName(b) for a, b in (facts(plain, COVID), facts(plain, MOBILITY))]
    assert trend.count() == 35 * 60 and rows(trend) == rows(want) == rows(covid_mobility_trend(*union))
    deltas, want = (daily_deltas(s.read(COVID[0])) for s in (mine, plain))
    assert "Exchange" in plan(want) and "Exchange" not in plan(deltas)
    assert rows(deltas) == rows(want)
    # the settings stay with that session
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "true"
    assert colocated.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_months_switch_in_buckets(spark, store, colocated):
    name = COVID[0]
    before = store.read(name)
    seen = rows(before)
    batch = fact(spark, COVID_FACT, range(20), range(31, 60), shift=7)
    staged = store.stage(name, batch)
    assert staged.buckets == 4 and staged.months == ("2020-02",)
    assert rows(before) == seen  # nothing is published yet
    store.commit([staged])
    kept = fact(spark, COVID_FACT, range(20), [*range(31), *range(60, 70)])
    assert rows(store.read(name)) == rows(kept.unionByName(batch))
    mine = TableStore(colocated, store.root)
    trend = covid_mobility_trend(mine.read(name), mine.read(MOBILITY[0]))
    assert "Exchange" not in plan(trend) and trend.count() == 15 * 60
    # a store that asks for another number joins the buckets that are there
    other = TableStore(spark, store.root, buckets={name: 8})
    assert other.stage(name, batch).buckets == 4
    other.publish(name, batch)
    assert rows(other.read(name)) == rows(batch) and other.stage(name, batch).buckets == 8
    with pytest.raises(RuntimeError, match="has 8 buckets"):
        store.commit([staged])


def test_rows_without_location_and_empty_tables(spark, tmp_dir):
    store = TableStore(spark, tmp_dir, buckets=BUCKETS)
    none = fact(spark, COVID_FACT, [0, 1], range(3)).withColumn(
        "location_identifier", F.when(F.col("location_identifier") == 1, 1))
    store.publish(COVID[0], none)
    assert rows(store.read(COVID[0])) == rows(none)
    store.publish(COVID[0], none.limit(0))
    assert store.read(COVID[0]).isEmpty()
    store.replace_months(COVID[0], none)
    assert rows(store.read(COVID[0])) == rows(none)
    with pytest.raises(ValueError, match="cannot be bucketed"):
        TableStore(spark, tmp_dir, buckets={"location_lookup": 4})


def test_a_load_merges_into_buckets(spark, tmp_dir):
    """The loads' own path: months, carry and totals of a bucketed fact."""
    bucketed, plain = (TableStore(spark, f"{tmp_dir}/{n}", buckets=b) for n, b in (("b", BUCKETS), ("p", None)))
    name = COVID[0]
    batches = [fact(spark, COVID_FACT, range(9), range(0, 90, 2)), fact(spark, COVID_FACT, range(5, 12), range(40, 50), 3)]
    for batch in (materialize(b, "batch") for b in batches):
        for store in (bucketed, plain):
            gate_and_publish(store, {name: stage_fact_months(store, name, batch, with_deltas=True)})
    for table in (name, f"{name}_carry", f"{name}_totals"):
        assert rows(bucketed.read(table)) == rows(plain.read(table))
    month = bucketed.month_paths(name)["2020-02"]
    assert len(spark.read.parquet(month).inputFiles()) <= 4


def test_bucket_number(spark, tmp_dir):
    df = materialize(spark.range(100_000), "ids")
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())
    assert bucket_number(df) == 4 and bucket_number(df, bucket_bytes=size // 20, least=1) == 32
    assert bucket_number(df, bucket_bytes=size, least=1) == 1
