import datetime as dt

from pyspark.sql import functions as F

from locus.operators.dedup import dedup_latest
from locus.operators.deltas import daily_deltas, refresh_deltas

D = dt.date
TS = dt.datetime


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_dedup_null_update_time_wins_and_ties_break(spark):
    df = spark.createDataFrame(
        [
            (1, D(2020, 1, 1), TS(2020, 1, 1, 5), 10, 1),
            (1, D(2020, 1, 1), None, 5, 1),  # NULL sorts first in DESC: wins
            (2, D(2020, 1, 1), TS(2020, 1, 1, 5), 10, 1),
            (2, D(2020, 1, 1), TS(2020, 1, 1, 5), 12, 1),  # same time, more confirmed
            (3, D(2020, 1, 1), TS(2020, 1, 1, 5), 7, 2),
            (3, D(2020, 1, 1), TS(2020, 1, 1, 5), 7, 2),  # full tie
        ],
        "loc int, d date, ts timestamp_ntz, confirmed long, deaths long",
    )
    for method in ("aggregate", "window"):
        out = dedup_latest(df, ["loc", "d"], ["ts", "confirmed", "deaths"], method=method)
        assert rows(out, "loc", "confirmed") == [(1, 5), (2, 12), (3, 7)]


def test_dedup_methods_agree_on_real_rows(spark):
    from locus.plans.adapters import Adapters

    staging = Adapters(spark, "/root/testdata/sf0.001").covid_data_staging.withColumn(
        "k", F.col("deaths") % 50)
    order = ["last_update_dts", "confirmed", "recovered"]
    a = dedup_latest(staging, ["k", "file_date"], order, "aggregate")
    w = dedup_latest(staging, ["k", "file_date"], order, "window")
    assert rows(a, *a.columns) == rows(w, *a.columns)


def fact(spark, data):
    return spark.createDataFrame(
        data,
        "location_identifier int, file_date date, ttl_confirmed_cases long, ttl_deaths long, "
        "ttl_recovered_cases long",
    )


def test_deltas_cases(spark):
    f = fact(spark, [
        (1, D(2020, 1, 1), 10, 1, None),   # first row: fallback to cumulative
        (1, D(2020, 1, 2), 15, 1, 4),      # NULL previous: fallback
        (1, D(2020, 1, 5), 12, 2, None),   # gap kept, decrease kept; NULL current -> NULL
        (2, D(2020, 1, 1), 100, 0, 0),
        (2, D(2020, 1, 2), 130, 3, 1),
    ])
    out = daily_deltas(f)
    got = rows(out, "location_identifier", "file_date", "new_confirmed_cases", "new_deaths", "new_recoveries")
    assert got == [
        (1, D(2020, 1, 1), 10, 1, None),
        (1, D(2020, 1, 2), 5, 0, 4),
        (1, D(2020, 1, 5), -3, 1, None),
        (2, D(2020, 1, 1), 100, 0, 0),
        (2, D(2020, 1, 2), 30, 3, 1),
    ]
    assert dict(out.dtypes)["new_confirmed_cases"] == "int"


def test_refresh_equals_full(spark):
    """Existing fact with correct deltas; a batch replaces day 3 of location
    2 and adds day 7: the incremental refresh equals a full recompute,
    including the changed delta of the row after the replaced day."""
    from locus.operators.dml import upsert

    old = daily_deltas(fact(spark, [(1, D(2020, 1, d), 10 * d, d, d) for d in range(1, 6)]
                            + [(2, D(2020, 1, d), 7 * d, d, d) for d in range(1, 6)]))
    batch = fact(spark, [(2, D(2020, 1, 3), 50, 9, None), (2, D(2020, 1, 7), 60, 9, 9)])
    batch = batch.select(*[batch[c] if c in batch.columns else F.lit(None).cast("int").alias(c)
                           for c in old.columns])
    merged = upsert(old, batch, ["location_identifier", "file_date"])
    full = daily_deltas(merged)
    inc = refresh_deltas(merged, batch.select("location_identifier", "file_date"))
    assert rows(inc, *full.columns) == rows(full, *full.columns)


def test_sum_of_deltas_is_last_cumulative(spark):
    f = fact(spark, [(1, D(2020, 1, d), d * d, d, d) for d in range(1, 10)])
    s = daily_deltas(f).agg(F.sum("new_confirmed_cases")).first()[0]
    assert s == 81


def test_touched_load_equals_full_load(spark):
    from locus.operators.covid import load_covid_fact
    from locus.operators.dml import empty_like
    from locus.plans.scenario import SPLIT_NEW, SPLIT_OLD, Scenario
    from locus.schemas import COVID_FACT

    s = Scenario(spark, "/root/testdata/sf0.001")
    old = s.covid_fixed.filter(F.col("file_date") < F.lit(SPLIT_OLD))
    new = s.covid_fixed.filter(F.col("file_date") >= F.lit(SPLIT_NEW))
    for scope in ("us", "non_us"):
        final = load_covid_fact(empty_like(spark, COVID_FACT), old, s.lookup, scope)
        full = load_covid_fact(final, new, s.lookup, scope, deltas="full")
        inc = load_covid_fact(final, new, s.lookup, scope, deltas="touched")
        assert rows(inc, *full.columns) == rows(full, *full.columns)


def test_refresh_keeps_rows_without_a_date(spark):
    import datetime as dt

    cols = "location_identifier int, file_date date, ttl_confirmed_cases long, ttl_deaths long, ttl_recovered_cases long, " \
           "new_confirmed_cases int, new_deaths int, new_recoveries int"
    rows = [(1, dt.date(2020, 1, 1), 5, 1, 1, 5, 1, 1), (1, None, 7, 1, 1, 7, 1, 1), (2, None, 3, 0, 0, 3, 0, 0),
            (None, dt.date(2020, 1, 2), 1, 1, 1, 1, 1, 1)]
    fact = spark.createDataFrame(rows, cols)
    keys = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "location_identifier int, file_date date")
    assert refresh_deltas(fact, keys).count() == 4
