"""What a load leaves on disk, and for how long."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from locus import session
from locus.plans import jobs
from locus.plans.jobs import SourceTemplates, load_covid_months, load_mobility_months, run_backfill_bulk, together
from locus.schemas import COVID_STAGING, LOCATION_LOOKUP, LOOKUP_STAGING, MOBILITY_STAGING
from locus.session import (
    SHUFFLE_CLEANUP, file_system, materialize, path_exists, scratch_scope, shuffles_dropped, written,
)
from locus.sources.readers import read_case_reports
from locus.sources.tables import TableStore
from locus.sources.writers import land_json, land_psv

DAY = dt.date(2021, 3, 1)


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


@pytest.fixture
def own_root(monkeypatch, tmp_path):
    """Scratch tables of this test alone."""
    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(tmp_path))


def covid_rows(spark, date=DAY):
    return frame(spark, COVID_STAGING, *[{"country_region": c, "province_state": p, "file_date": date, "confirmed": 5}
                                         for c, p in (("US", "Ohio"), ("FRANCE", None))])


def mobility_rows(spark):
    return frame(spark, MOBILITY_STAGING, *[{"country_region_code": c, "country_region": n, "date": DAY}
                                            for c, n in (("US", "US"), ("FR", "FRANCE"))])


PLACES = ((1, "US", "US", None), (2, "US", "US", "Ohio"), (3, "FR", "FRANCE", None))


def places(spark):
    return frame(spark, LOCATION_LOOKUP, *[{"location_identifier": i, "iso2_code": c, "country_region": n,
                                            "province_or_state": p} for i, c, n, p in PLACES])


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if os.path.basename(f).startswith("shuffle_")}


def gone(spark, before):
    """Files go in the background."""
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return not shuffle_files(spark) - before


def scratch(spark, *names):
    fs, p = file_system(spark, f"{session.checkpoint_root(spark)}/locus-scratch")
    return {n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(names)}


def test_shuffle_files_go_with_their_write(spark, tmp_dir):
    df = spark.range(1000).select(F.col("id").cast("string").alias("x")).repartition(4, "x")
    before = shuffle_files(spark)
    assert materialize(df, "dealt").count() == 1000
    land_json(df, f"{tmp_dir}/json")
    land_psv(df, f"{tmp_dir}/psv")
    TableStore(spark, f"{tmp_dir}/store").stage("any", df)
    with scratch_scope(spark):
        assert df.groupBy("x").count().count() == 1000
    assert gone(spark, before)


def test_setting_is_put_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)

    def inside(fail=False):
        with shuffles_dropped(spark), shuffles_dropped(spark):
            time.sleep(0.05)
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            if fail:
                raise ValueError("refused")

    together({str(i): inside for i in range(4)})
    with pytest.raises(ValueError):
        inside(fail=True)
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_reports_go_with_the_batch_and_the_batch_with_the_months(spark, own_root, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/store")
    for load, rows in ((load_covid_months, covid_rows(spark)), (load_mobility_months, mobility_rows(spark))):
        reports, path = written(rows, "reports")
        staged = load(store, reports, places(spark), path)
        assert all(s.rows.count() == 1 for s in staged.values())
        assert not path_exists(spark, path)
    assert not scratch(spark, "covid_batch", "mobility_batch")
    # without any date nothing is staged: the batch stays, for the gate to refuse
    staged = load_covid_months(store, covid_rows(spark, date=None), places(spark))
    assert all(s.path == "" and s.rows.count() == 1 for s in staged.values())


def test_days_go_before_the_facts_are_staged(spark, own_root, tmp_dir, monkeypatch):
    reports = covid_rows(spark).select(
        F.col("country_region").alias("Country_Region"), F.col("province_state").alias("Province_State"),
        F.col("confirmed").alias("Confirmed"), F.lit("03-01-2021").alias("file_date"))
    lookup = frame(spark, LOOKUP_STAGING, *[{"uid": i, "iso2": c, "country_region": n, "province_state": p}
                                            for i, c, n, p in PLACES])
    land_json(reports, f"{tmp_dir}/covid_03-01-2021")
    land_psv(lookup.toDF(*jobs.LOOKUP_SOURCE_HEADER), f"{tmp_dir}/lookup_03-01-2021")
    land_psv(mobility_rows(spark), f"{tmp_dir}/mobility_03-01-2021")
    seen, stage = [], jobs.stage_fact_months

    def spied(store, table, *args, **kw):
        seen.append(scratch(spark, "covid_days" if table.startswith("covid") else "mobility_days"))
        return stage(store, table, *args, **kw)

    monkeypatch.setattr(jobs, "stage_fact_months", spied)
    store = TableStore(spark, f"{tmp_dir}/store")
    run_backfill_bulk(spark, store, [DAY], SourceTemplates(
        *[f"{tmp_dir}/{n}_{{file_date}}" for n in ("covid", "lookup", "mobility")]))
    assert seen == [set()] * 4
    assert store.read("covid_data_us").count() == store.read("google_mobility_data_non_us").count() == 1


def test_landed_json_may_be_compressed(spark, tmp_dir):
    rows = spark.range(25).select(F.lit("US").alias("Country_Region"), F.col("id").alias("Confirmed"),
                                  F.lit("03-01-2021").alias("file_date"))
    path = land_json(rows.coalesce(1), f"{tmp_dir}/json", compression="gzip", rows_per_file=10)
    back = read_case_reports(spark, path)
    assert len(back.inputFiles()) == 3 and all(f.endswith(".json.gz") for f in back.inputFiles())
    assert sorted(r[0] for r in back.select("confirmed").collect()) == list(range(25))


def test_replaced_staging_goes_at_once(spark, tmp_dir):
    """Other tables stay for two further commits, for their readers."""
    store, paths = TableStore(spark, tmp_dir), {}
    for name, schema in (("covid_data_staging", COVID_STAGING), ("location_lookup", LOCATION_LOOKUP)):
        rows = covid_rows(spark) if schema is COVID_STAGING else places(spark)
        store.publish(name, rows)
        paths[name] = store.current_path(name)
        store.publish(name, rows.limit(1))
        assert store.read(name).count() == 1
    assert not path_exists(spark, paths["covid_data_staging"])
    assert path_exists(spark, paths["location_lookup"])
    last = store.current_path("covid_data_staging")
    store.drop("covid_data_staging")
    assert not path_exists(spark, last) and store.read("covid_data_staging").count() == 0


@pytest.mark.parametrize("query", ["refused_load", "staging_load"])
def test_loads_land_compressed_reports(spark, monkeypatch, query):
    from locus.plans import catalog

    seen = []

    def spied(spark, store, covid, lookup, mobility, **kw):
        seen.extend(covid.inputFiles())
        raise ValueError("refused")

    monkeypatch.setattr(catalog, "run_load", spied)
    try:
        catalog.queries()[query](spark, "/root/testdata/sf0.001")
    except ValueError:
        pass
    assert seen and all(f.endswith(".json.gz") for f in seen)


def test_versions_shuffle_the_days_once(spark):
    """Of thirty days' lookups, by far the largest table of a backfill, each
    wide row moves once: by id (the others are sums per id, and rows without one)."""
    from pyspark.sql import types as T

    from locus.operators.validity import LOAD_DAY, dimension_versions

    staging = frame(spark, T.StructType([*LOOKUP_STAGING.fields, T.StructField(LOAD_DAY, T.DateType())]))
    plan = dimension_versions(places(spark), staging)._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "REPARTITION_BY_COL" in x]
    assert len(wide) == 1 and plan.count("Exchange hashpartitioning") <= 4
