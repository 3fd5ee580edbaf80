import pytest
from pyspark.sql import functions as F

from locus.functions.recode import recode
from locus.operators.covid import load_covid_fact
from locus.plans import jobs
from locus.plans.jobs import LOOKUP_SOURCE_HEADER
from locus.plans.scenario import Scenario
from locus.sources.tables import TableStore
from locus.sources.writers import land_json, land_psv
from locus.streaming.ingest import ingest_drops, ingest_new_mobility, ingest_new_reports, stream_id

MOBILITY = ("google_mobility_data_us", "google_mobility_data_non_us")
TABLES = ("location_lookup", *MOBILITY)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def s(spark):
    return Scenario(spark, "/root/testdata/sf0.001")


def test_two_runs_equal_one_batch(spark, s, tmp_dir):
    from locus.plans.catalog import _normalized

    reports = _normalized(s)
    store = TableStore(spark, f"{tmp_dir}/store")
    cut = F.to_date("file_date", "MM-dd-yyyy") < F.lit("1998-01-01")
    land_json(reports.filter(cut), f"{tmp_dir}/landing/a")
    assert ingest_new_reports(spark, f"{tmp_dir}/landing/*", store, f"{tmp_dir}/ck", lookup=s.lookup) == 1
    land_json(reports.filter(~cut), f"{tmp_dir}/landing/b")
    assert ingest_new_reports(spark, f"{tmp_dir}/landing/*", store, f"{tmp_dir}/ck", lookup=s.lookup) == 1
    # a third run finds nothing new
    assert ingest_new_reports(spark, f"{tmp_dir}/landing/*", store, f"{tmp_dir}/ck", lookup=s.lookup) == 0
    for scope in ("us", "non_us"):
        empty = spark.createDataFrame([], store.read(f"covid_data_{scope}").schema)
        batch = load_covid_fact(empty, recode(s.src.covid_data_staging), s.lookup, scope)
        streamed = store.read(f"covid_data_{scope}")
        assert rows(streamed) == rows(batch.select(*streamed.columns))


def forget_last_batch(spark, checkpoint):
    """What a run leaves that ends between its commit and the stream's own note."""
    import os

    done = sorted(f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for name in (done[-1], f".{done[-1]}.crc"):
        path = f"{checkpoint}/commits/{name}"
        if os.path.exists(path):
            os.remove(path)


def test_a_killed_and_a_replayed_mobility_batch(spark, s, tmp_dir, monkeypatch):
    mob, ck = s.mobility_staging, f"{tmp_dir}/ck"
    store = TableStore(spark, f"{tmp_dir}/store")
    store.publish("location_lookup", s.lookup_dim)
    early = F.col("date") < F.lit("1998-01-01")
    land_psv(mob.filter(early), f"{tmp_dir}/landing/a")
    assert ingest_new_mobility(spark, f"{tmp_dir}/landing/*", store, ck) == 1
    before = {t: rows(store.read(t)) for t in TABLES}

    # the second batch dies when one fact's months are staged and the other's are not
    land_psv(mob.filter(~early), f"{tmp_dir}/landing/b")
    stage = jobs.stage_fact_months

    def dies(store_, table, *more, **kw):
        if table == MOBILITY[1]:
            raise RuntimeError("executor lost")
        return stage(store_, table, *more, **kw)

    monkeypatch.setattr(jobs, "stage_fact_months", dies)
    with pytest.raises(Exception, match="executor lost"):
        ingest_new_mobility(spark, f"{tmp_dir}/landing/*", store, ck)
    monkeypatch.undo()
    assert {t: rows(store.read(t)) for t in TABLES} == before
    assert store.ledger() == {stream_id(spark, ck): 0}

    assert ingest_new_mobility(spark, f"{tmp_dir}/landing/*", store, ck) == 1
    after = {t: rows(store.read(t)) for t in TABLES}
    versions = store._versions()
    forget_last_batch(spark, ck)  # Spark runs the batch again; the ledger knows it
    assert ingest_new_mobility(spark, f"{tmp_dir}/landing/*", store, ck) == 0
    assert {t: rows(store.read(t)) for t in TABLES} == after and store._versions() == versions
    assert {t: len(r) for t, r in after.items()} != {t: len(r) for t, r in before.items()}


def test_the_drops_of_all_sources_equal_a_load(spark, s, tmp_dir):
    """Lookups, mobility and reports landed at once, taken in order."""
    from locus.plans.catalog import _normalized

    land_psv(s.lookup_staging.toDF(*LOOKUP_SOURCE_HEADER), f"{tmp_dir}/lookups/a")
    land_psv(s.mobility_staging, f"{tmp_dir}/mobility/a")
    land_json(_normalized(s), f"{tmp_dir}/reports/a")
    store = TableStore(spark, f"{tmp_dir}/store")
    landing = {n: f"{tmp_dir}/{n}/*" for n in ("lookups", "mobility", "reports")}
    assert ingest_drops(spark, store, f"{tmp_dir}/ck", **landing) == {"lookups": 1, "mobility": 1, "reports": 1}
    assert rows(store.read("location_lookup")) == rows(s.lookup)
    for scope in ("us", "non_us"):
        assert rows(store.read(f"covid_data_{scope}")) == rows(s.covid_fact(scope))
        assert rows(store.read(f"google_mobility_data_{scope}")) == rows(s.mobility_fact(scope))
