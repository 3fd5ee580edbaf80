import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locus.functions.columns import or_raise, parse_number
from locus.plans.jobs import load_staging
from locus.schemas import LOOKUP_STAGING
from locus.sources.readers import (
    ensure_each_not_empty,
    ensure_not_empty,
    normalize_case_report,
    read_case_reports,
    read_psv,
    read_source_csv,
    source_paths,
)
from locus.sources.tables import TableStore
from locus.sources.writers import dealt_evenly, land_json, land_psv


def test_source_paths():
    t = "/x/covid_{file_date}.json"
    assert source_paths(t, [dt.date(2021, 3, 4)]) == ["/x/covid_03-04-2021.json"]


def test_psv_commas_pipes_and_na(spark, tmp_dir):
    rows = [(1, "NA", None, None, None, None, None, "Namibia", 1.5, 2.5, "Windhoek, Namibia", 100.0),
            (2, "US", None, None, 1001.0, "A|B", "Texas", "US", 0.0, 0.0, "A|B, Texas, US", None)]
    df = spark.createDataFrame(rows, LOOKUP_STAGING)
    path = land_psv(df, tmp_dir)
    back = read_psv(spark, path, LOOKUP_STAGING)
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)  # 'NA' stays text, quoted pipe survives


def test_psv_header_mismatch(spark, tmp_dir):
    os.makedirs(tmp_dir)
    with gzip.open(f"{tmp_dir}/f.psv.gz", "wt") as f:
        f.write("a|b\n1|2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_psv(spark, tmp_dir, LOOKUP_STAGING).collect()


def test_psv_second_file_with_swapped_columns(spark, tmp_dir):
    os.makedirs(tmp_dir)
    names = LOOKUP_STAGING.fieldNames()
    for n, header in enumerate((names, [names[1], names[0], *names[2:]])):
        with gzip.open(f"{tmp_dir}/f{n}.psv.gz", "wt") as f:
            f.write("|".join(header) + "\n" + "|".join(["1"] * len(names)) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_psv(spark, [f"{tmp_dir}/f0.psv.gz", f"{tmp_dir}/f1.psv.gz"], LOOKUP_STAGING).collect()


def _reports(tmp_dir, *lines):
    os.makedirs(tmp_dir)
    with open(f"{tmp_dir}/r.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    return f"{tmp_dir}/r.json"


def test_counts_written_as_floats_are_kept(spark, tmp_dir):
    path = _reports(tmp_dir, '{"Confirmed": 5.0, "Deaths": "7", "Active": 1.5, "Last_Update": "", "file_date": "03-04-2021"}')
    row = read_case_reports(spark, path).first()
    assert (row["confirmed"], row["deaths"], row["active"], row["last_update_dts"]) == (5, 7, 1.5, None)
    assert row["file_date"] == dt.date(2021, 3, 4)


@pytest.mark.parametrize("line,what", [
    ('{"Confirmed": 5.5}', "not whole"), ('{"Confirmed": "many"}', "unreadable number"),
    ('{"Last_Update": "4th of May"}', "unreadable timestamp"), ('{"file_date": "2021-03-04"}', "unreadable date"),
    ('{"Confirmed": 1, ', "(?i)malformed"), ('{"Lat": "north"}', "unreadable number"),
])
def test_unreadable_values_stop_the_read(spark, tmp_dir, line, what):
    with pytest.raises(Exception, match=what):
        read_case_reports(spark, _reports(tmp_dir, line)).collect()


def test_every_listed_file_must_have_rows(spark, tmp_dir):
    os.makedirs(tmp_dir)
    names = LOOKUP_STAGING.fieldNames()
    for n, rows in enumerate((["|".join(["1"] * len(names))], [])):
        with gzip.open(f"{tmp_dir}/f {n}.psv.gz", "wt") as f:
            f.write("\n".join(["|".join(names), *rows]) + "\n")
    paths = [f"{tmp_dir}/f 0.psv.gz", f"{tmp_dir}/f 1.psv.gz"]
    assert ensure_each_not_empty(read_psv(spark, paths[:1], LOOKUP_STAGING), paths[:1]).count() == 1
    with pytest.raises(ValueError, match="f 1.psv.gz is empty"):
        ensure_each_not_empty(read_psv(spark, paths, LOOKUP_STAGING), paths)


def test_case_reports_aliases_formats_prefix_and_missing_keys(spark, tmp_dir):
    os.makedirs(tmp_dir)
    with open(f"{tmp_dir}/daily_01-22-2020.csv", "w") as f:
        f.write("Province/State,Country/Region,Last Update,Confirmed\nHubei,China,1/22/2020 17:00,444\n")
    with open(f"{tmp_dir}/daily_06-01-2020.csv", "w") as f:
        f.write("FIPS,Admin2,Province_State,Country_Region,Last_Update,Confirmed,Deaths\n"
                "48453,Travis,Texas,US,2020-06-01 02:33:00,3000,60\n")
    raw = read_source_csv(spark, [f"{tmp_dir}/daily_01-22-2020.csv"])
    raw2 = read_source_csv(spark, [f"{tmp_dir}/daily_06-01-2020.csv"])
    landed = normalize_case_report(raw).unionByName(normalize_case_report(raw2), allowMissingColumns=True)
    land_json(landed, f"{tmp_dir}/landed")
    got = read_case_reports(spark, f"{tmp_dir}/landed").orderBy("file_date").collect()
    assert got[0]["province_state"] == "Hubei" and got[0]["admin2"] is None  # absent key -> NULL
    assert got[0]["last_update_dts"] == dt.datetime(2020, 1, 22, 17, 0)
    assert got[0]["file_date"] == dt.date(2020, 1, 22)  # from the file name
    assert got[1]["fips"] == "48453" and got[1]["deaths"] == 60
    assert got[1]["file_date"] == dt.date(2020, 6, 1)


def test_empty_source_raises(spark, tmp_dir):
    with pytest.raises(ValueError, match="is empty"):
        ensure_not_empty(spark.createDataFrame([], "a int"), "covid")


def test_table_store_versions(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    assert store.read("covid_data_us").count() == 0  # absent -> empty, declared schema
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "location_identifier int, file_date date")
    store.publish("t1", df)
    first = store.read("t1")
    # a new version computed from the current one never overwrites what it reads
    store.publish("t1", first.unionByName(df.withColumn("location_identifier", F.lit(2))))
    assert sorted(r[0] for r in store.read("t1").collect()) == [1, 2]
    store.publish("t2", df)
    assert [r[0] for r in store.list_tables().collect()] == ["t1", "t2"]
    store.drop("t2")
    assert [r[0] for r in store.list_tables().collect()] == ["t1"]


def test_unreadable_version_is_not_an_absent_table(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    store.publish("t1", spark.createDataFrame([(1,)], "a int"))
    with open(f"{tmp_dir}/_versions/0000000002.json", "w") as f:
        f.write('{"tables": ')
    with pytest.raises(OSError, match="malformed"):
        store.read("t1")
    with pytest.raises(OSError, match="malformed"):
        store.list_tables()


def _case_rows(store, rows):
    df = store.spark.createDataFrame(rows, "location_identifier int, file_date date, ttl_confirmed_cases long")
    have = store.read("covid_data_us").limit(0)
    return have.unionByName(df, allowMissingColumns=True)


def test_months_switch_and_a_reader_goes_on(spark, tmp_dir):
    store = TableStore(spark, tmp_dir, keep=1)
    day = dt.date
    store.publish("covid_data_us", _case_rows(store, [(1, day(2020, 1, 5), 1), (1, day(2020, 2, 5), 2)]))
    first = store.month_paths("covid_data_us")
    reader = store.read("covid_data_us")
    files = sorted(reader.inputFiles())
    store.replace_months("covid_data_us", _case_rows(store, [(1, day(2020, 2, 5), 9), (1, day(2020, 3, 5), 4)]))
    second = store.month_paths("covid_data_us")
    assert first["2020-01"] == second["2020-01"] and first["2020-02"] != second["2020-02"]
    # what the reader has planned is still there, and it answers
    assert all(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in files)
    assert reader.count() == 3
    got = sorted((r["file_date"].month, r["ttl_confirmed_cases"]) for r in store.read("covid_data_us").collect())
    assert got == [(1, 1), (2, 9), (3, 4)]
    assert store.read("covid_data_us", ["2020-02"]).count() == 1
    # the catalog's table is the same, and its months prune
    table = spark.table(f"{store.database}.covid_data_us").where("file_month = '2020-03'")
    assert len(table.inputFiles()) == 1 and table.count() == 1
    # two commits later the replaced month is gone, months in use are not
    store.replace_months("covid_data_us", _case_rows(store, [(1, day(2020, 3, 6), 5)]))
    assert not os.path.exists(first["2020-02"]) and os.path.exists(first["2020-01"])
    assert len(store._versions()) == 2


def test_another_session_registers_what_is_published(spark, tmp_dir):
    from locus.sources import tables

    store = TableStore(spark, tmp_dir)
    store.publish("covid_data_us", _case_rows(store, [(1, dt.date(2020, 1, 5), 1)]))
    spark.sql(f"DROP DATABASE {store.database} CASCADE")  # a catalog that knows nothing of it
    tables._REGISTERED.clear()
    assert TableStore(spark, tmp_dir).read("covid_data_us").count() == 1


def test_a_second_writer_fails(spark, tmp_dir, monkeypatch):
    store = TableStore(spark, tmp_dir)
    store.publish("t1", spark.range(1))
    monkeypatch.setattr(store, "_current", lambda: (0, {"tables": {}, "ledger": {}}))  # read before the other's commit
    with pytest.raises(RuntimeError, match="another writer"):
        store.publish("t1", spark.range(2))
    monkeypatch.undo()
    assert store.read("t1").count() == 1


def test_empty_fact_is_readable(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    store.create_all()
    assert store.read("covid_data_non_us").count() == 0 and store.months("covid_data_non_us") == []
    assert store.list_tables().count() == 10


def test_landed_tables_are_read_in_parts(spark, tmp_dir):
    """Gzip files don't split: a table lands as files of a bounded number of rows."""
    df = spark.range(1000).coalesce(1).selectExpr("id as a", "cast(id as string) as b")
    land_psv(df, tmp_dir, rows_per_file=100)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    back = read_psv(spark, tmp_dir, schema)
    per_file = back.groupBy(F.col("_metadata.file_name")).count().agg(F.max("count"), F.count("*")).first()
    assert per_file[0] <= 100 and per_file[1] >= 10 and back.distinct().count() == 1000


def test_na_is_text_unless_named(spark, tmp_dir):
    df = spark.createDataFrame([("NA", 1.0), ("N/A", 2.0), ("x", None), (None, 3.0)], "code string, n double")
    land_psv(df, tmp_dir)
    got = lambda **kw: sorted((r["code"] or "") for r in read_psv(spark, tmp_dir, df.schema, **kw).collect())
    assert got() == ["", "N/A", "NA", "x"]
    assert got(na_tokens=("NA", "N/A")) == ["", "", "", "x"]


def test_rows_of_many_files_are_not_dealt_anew(spark, tmp_dir):
    """A source of as many files as cores is landed and staged without a shuffle
    of its rows; the rows of one file are still spread."""
    n = spark.sparkContext.defaultParallelism
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = spark.range(50 * n).selectExpr("id as a", "cast(id as string) as b")
    for name, files in (("many", n), ("one", 1)):
        rows.repartition(files).write.parquet(f"{tmp_dir}/{name}")
    many, one = (spark.read.schema(schema).parquet(f"{tmp_dir}/{name}") for name in ("many", "one"))
    landed = read_psv(spark, land_psv(many, f"{tmp_dir}/landed"), schema)
    assert len(landed.inputFiles()) == n
    store = TableStore(spark, f"{tmp_dir}/store", schemas={"x": schema})
    staged = load_staging(store, {"x": (landed, schema)})["x"]
    assert len(staged.inputFiles()) == n
    assert sorted(staged.collect()) == sorted(rows.collect())
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "REBALANCE" in plan(dealt_evenly(one)) and "REBALANCE" not in plan(dealt_evenly(many))


def test_parsed_text_is_evaluated_once(spark):
    """The check for unreadable text does not parse it again."""
    rows = spark.range(1).select(F.col("id").cast("string").alias("t"))
    plan = rows.select(or_raise(F.col("t"), F.try_to_timestamp("t", F.lit("yyyy")), "time").alias("x"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp") == 1


def test_counts_are_read_as_before(spark):
    texts = ["7", " 7 ", "+7", "-7", "5.0", "1e3", "", "  ", None, "9223372036854775807"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["n"] for r in rows.select("i", parse_number("t", T.LongType()).alias("n")).orderBy("i").collect()]
    assert got == [7, 7, 7, -7, 5, 1000, None, None, None, 9223372036854775807]
    for text in ("x", "1.5", "9223372036854775808", "0x10", "1L"):
        with pytest.raises(Exception):
            spark.createDataFrame([(text,)], "t string").select(parse_number("t", T.LongType())).collect()
