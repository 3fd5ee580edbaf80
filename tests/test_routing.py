import datetime as dt

from locus.operators.covid import conform_covid, covid_batch
from locus.operators.mobility import conform_mobility, conform_mobility_all, latest_mobility, latest_mobility_all
from locus.plans import jobs
from locus.schemas import COVID_STAGING, LOCATION_LOOKUP, MOBILITY_STAGING
from locus.session import materialize
from locus.sources.tables import TableStore

D = dt.date


def dim(spark):
    rows = [
        (1, "US", None, "US", None, None, None),
        (2, "US", None, "US", "Texas", None, None),
        (3, "US", None, "US", "Texas", "Travis", 48453),
        (4, "FR", None, "France", None, None, None),
        (5, "FR", None, "France", "Ile", None, None),
        (6, "FR", None, "France", "Ile", "Paris", None),
    ]
    return spark.createDataFrame([r + (None, None, None, None) for r in rows], LOCATION_LOOKUP)


def covid(spark, data):
    full = [(None, a2, p, c, None, None, None, 1, 1, 1, 1.0, None, 1.0, 1.0, D(2020, 1, 1)) for c, p, a2 in data]
    return spark.createDataFrame(full, COVID_STAGING)


def ids(df):
    return sorted((r["location_identifier"], r["location_granularity"]) for r in df.collect())


def test_covid_levels(spark):
    cv = covid(spark, [
        ("US", None, None),  # US country row -> non-US fact
        ("US", "TEXAS", None),  # state, case-insensitive
        ("US", "texas", "TRAVIS"),  # county
        ("France", "ILE", None),  # non-US state
        ("France", "Ile", "Paris"),  # non-US county: dropped
        ("France", "Nowhere", None),  # unmatched: dropped
        ("France", None, None),
    ])
    assert ids(conform_covid(cv, dim(spark), "us")) == [(2, "state"), (3, "county")]
    assert ids(conform_covid(cv, dim(spark), "non_us")) == [(1, "country"), (4, "country"), (5, "state")]


def mob(spark, data):
    full = [(c, None, s1, s2, metro, iso, fips, D(2020, 1, 1), *([1.0] * 6)) for c, s1, s2, metro, iso, fips in data]
    return spark.createDataFrame(full, MOBILITY_STAGING)


def test_mobility_levels(spark):
    m = mob(spark, [
        ("US", None, None, None, None, None),  # US country row stays US
        ("US", "Texas", None, None, None, None),
        ("US", "Texas", "Travis", None, None, 48453.0),  # by code alone
        ("US", "Texas", "Travis", None, None, None),  # US county without code: no level
        ("US", "Texas", None, "metro", None, None),  # metro area: excluded
        ("FR", "Ile", "Paris", None, None, None),
        ("FR", "Ile", "Paris", None, "FR-75", None),  # ISO code on a county: excluded
        ("FR", "Ile", None, None, "FR-IDF", None),  # ISO code on a state: kept
        ("fr", None, None, None, None, None),  # code compared case-insensitively
    ])
    assert ids(conform_mobility(m, dim(spark), "us")) == [(1, "country"), (2, "state"), (3, "county")]
    assert ids(conform_mobility(m, dim(spark), "non_us")) == [(4, "country"), (5, "state"), (6, "county")]


def test_the_us_country_row_can_be_left_out(spark):
    from locus.operators.covid import route_covid

    df = spark.createDataFrame([("US", None, None), ("France", None, None), ("US", "Ohio", None), (None, None, None)],
                               "country_region string, province_state string, admin2 string")
    scopes = lambda **kw: [r["_scope"] for r in route_covid(df, **kw).collect()]
    assert scopes() == ["non_us", "non_us", "us", "non_us"]
    assert scopes(exclude_us_country=True)[:3] == [None, "non_us", "us"]


def test_places_of_one_name_meet_a_days_first_report_only(spark):
    """Each of twenty counties of one name gets the day's row; not all reports meet all of them."""
    rows = [(i, "FR", None, "France", "Ile", "Paris", None) for i in range(20)] + [
        (30, "US", None, "US", "Texas", "Travis", 48453), (31, "US", None, "US", "Texas", "Travis", 48453),
        (31, "US", None, "US", "Texas", None, None)]
    places = spark.createDataFrame([r + (None, None, None, None) for r in rows], LOCATION_LOOKUP)
    reports = [("FR", None, "Ile", "paris" if n % 2 else "Paris", None, None, None, D(2020, 1, 1 + n % 3), float(n) if n % 5
                else None, *([1.0] * 5)) for n in range(60)]
    reports += [("US", None, "Texas", None, None, None, f, D(2020, 1, 1), float(n), *([1.0] * 5))
                for n in range(6) for f in (None, 48453.0)]
    moves = spark.createDataFrame(reports, MOBILITY_STAGING)
    latest = latest_mobility_all(moves, places)
    got = latest.collect()
    assert sorted(map(str, got)) == sorted(map(str, latest_mobility(conform_mobility_all(moves, places)).collect()))
    paris = {(r["location_identifier"], r["file_date"]) for r in got if r["_scope"] == "non_us"}
    assert paris == {(i, D(2020, 1, d)) for i in range(20) for d in (1, 2, 3)}
    cv = covid(spark, [("US", "Texas", "Travis")] * 9 + [("US", "Texas", None)] * 9)
    cases = covid_batch(cv, places)
    assert sorted((r["location_identifier"], r["location_granularity"]) for r in cases.collect()) == [
        (30, "county"), (31, "county"), (31, "state")]
    for df in (latest, cases):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert any("Window [" in line for line in plan[next(i for i, line in enumerate(plan) if "Join " in line):])


def test_conformed_staging_is_distinct_before_reports_meet_their_places(spark, tmp_dir, monkeypatch):
    rows = [(i, "FR", None, "France", "Ile", "Paris", None) for i in range(20)] + [
        (30, "US", None, "US", "Texas", "Travis", 48453), (31, "US", None, "US", "Texas", "Travis", 48453)]
    places = spark.createDataFrame([r + (None, None, None, None) for r in rows], LOCATION_LOOKUP)
    moves = mob(spark, [("FR", "Ile", "Paris", None, None, None), ("FR", "ILE", "paris", None, None, None)] * 5
                + [("US", "Texas", "Travis", None, None, 48453.0), ("US", "Texas", "Travis", None, None, 48453.4)] * 5)
    written = []
    monkeypatch.setattr(jobs, "materialize", lambda df, name: written.append(materialize(df, name)) or written[-1])
    store = TableStore(spark, tmp_dir)
    jobs.publish_conformed(store, moves, places)
    assert [df.count() for df in written] == [2]  # not twenty or more
    for scope, n in (("us", 2), ("non_us", 20)):
        got = store.read(f"google_mobility_data_{scope}_staging")
        want = conform_mobility(moves, places, scope).select(*got.columns)
        assert got.count() == n and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
