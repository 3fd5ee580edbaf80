"""Registered queries: a Spark builder and a DuckDB oracle per name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locus.functions.recode import ADMIN2_RULES, recode
from locus.operators import analytics as A
from locus.operators.deltas import daily_deltas
from locus.operators.dml import conform, patch_rows
from locus.operators.locations import missing_locations, upsert_location_dim
from locus.operators.mobility import conform_mobility, mobility_batch, unmatched_mobility_places
from locus.operators.covid import covid_batch
from locus.operators.quality import quality_report
from locus.operators.totals import avg_mobility_kept
from locus.operators.quality import metrics_report
from locus.plans import oracle as O
from locus.plans.jobs import (
    LOOKUP_SOURCE_HEADER, SCOPES, SourceTemplates, read_lookup, gate_and_publish, kept_metrics, land_reports, run_backfill,
    run_backfill_bulk, run_historical, run_load, stage_fact_months,
)
from locus.plans.scenario import SPLIT_NEW, SPLIT_OLD, Scenario
from locus.schemas import (
    ALL_TABLES, CASE_REPORT_FIELDS, COVID_FACT, FACT_KEY, MOBILITY_MEASURES, MOBILITY_STAGING, TABLE_KEYS,
)
from locus.session import file_system, materialize, scratch_path
from locus.sources.readers import normalize_case_report, read_case_reports, read_psv
from locus.sources.tables import TableStore
from locus.sources.writers import land_json, land_psv
from locus.streaming.ingest import ingest_new_mobility, ingest_new_reports

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Scenario], DataFrame]) -> Callable[[Scenario], DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: fn(Scenario.shared(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


BASE = (O.ADAPTERS, O.LOOKUP_DIM, O.LOOKUP_FULL, O.RECODED_COVID)


def _sql(*ctes: str, body: str) -> str:
    return O.with_ctes(*BASE, *ctes) + body


# -- dimension ---------------------------------------------------------------

@register("location_dim_upsert", _sql(
    """
old_dim AS (SELECT location_identifier, iso2_code, iso3_code, country_region, province_or_state, county_or_city,
                   fips_code, location_latitude, location_longitude, location_name,
                   CAST(NULL AS DOUBLE) AS location_population FROM location_lookup),
staged_dim AS (SELECT DISTINCT uid AS location_identifier, iso2 AS iso2_code, iso3 AS iso3_code, country_region,
               province_state AS province_or_state, admin2 AS county_or_city, CAST(fips AS INTEGER) AS fips_code,
               latitude AS location_latitude, longitude AS location_longitude, combined_key AS location_name,
               population AS location_population FROM location_lookup_staging),
merged AS (""" + O.upsert_sql("old_dim", "staged_dim", ["location_identifier"]) + ")",
    body="""SELECT location_identifier, iso2_code, iso3_code, country_region, province_or_state,
       CASE WHEN location_identifier = 84036061 THEN 'New York City' ELSE county_or_city END AS county_or_city,
       fips_code, location_latitude, location_longitude,
       CASE WHEN location_identifier = 84036061 THEN 'New York, New York City, US' ELSE location_name END
         AS location_name, location_population
FROM merged"""))
def _location_dim_upsert(s: Scenario) -> DataFrame:
    stale = s.lookup.withColumn("location_population", F.lit(None).cast("double"))
    return upsert_location_dim(stale, s.lookup_staging)


@register("missing_locations", _sql(body="SELECT * FROM missing_locs"))
def _missing_locations(s: Scenario) -> DataFrame:
    return missing_locations(s.lookup_dim, s.mobility_staging)


# -- cleaning ------------------------------------------------------------------

# Raw county names fed to the correction rules: each (priority, status) pair
# of an order picks one probe: every rule value, NULL, the two conditional
# values again (their province test fails outside TN / AK), else the
# customer name (unmatched).
RECODE_PROBES: list[str | None] = [r.value for r in ADMIN2_RULES] + [None, "Unknown", "Lake and Peninsula"]
_STATUS_SLOT = {"F": 0, "O": 1, "P": 2}


def _probe_index_spark():
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return (F.substring("o_orderpriority", 1, 1).cast("int") - 1) * 3 + status


def _probe_index_sql() -> str:
    return ("((CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) * 3 + "
            "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END)")


def _probe_case_sql() -> str:
    def q(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(RECODE_PROBES))
    return f"CASE {_probe_index_sql()} {whens} ELSE c_name END"


@register("recode_admin2", _sql(
    f"""
rc_src AS (SELECT o_orderkey, province AS province_state, {_probe_case_sql()} AS admin2_raw FROM covid_src),
rc_fixed AS ({O.corrected_sql('(SELECT *, admin2_raw AS admin2 FROM rc_src)', 'admin2')})""",
    body="SELECT o_orderkey, province_state, admin2_raw, admin2 FROM rc_fixed"))
def _recode_admin2(s: Scenario) -> DataFrame:
    o = s.src.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = s.src.table("customer", "c_custkey", "c_name", "c_nationkey")
    idx = _probe_index_spark()
    probe = None
    for i, v in enumerate(RECODE_PROBES):
        probe = (F.when if probe is None else probe.when)(idx == i, F.lit(v))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(s.src.geo, F.col("c_nationkey") == F.col("n_nationkey"))
    raw = rows.select("o_orderkey", F.col("province").alias("province_state"),
                      probe.otherwise(F.col("c_name")).alias("admin2_raw"))
    return recode(raw.withColumn("admin2", F.col("admin2_raw")), "admin2")


# -- mobility ------------------------------------------------------------------

for _scope in ("us", "non_us"):
    def _conformed(s: Scenario, scope=_scope) -> DataFrame:
        return conform_mobility(s.mobility_staging, s.lookup, scope)

    def _mfact(s: Scenario, scope=_scope) -> DataFrame:
        return s.mobility_fact(scope)

    register(f"mobility_{_scope}_conformed", _sql(
        body=O.mobility_conformed_sql("google_mobility_data_staging", _scope)))(_conformed)
    register(f"mobility_{_scope}_fact", _sql(
        O.mobility_fact_ctes(_scope), body=f"SELECT * FROM mobility_{_scope}"))(_mfact)


@register("fact_upsert", _sql(
    f"""
fu_old AS (SELECT * FROM google_mobility_data_staging WHERE date < {O.SPLIT_OLD}),
fu_new AS (SELECT country_region_code, country_region, sub_region_1, sub_region_2, metro_area, iso_3166_2_code,
                  census_fips_code, date, {', '.join(MOBILITY_MEASURES[:5])},
                  {MOBILITY_MEASURES[5]} + 1.0 AS {MOBILITY_MEASURES[5]}
           FROM google_mobility_data_staging WHERE date >= {O.SPLIT_NEW}),
fu_final AS ({O.mobility_batch_sql('fu_old', 'non_us')}),
fu_batch AS ({O.mobility_batch_sql('fu_new', 'non_us')})""",
    body=O.upsert_sql("fu_final", "fu_batch", FACT_KEY)))
def _fact_upsert(s: Scenario) -> DataFrame:
    """Keyed upsert through the table store where the batch corrects a
    measure: overlapping days take the corrected values, older days keep the
    existing ones, and only the batch's months are rewritten."""
    mob, table = s.mobility_staging, "google_mobility_data_non_us"
    last = MOBILITY_MEASURES[5]
    store = TableStore(s.spark, scratch_path(s.spark, "upsert"))
    for rows in (mob.filter(F.col("date") < F.lit(SPLIT_OLD)),
                 mob.filter(F.col("date") >= F.lit(SPLIT_NEW)).withColumn(last, F.col(last) + F.lit(1.0))):
        batch = materialize(mobility_batch(rows, s.lookup, "non_us"), "upsert_batch")
        gate_and_publish(store, {table: stage_fact_months(store, table, batch, with_deltas=False)})
    return store.read(table)


# -- covid ---------------------------------------------------------------------

for _scope in ("us", "non_us"):
    def _cfact(s: Scenario, scope=_scope) -> DataFrame:
        return s.covid_fact(scope)

    register(f"covid_{_scope}_fact", _sql(
        O.covid_fact_ctes(_scope), body=f"SELECT * FROM covid_{_scope}"))(_cfact)


@register("daily_deltas", _sql(
    f"""
dd_batch AS ({O.covid_batch_sql('covid_fixed', 'us')}
  UNION ALL {O.covid_batch_sql('covid_fixed', 'non_us')})""",
    body=O.deltas_sql("dd_batch")))
def _daily_deltas(s: Scenario) -> DataFrame:
    """Whole history in one batch, both scopes, deltas per location."""
    return daily_deltas(covid_batch(s.covid_fixed, s.lookup).drop("_scope"))


# -- analytics -----------------------------------------------------------------

def _top_sql(fact: str, granularity: str, names: dict[str, str], by: list[str], total: str, n: int) -> str:
    """The n names with most new cases: summed per location, then per name."""
    shown = ", ".join(f"{c} AS {alias}" for c, alias in names.items())
    order = ", ".join(f"{alias} NULLS LAST" for alias in names.values())
    return f"""WITH per_place AS (
  SELECT location_identifier, sum(new_confirmed_cases) AS n FROM {fact}
  WHERE location_granularity = '{granularity}' GROUP BY location_identifier),
named AS (
  SELECT {', '.join(by)}, sum(n) AS n
  FROM per_place LEFT JOIN location_lookup USING (location_identifier) GROUP BY {', '.join(by)})
SELECT {shown}, CAST(n AS BIGINT) AS {total} FROM named
ORDER BY {total} DESC NULLS FIRST, {order} LIMIT {n}"""


def _nested(*ctes: str, body: str) -> str:
    """A body that has CTEs of its own, after the shared ones."""
    own, _, rest = body.removeprefix("WITH ").partition("\nSELECT ")
    return _sql(*ctes, own, body="SELECT " + rest)


@register("top_countries", _nested(O.covid_fact_ctes("non_us"), body=_top_sql(
    "covid_non_us", "country", {"country_region": "country"}, ["country_region"], "total_cases", 5)))
def _top_countries(s: Scenario) -> DataFrame:
    return A.top_countries(s.covid_fact("non_us"), s.lookup)


@register("top_us_counties", _nested(O.covid_fact_ctes("us"), body=_top_sql(
    "covid_us", "county", {"county_or_city": "county", "province_or_state": "state"},
    ["county_or_city", "province_or_state", "country_region"], "ttl_confirmed_cases", 10)))
def _top_us_counties(s: Scenario) -> DataFrame:
    return A.top_us_counties(s.covid_fact("us"), s.lookup)


# -- unmatched places ----------------------------------------------------------

@register("unmatched_locations", _sql(body=O.unmatched_sql("google_mobility_data_staging", "lookup_dim")))
def _unmatched(s: Scenario) -> DataFrame:
    """Places the loaded dimension does not know yet (before the insert of
    missing places): these rows would vanish from the mobility facts."""
    return unmatched_mobility_places(s.mobility_staging, s.lookup_dim)


# -- quality and table statistics ----------------------------------------------

FACT_CTES = tuple(O.covid_fact_ctes(x) for x in ("us", "non_us")) + tuple(
    O.mobility_fact_ctes(x) for x in ("us", "non_us"))
FINAL_SQL = {
    "location_lookup": "location_lookup",
    "covid_data_us": "covid_us",
    "covid_data_non_us": "covid_non_us",
    "google_mobility_data_us": "mobility_us",
    "google_mobility_data_non_us": "mobility_non_us",
}


def _dq_sql() -> str:
    parts = []
    for table, cte in sorted(FINAL_SQL.items()):
        keys = TABLE_KEYS[table]
        any_null = " OR ".join(f"{k} IS NULL" for k in keys)
        tup = keys[0] if len(keys) == 1 else "(" + ", ".join(keys) + ")"
        distinct = f"count(DISTINCT CASE WHEN NOT ({any_null}) THEN {tup} END)"
        parts.append(f"""
  SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows,
         CAST(count(*) FILTER (WHERE {any_null}) AS BIGINT) AS null_keys,
         CAST(count(*) FILTER (WHERE NOT ({any_null})) - {distinct} AS BIGINT) AS duplicate_keys
  FROM {cte}""")
    return " UNION ALL".join(parts)


@register("dq_report", _sql(*FACT_CTES, f"m AS ({_dq_sql()})", body="""
SELECT table_name, 'has_rows' AS check_name, n_rows AS value, n_rows >= 1 AS passed FROM m
UNION ALL SELECT table_name, 'check_nulls', null_keys, null_keys = 0 FROM m
UNION ALL SELECT table_name, 'check_duplicates', duplicate_keys, duplicate_keys = 0 FROM m"""))
def _dq_report(s: Scenario) -> DataFrame:
    return quality_report(s.final_tables(), TABLE_KEYS)


@register("table_counts", _sql(*FACT_CTES, body=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS count_of_records FROM {c}"
    for t, c in sorted(FINAL_SQL.items()))))
def _table_counts(s: Scenario) -> DataFrame:
    return A.table_counts(s.final_tables())


@register("distinct_keys", _sql(*FACT_CTES, body=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(DISTINCT "
    + ("location_identifier" if t == "location_lookup" else "(location_identifier, file_date)")
    + f") AS BIGINT) AS count_of_distinct_primary_key FROM {c}"
    for t, c in sorted(FINAL_SQL.items()))))
def _distinct_keys(s: Scenario) -> DataFrame:
    return A.distinct_keys(s.final_tables(), TABLE_KEYS)


@register("latest_dates", _sql(*FACT_CTES, body=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, max(file_date) AS max_file_date FROM {c}"
    for t, c in sorted(FINAL_SQL.items()) if t != "location_lookup")))
def _latest_dates(s: Scenario) -> DataFrame:
    return A.latest_dates(s.final_tables())


# -- incident rate and mobility ------------------------------------------------

def _rate_sql(fact: str, gran: str, name_col: str, alias: str) -> str:
    return f"""
  SELECT ll.{name_col} AS {alias}, t.location_identifier, t.file_date AS latest_file_date, t.ttl_confirmed_cases,
         ll.location_population AS population,
         round(CAST(t.ttl_confirmed_cases AS DOUBLE) / NULLIF(ll.location_population, 0) * 100, 6)
           AS incident_rate_pct
  FROM (SELECT location_identifier, file_date, ttl_confirmed_cases,
               row_number() OVER (PARTITION BY location_identifier ORDER BY file_date DESC NULLS FIRST,
                                  ttl_confirmed_cases DESC NULLS FIRST) AS rn
        FROM {fact} WHERE location_granularity = '{gran}') t
  LEFT JOIN location_lookup ll ON ll.location_identifier = t.location_identifier
  WHERE t.rn = 1"""


def _avg_sql(fact: str, gran: str, name_col: str, alias: str) -> str:
    avgs = ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in MOBILITY_MEASURES)
    return f"""
  SELECT a.*, ll.{name_col} AS {alias}
  FROM (SELECT location_identifier, {avgs}, CAST(count(*) AS BIGINT) AS days
        FROM {fact} WHERE location_granularity = '{gran}' GROUP BY location_identifier) a
  LEFT JOIN location_lookup ll ON ll.location_identifier = a.location_identifier"""


RATE_STATE = _rate_sql("covid_us", "state", "province_or_state", "state")


@register("incident_rate_by_state", _sql(O.covid_fact_ctes("us"), body=RATE_STATE))
def _rate_by_state(s: Scenario) -> DataFrame:
    return A.incident_rate_by_state(s.covid_fact("us"), s.lookup)


@register("incident_rate_extremes", _sql(O.covid_fact_ctes("us"), f"r AS ({RATE_STATE})", body="""
SELECT side, CAST(rank AS INTEGER) AS rank, state, location_identifier, incident_rate_pct FROM (
  SELECT 'top' AS side, row_number() OVER (ORDER BY incident_rate_pct DESC, state ASC NULLS LAST,
         location_identifier ASC) AS rank, state, location_identifier, incident_rate_pct
  FROM r WHERE incident_rate_pct IS NOT NULL
  UNION ALL
  SELECT 'bottom', row_number() OVER (ORDER BY incident_rate_pct ASC, state ASC NULLS LAST,
         location_identifier ASC), state, location_identifier, incident_rate_pct
  FROM r WHERE incident_rate_pct IS NOT NULL) x
WHERE rank <= 5"""))
def _rate_extremes(s: Scenario) -> DataFrame:
    return A.incident_rate_extremes(A.incident_rate_by_state(s.covid_fact("us"), s.lookup))


@register("avg_mobility_by_state", _sql(
    O.mobility_fact_ctes("us"), body=_avg_sql("mobility_us", "state", "province_or_state", "state")))
def _avg_mobility(s: Scenario) -> DataFrame:
    return A.avg_mobility_by_state(s.mobility_fact("us"), s.lookup)


@register("parks_vs_incident", _sql(
    O.covid_fact_ctes("us"), O.mobility_fact_ctes("us"),
    f"r AS ({RATE_STATE})", f"a AS ({_avg_sql('mobility_us', 'state', 'province_or_state', 'state')})",
    body="""SELECT r.location_identifier, r.state, r.incident_rate_pct, a.avg_parks_percent_change_from_baseline
FROM r JOIN a ON r.location_identifier = a.location_identifier"""))
def _parks_vs_incident(s: Scenario) -> DataFrame:
    return A.parks_vs_incident(s.covid_fact("us"), s.mobility_fact("us"), s.lookup)


@register("country_profile", _sql(
    O.covid_fact_ctes("non_us"), O.mobility_fact_ctes("non_us"),
    f"r AS ({_rate_sql('covid_non_us', 'country', 'country_region', 'country')})",
    f"a AS ({_avg_sql('mobility_non_us', 'country', 'country_region', 'country')})",
    body=f"""SELECT r.*, {', '.join('a.avg_' + m for m in MOBILITY_MEASURES)}, a.days
FROM r LEFT JOIN a ON r.location_identifier = a.location_identifier"""))
def _country_profile(s: Scenario) -> DataFrame:
    return A.country_profile(s.covid_fact("non_us"), s.mobility_fact("non_us"), s.lookup)


@register("covid_mobility_trend", _sql(*FACT_CTES, body=f"""
SELECT c.location_identifier, c.file_date, c.location_granularity, c.ttl_confirmed_cases, c.new_confirmed_cases,
       {', '.join('m.' + x for x in MOBILITY_MEASURES)}
FROM (SELECT * FROM covid_us UNION ALL SELECT * FROM covid_non_us) c
JOIN (SELECT * FROM mobility_us UNION ALL SELECT * FROM mobility_non_us) m
  ON c.location_identifier = m.location_identifier AND c.file_date = m.file_date"""))
def _trend(s: Scenario) -> DataFrame:
    covid = s.covid_fact("us").unionByName(s.covid_fact("non_us"))
    mob = s.mobility_fact("us").unionByName(s.mobility_fact("non_us"))
    return A.covid_mobility_trend(covid, mob)


@register("covid_mobility_trend_bucketed", _SQL["covid_mobility_trend"])
def _trend_bucketed(s: Scenario) -> DataFrame:
    """Cases and mobility side by side from loaded facts that are bucketed by
    location: joined without a shuffle of a fact."""
    return A.covid_mobility_trend_colocated(
        *[[s.bucketed.read(f"{kind}_{scope}") for scope in SCOPES] for kind in ("covid_data", "google_mobility_data")])


@register("daily_deltas_bucketed", _sql(*[O.covid_fact_ctes(x) for x in SCOPES], body="""
SELECT * FROM covid_us UNION ALL SELECT * FROM covid_non_us"""))
def _deltas_bucketed(s: Scenario) -> DataFrame:
    """Deltas computed anew over all loaded days, a window per bucket: what
    the loads have kept by month carry."""
    us, non_us = (daily_deltas(s.bucketed.read(f"covid_data_{scope}")) for scope in SCOPES)
    return us.unionByName(non_us)


# -- sources and sinks ---------------------------------------------------------

def _raw_reports(s: Scenario) -> DataFrame:
    """Case reports as sources have published them: older header spellings and
    three timestamp layouts, all text."""
    ts, slot = F.col("last_update_dts"), F.col("deaths") % 3
    raw_ts = (F.when(slot == 0, F.date_format(ts, "M/d/yyyy H:mm")).when(slot == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
              .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    old = {"Province_State": "Province/State", "Country_Region": "Country/Region", "Last_Update": "Last Update"}
    cols = [(raw_ts if dst == "last_update_dts" else F.col(dst)).alias(old.get(src, src))
            for src, dst in CASE_REPORT_FIELDS.items()]
    return s.covid_staging.select(*cols)


def _normalized(s: Scenario) -> DataFrame:
    raw = _raw_reports(s).withColumnRenamed("file_date", "_fd")
    return normalize_case_report(raw, F.col("_fd")).drop("_fd")


_NORMALIZED_SQL = """SELECT fips AS "FIPS", admin2 AS "Admin2", province_state AS "Province_State",
       country_region AS "Country_Region", strftime(last_update_dts, '%Y-%m-%d %H:%M:%S') AS "Last_Update",
       latitude AS "Lat", longitude AS "Long_", confirmed AS "Confirmed", deaths AS "Deaths",
       recovered AS "Recovered", active AS "Active", combined_key AS "Combined_Key",
       incident_rate AS "Incident_Rate", case_fatality_ratio AS "Case_Fatality_Ratio",
       strftime(file_date, '%m-%d-%Y') AS file_date
FROM covid_data_staging"""


@register("unify_headers", _sql(body=_NORMALIZED_SQL))
def _unify_headers(s: Scenario) -> DataFrame:
    """Raw reports with older headers and timestamp layouts -> the landed
    layout (header aliases unified, one timestamp format, file date text)."""
    return _normalized(s)


@register("json_report_roundtrip", _sql(body="SELECT * FROM covid_data_staging"))
def _json_roundtrip(s: Scenario) -> DataFrame:
    """Normalise -> land JSON lines -> read back into typed staging rows;
    equals the staging view. The column with gaps is landed as floats."""
    floats = _normalized(s).withColumn("Recovered", F.col("Recovered").cast("double"))
    return read_case_reports(s.spark, land_json(floats, scratch_path(s.spark, "covid_json")))


@register("report_load", _sql(body="SELECT * FROM covid_data_staging"))
def _report_load(s: Scenario) -> DataFrame:
    """Reports of another layout: other keys (mapped to staging columns by the
    reader's argument), text values, empty text for what is missing, counts
    written as floats and several timestamp layouts."""
    keys = {dst: f"k_{dst}" for dst in CASE_REPORT_FIELDS.values()}
    raw = _raw_reports(s).toDF(*CASE_REPORT_FIELDS.values()).withColumns({
        "confirmed": F.concat("confirmed", F.lit(".0")), "file_date": F.date_format("file_date", "MM-dd-yyyy")})
    texts = raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(keys[c]) for c in raw.columns])
    path = land_json(texts, scratch_path(s.spark, "other_json"))
    return read_case_reports(s.spark, path, {k: dst for dst, k in keys.items()})


@register("land_and_load", _sql(
    body="SELECT * REPLACE (CAST(date_trunc('year', file_date) AS DATE) AS file_date) FROM covid_data_staging"))
def _land_and_load(s: Scenario) -> DataFrame:
    """The landing job: raw comma CSV files, one per report day (here one a
    year), -> normalised JSON per day -> staging rows."""
    raw, landed = (scratch_path(s.spark, n) for n in ("raw", "landed"))
    day = F.date_format(F.trunc("file_date", "year"), "MM-dd-yyyy")
    reports = _raw_reports(s).withColumn("day", day).drop("file_date")
    reports.write.partitionBy("day").option("header", True).csv(raw)
    days = [dt.datetime.strptime(r[0], "%m-%d-%Y").date() for r in reports.select("day").distinct().collect()]
    paths = land_reports(s.spark, raw + "/day={file_date}", landed + "/{file_date}", days)
    return read_case_reports(s.spark, paths)


@register("psv_roundtrip", _sql(body="SELECT * FROM location_lookup_staging"))
def _psv_roundtrip(s: Scenario) -> DataFrame:
    """Lookup landed as gzip pipe-delimited text under its source header
    (names hold commas) -> header-checked positional read into the staging
    schema; equals the staging view."""
    return read_lookup(s.spark, _landed_lookup(s))


def _landed_lookup(s: Scenario, rows: DataFrame | None = None) -> str:
    rows = s.lookup_staging if rows is None else rows
    return land_psv(rows.toDF(*LOOKUP_SOURCE_HEADER), scratch_path(s.spark, "lookup_psv"))


# -- loads ---------------------------------------------------------------------

def _historical(s: Scenario) -> TableStore:
    """A whole load from landed files into a store with all tables, staging kept."""
    store = TableStore(s.spark, scratch_path(s.spark, "historical"))
    store.create_all()
    covid = land_json(_normalized(s), scratch_path(s.spark, "covid_json"), compression="gzip")
    mobility = land_psv(s.mobility_staging, scratch_path(s.spark, "mobility_psv"))
    run_load(s.spark, store, read_case_reports(s.spark, covid), read_lookup(s.spark, _landed_lookup(s)),
             read_psv(s.spark, mobility, MOBILITY_STAGING), keep_staging=True)
    return store


@register("staging_load", _sql(body=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS count_of_records FROM {x}" for t, x in {
        "location_lookup_staging": "location_lookup_staging", "covid_data_staging": "covid_data_staging",
        "google_mobility_data_staging": "google_mobility_data_staging", "location_lookup": "location_lookup",
        **{f"google_mobility_data_{c}_staging": f"({O.mobility_conformed_sql('google_mobility_data_staging', c)})"
           for c in ("us", "non_us")},
        **{f"google_mobility_data_{c}": f"({O.mobility_batch_sql('google_mobility_data_staging', c)})"
           for c in ("us", "non_us")},
        **{f"covid_data_{c}": f"({O.covid_batch_sql('covid_fixed', c)})" for c in ("us", "non_us")},
    }.items())))
def _staging_load(s: Scenario) -> DataFrame:
    """Landed files -> staging -> finals: the rows of all ten tables."""
    store = _historical(s)
    return A.table_counts({t: store.read(t) for t in ALL_TABLES})


_LISTED = {t: FINAL_SQL.get(t) for t in sorted(ALL_TABLES) if t != "covid_data_staging"}


@register("table_list", _sql(*FACT_CTES, body=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, " + (
        "CAST(0 AS BIGINT) AS count_of_records, CAST(NULL AS DATE) AS max_file_date" if cte is None else
        f"CAST(count(*) AS BIGINT) AS count_of_records, "
        f"{'max(file_date)' if cte != 'location_lookup' else 'CAST(NULL AS DATE)'} AS max_file_date FROM {cte}")
    for t, cte in _LISTED.items())))
def _table_list(s: Scenario) -> DataFrame:
    """Tables created up front, the finals loaded, one dropped: those that are
    there, by name, with their rows and latest day."""
    store = TableStore(s.spark, scratch_path(s.spark, "created"))
    store.create_all()
    store.commit([store.stage(t, df) for t, df in s.final_tables().items()])
    store.drop("covid_data_staging")
    names = [r[0] for r in store.list_tables().collect()]  # a handful
    tables = {t: store.read(t) for t in names}
    return store.list_tables().join(A.table_counts(tables), "table_name").join(
        A.latest_dates(tables), "table_name", "left")


@register("backfill_load", O.with_ctes(
    O.ADAPTERS, O.LOOKUP_DIM, f"""
mb_1 AS (SELECT * FROM google_mobility_data_staging WHERE date < {O.SPLIT_OLD}),
mb_2 AS (SELECT * FROM google_mobility_data_staging WHERE date >= {O.SPLIT_NEW}),
new_1 AS ({O.missing_sql('lookup_dim', 'mb_1')}),
dim_1 AS (SELECT * FROM lookup_dim UNION ALL SELECT * FROM new_1),
staged_2 AS (SELECT * REPLACE (location_population + 1 AS location_population) FROM lookup_dim),
merged_2 AS ({O.upsert_sql('dim_1', 'staged_2', ['location_identifier'])}),
new_2 AS ({O.missing_sql('merged_2', 'mb_2')})""") + "SELECT * FROM merged_2 UNION ALL SELECT * FROM new_2")
def _backfill_load(s: Scenario) -> DataFrame:
    """Two days loaded by one call, each with its own three files: the
    dimension takes the second day's attributes and, after the first day's new
    places, the second day's."""
    root = scratch_path(s.spark, "backfill")
    days = [dt.date(2021, 3, 1), dt.date(2021, 3, 2)]
    templates = SourceTemplates(**{n: f"{root}/{n}_{{file_date}}" for n in ("covid", "lookup", "mobility")})
    reports, staged, mob = _normalized(s), s.lookup_staging, s.mobility_staging
    day = F.to_date("file_date", "MM-dd-yyyy")
    parts = [
        (reports.filter(day < F.lit(SPLIT_OLD)), staged, mob.filter(F.col("date") < F.lit(SPLIT_OLD))),
        (reports.filter(day >= F.lit(SPLIT_NEW)), staged.withColumn("population", F.col("population") + 1),
         mob.filter(F.col("date") >= F.lit(SPLIT_NEW))),
    ]
    for when, (covid, lookup, mobility) in zip(days, parts):
        name = when.strftime("%m-%d-%Y")
        land_json(covid, f"{root}/covid_{name}")
        land_psv(lookup.toDF(*LOOKUP_SOURCE_HEADER), f"{root}/lookup_{name}")
        land_psv(mobility, f"{root}/mobility_{name}")
    store = TableStore(s.spark, f"{root}/warehouse")
    run_backfill(s.spark, store, days, templates)
    return store.read("location_lookup")


_BOTH_CASE_FACTS = O.deltas_sql(
    f"({O.covid_batch_sql('covid_fixed', 'us')} UNION ALL {O.covid_batch_sql('covid_fixed', 'non_us')}) b")
BULK_DAYS = [dt.date(2021, 3, 1) + dt.timedelta(days=i) for i in range(30)]
BULK_OFFSET = 1000


def _landed_days(s: Scenario) -> SourceTemplates:
    """Thirty days' files: a month's reports and mobility on one day, and on
    each day a lookup, whose populations change on the sixteenth."""
    root = scratch_path(s.spark, "bulk")

    def dated(df: DataFrame, date) -> DataFrame:
        month = (F.year(date) - 1992) * 12 + F.month(date) - 1
        day = F.date_add(F.lit(BULK_DAYS[0]), F.pmod(month, F.lit(len(BULK_DAYS))).cast("int"))
        return df.withColumn("day", F.date_format(day, "MM-dd-yyyy"))

    land_json(dated(_normalized(s), F.to_date("file_date", "MM-dd-yyyy")), f"{root}/covid", partition_by="day",
              compression="gzip")
    land_psv(dated(s.mobility_staging, F.col("date")), f"{root}/mobility", partition_by="day")
    nth = F.explode(F.sequence(F.lit(0), F.lit(len(BULK_DAYS) - 1)))
    lookup = s.lookup_staging.withColumn("nth", nth)
    lookup = lookup.withColumn("population", F.col("population") + (F.col("nth") >= 15).cast("int")).withColumn(
        "day", F.date_format(F.date_add(F.lit(BULK_DAYS[0]), F.col("nth")), "MM-dd-yyyy")).drop("nth")
    land_psv(lookup.toDF(*LOOKUP_SOURCE_HEADER, "day"), f"{root}/lookup", partition_by="day")
    return SourceTemplates(*[f"{root}/{n}/day={{file_date}}" for n in ("covid", "lookup", "mobility")])


def _bulk(s: Scenario) -> TableStore:
    store = TableStore(s.spark, scratch_path(s.spark, "bulk_store"))
    run_backfill_bulk(s.spark, store, BULK_DAYS, _landed_days(s), key_offset=BULK_OFFSET)
    return store


@register("backfill_bulk", _sql(body=_BOTH_CASE_FACTS))
def _backfill_bulk(s: Scenario) -> DataFrame:
    """Thirty days by one load: both case facts equal loads one after the other."""
    store = _bulk(s)
    return store.read("covid_data_us").unionByName(store.read("covid_data_non_us"))


@register("backfill_bulk_dimension", O.with_ctes(O.ADAPTERS, O.LOOKUP_DIM, f"""
bd_new AS ({O.missing_sql('lookup_dim', 'google_mobility_data_staging')}),
bd_day AS (
  SELECT country_region_code, country_region, sub_region_1, sub_region_2,
         min(((year(date) - 1992) * 12 + month(date) - 1) % {len(BULK_DAYS)}) AS day
  FROM google_mobility_data_staging WHERE sub_region_2 IS NOT NULL AND census_fips_code IS NULL GROUP BY ALL),
bd_id AS (
  SELECT (SELECT max(location_identifier) FROM lookup_dim) + {BULK_OFFSET} * dense_rank() OVER (ORDER BY day)
           + row_number() OVER (ORDER BY day, iso2_code NULLS LAST, province_or_state NULLS LAST, county_or_city,
                                n.country_region NULLS LAST) AS id, n.*
  FROM bd_new n JOIN bd_day d
    ON n.iso2_code IS NOT DISTINCT FROM d.country_region_code AND n.country_region = d.country_region
   AND n.province_or_state IS NOT DISTINCT FROM d.sub_region_1 AND n.county_or_city = d.sub_region_2)""")
    + """SELECT * REPLACE (location_population + 1 AS location_population) FROM lookup_dim
UNION ALL SELECT * EXCLUDE (id) REPLACE (CAST(id AS INTEGER) AS location_identifier) FROM bd_id""")
def _backfill_bulk_dimension(s: Scenario) -> DataFrame:
    """The dimension after the thirty days: the last lookup's attributes, and
    new places under the ids that each day's load would give them."""
    return _bulk(s).read("location_lookup")


@register("historical_load", _sql(body=_BOTH_CASE_FACTS))
def _historical_load(s: Scenario) -> DataFrame:
    """All past report files under one prefix, with one lookup and mobility file."""
    root = scratch_path(s.spark, "prefix")
    year = F.substring("file_date", -4, 4)
    land_json(_normalized(s).withColumn("covid", year), f"{root}/covid", partition_by="covid")
    land_psv(s.mobility_staging, f"{root}/mobility")
    store = TableStore(s.spark, f"{root}/store")
    run_historical(s.spark, store, f"{root}/covid/covid*", _landed_lookup(s), f"{root}/mobility")
    return store.read("covid_data_us").unionByName(store.read("covid_data_non_us"))


@register("refused_load", _sql(body="""SELECT 'no_reports' AS load, true AS refused, CAST(0 AS BIGINT) AS places
UNION ALL SELECT 'place_twice', true, 0
UNION ALL SELECT 'good', false, count(*) FROM location_lookup
UNION ALL SELECT 'place_twice_later', true, count(*) FROM location_lookup"""))
def _refused_load(s: Scenario) -> DataFrame:
    """A load whose reports are empty and one whose lookup holds a place twice
    are refused and leave the tables as they were; the good one is published."""
    store = TableStore(s.spark, scratch_path(s.spark, "refused"))
    covid = read_case_reports(s.spark, land_json(_normalized(s), scratch_path(s.spark, "covid_json"), compression="gzip"))
    again = s.lookup_staging.filter("uid = 1").withColumn("latitude", F.col("latitude") + 1)
    twice = s.lookup_staging.unionByName(again)
    out = []
    for name, reports, lookup in (("no_reports", covid.limit(0), s.lookup_staging), ("place_twice", covid, twice),
                                  ("good", covid, s.lookup_staging), ("place_twice_later", covid, twice)):
        try:
            run_load(s.spark, store, reports, lookup, s.mobility_staging)
            refused = False
        except ValueError:
            refused = True
        out.append(store.read("location_lookup").agg(F.count(F.lit(1)).alias("places")).select(
            F.lit(name).alias("load"), F.lit(refused).alias("refused"), "places"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


_STREAMED = (("1", "date < DATE '1996-01-01'"), ("2", f"date >= DATE '1995-07-01' AND date < {O.SPLIT_OLD}"),
             ("3", f"date >= {O.SPLIT_NEW}"))


@register("stream_mobility", O.with_ctes(O.ADAPTERS, O.LOOKUP_DIM, ",".join(f"""
mb_{n} AS (SELECT * FROM google_mobility_data_staging WHERE {drop}),
new_{n} AS ({O.missing_sql(before, f'mb_{n}')}),
dim_{n} AS (SELECT * FROM {before} UNION ALL SELECT * FROM new_{n})"""
    for (n, drop), before in zip(_STREAMED, ("lookup_dim", "dim_1", "dim_2"))),
    "location_lookup AS (SELECT * FROM dim_3)") + " UNION ALL ".join(
    f"SELECT '{x}' AS scope, * FROM ({O.mobility_batch_sql('google_mobility_data_staging', x)})" for x in ("us", "non_us")))
def _stream_mobility(s: Scenario) -> DataFrame:
    """Mobility arrives in three drops that overlap. Each run of the stream
    loads the new files: places that only they know get ids, both facts are
    merged, and one commit publishes them with the batch's number. After the
    second drop the stream's own note of its batch is lost, so Spark runs that
    batch again, and the ledger knows it."""
    root = scratch_path(s.spark, "moves")
    store, landing, ckpt = TableStore(s.spark, f"{root}/store"), f"{root}/landing", f"{root}/checkpoint"
    store.publish("location_lookup", s.lookup_dim)
    for n, drop in _STREAMED:
        land_psv(s.mobility_staging.filter(drop), f"{landing}/{n}")
        ingest_new_mobility(s.spark, f"{landing}/*", store, ckpt)
        if n == "2":
            fs, note = file_system(s.spark, f"{ckpt}/commits/1")
            fs.delete(note, False)
            ingest_new_mobility(s.spark, f"{landing}/*", store, ckpt)
    return store.read("google_mobility_data_us").withColumn("scope", F.lit("us")).unionByName(
        store.read("google_mobility_data_non_us").withColumn("scope", F.lit("non_us")))


@register("stream_ingest", _sql(body=_BOTH_CASE_FACTS))
def _stream_ingest(s: Scenario) -> DataFrame:
    """Landed daily reports arrive in three drops, the first without a row for
    the non-US fact; each availableNow run of the stream loads only the new
    files (foreachBatch: recode -> dedup -> upsert -> deltas -> gate ->
    publish). Both facts equal a one-shot load."""
    landing = scratch_path(s.spark, "landing")
    store = TableStore(s.spark, scratch_path(s.spark, "store"))
    ckpt = scratch_path(s.spark, "stream_ckpt")
    reports = _normalized(s)
    early = F.to_date(F.col("file_date"), "MM-dd-yyyy") < F.lit(SPLIT_OLD)
    us = (F.col("Country_Region") == "US") & F.col("Province_State").isNotNull()
    for part, cond in (("a", early & us), ("b", early & ~us), ("c", ~early)):
        land_json(reports.filter(cond), f"{landing}/{part}")
        ingest_new_reports(s.spark, f"{landing}/*", store, ckpt, lookup=s.lookup)
    return store.read("covid_data_us").unionByName(store.read("covid_data_non_us"))


# -- reports on what the loads keep ---------------------------------------------

_FACT_SQL = {t: c for t, c in FINAL_SQL.items() if t != "location_lookup"}


@register("top_countries_kept", _SQL["top_countries"])
def _top_countries_kept(s: Scenario) -> DataFrame:
    """From the sums per location and month, after an overlapping batch."""
    return A.top_countries(s.facts.read("covid_data_non_us_totals"), s.lookup)


@register("top_us_counties_kept", _SQL["top_us_counties"])
def _top_us_counties_kept(s: Scenario) -> DataFrame:
    return A.top_us_counties(s.facts.read("covid_data_us_totals"), s.lookup)


@register("avg_mobility_kept", _SQL["avg_mobility_by_state"])
def _avg_mobility_kept(s: Scenario) -> DataFrame:
    totals = s.facts.read("google_mobility_data_us_totals")
    return avg_mobility_kept(totals, s.lookup, "state", "province_or_state")


@register("incident_rate_latest", _SQL["incident_rate_by_state"])
def _incident_rate_latest(s: Scenario) -> DataFrame:
    """From each location's last row per month, which a late or corrected row replaces."""
    return A.incident_rate_by_state(s.facts.read("covid_data_us_carry"), s.lookup)


@register("dq_report_kept", _sql(*FACT_CTES, f"m AS ({_dq_sql()})", body="""
SELECT table_name, 'has_rows' AS check_name, n_rows AS value, n_rows >= 1 AS passed FROM m
WHERE table_name <> 'location_lookup'
UNION ALL SELECT table_name, 'check_nulls', null_keys, null_keys = 0 FROM m WHERE table_name <> 'location_lookup'
UNION ALL SELECT table_name, 'check_duplicates', duplicate_keys, duplicate_keys = 0 FROM m
WHERE table_name <> 'location_lookup'"""))
def _dq_report_kept(s: Scenario) -> DataFrame:
    """From what the gate found month by month, without reading the facts."""
    return metrics_report(kept_metrics(s.facts, _FACT_SQL), list(_FACT_SQL))


@register("table_metrics_kept", _sql(*FACT_CTES, body=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, strftime(file_date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS count_of_records, "
    f"CAST(count(DISTINCT (location_identifier, file_date)) AS BIGINT) AS count_of_distinct_primary_key, "
    f"max(file_date) AS max_file_date FROM {c} GROUP BY ALL" for t, c in sorted(_FACT_SQL.items()))))
def _table_metrics_kept(s: Scenario) -> DataFrame:
    """Rows, distinct keys and latest date per table and month, as the loads kept them."""
    return kept_metrics(s.facts, _FACT_SQL).select(
        "table_name", "month", F.col("rows").alias("count_of_records"),
        F.col("distinct_keys").alias("count_of_distinct_primary_key"),
        F.col("latest").cast("date").alias("max_file_date"))


# -- single statements on data that meets their cases --------------------------

@register("patch_rows", _sql(body="""SELECT * REPLACE (
  CASE WHEN location_identifier = 1001 THEN 'Patched' ELSE province_or_state END AS province_or_state,
  CASE WHEN location_identifier = 1001 THEN 7.0 ELSE location_population END AS location_population)
FROM location_lookup"""))
def _patch_rows(s: Scenario) -> DataFrame:
    """UPDATE of one key that exists."""
    return patch_rows(s.lookup, F.col("location_identifier") == 1001,
                      {"province_or_state": "Patched", "location_population": 7})


@register("insert_narrowing", """SELECT o_orderkey AS location_identifier, CAST(o_orderdate AS DATE) AS file_date,
  CAST(round_even(o_totalprice, 0) AS BIGINT) AS ttl_confirmed_cases, CAST(NULL AS BIGINT) AS ttl_deaths
FROM orders""")
def _insert_narrowing(s: Scenario) -> DataFrame:
    """INSERT with a column list: fractions go to integers by rounding half to
    even, a column that is not given is NULL."""
    target = T.StructType([f for f in COVID_FACT.fields if f.name in ("file_date", "ttl_confirmed_cases", "ttl_deaths")])
    target = T.StructType([T.StructField("location_identifier", T.LongType()), *target.fields])
    o = s.src.table("orders", "o_orderkey", "o_orderdate", "o_totalprice")
    return conform(o.toDF("location_identifier", "file_date", "ttl_confirmed_cases"), target)


_TIED = "tied AS (SELECT * REPLACE (date_trunc('year', last_update_dts) AS last_update_dts) FROM covid_fixed)"


@register("tied_reports", _sql(_TIED, body=f"""SELECT * FROM (
{O.covid_batch_sql('tied', 'us')} UNION ALL {O.covid_batch_sql('tied', 'non_us')}) b"""))
def _tied_reports(s: Scenario) -> DataFrame:
    """Dedup where many reports of a place and day carry the same time."""
    year = F.date_trunc("year", F.col("last_update_dts")).cast("timestamp_ntz")
    return covid_batch(s.covid_fixed.withColumn("last_update_dts", year), s.lookup).drop("_scope")


_DIRTY = """dirty AS (SELECT location_identifier, file_date FROM covid_us
  UNION ALL SELECT location_identifier, file_date FROM covid_us WHERE location_granularity = 'state'
  UNION ALL SELECT location_identifier, NULL FROM covid_us WHERE location_granularity = 'county')"""


@register("dq_report_dirty", _sql(O.covid_fact_ctes("us"), _DIRTY, """m AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE file_date IS NULL) AS nulls,
         count(*) FILTER (WHERE file_date IS NOT NULL)
           - count(DISTINCT CASE WHEN file_date IS NOT NULL THEN (location_identifier, file_date) END) AS dups
  FROM dirty)""", body="""SELECT 'dirty' AS table_name, c.check_name,
  CAST(CASE c.check_name WHEN 'has_rows' THEN n WHEN 'check_nulls' THEN nulls ELSE dups END AS BIGINT) AS value,
  c.check_name = 'has_rows' AS passed
FROM m, (VALUES ('has_rows'), ('check_nulls'), ('check_duplicates')) c(check_name)"""))
def _dq_report_dirty(s: Scenario) -> DataFrame:
    """The gate on a table with repeated keys and keys without a date."""
    fact = s.covid_fact("us")
    again = fact.filter("location_granularity = 'state'")
    undated = fact.filter("location_granularity = 'county'").withColumn("file_date", F.lit(None).cast("date"))
    return quality_report({"dirty": fact.unionByName(again).unionByName(undated)}, {"dirty": FACT_KEY})
