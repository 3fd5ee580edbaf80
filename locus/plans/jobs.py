"""End-to-end batch jobs: land, daily load, backfill, historical load.

A load writes each staging table once, builds the dimension, conforms both
scopes of each source in one pass, merges the batch into the months of the
facts that it touches, checks what it has staged, and only then publishes all
five tables by one commit. Every step is keyed, so running a load again after
a failure completes it. Staging tables and scratch files go at the end.
"""

from __future__ import annotations

import contextvars
import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locus.functions.recode import recode
from locus.operators.carry import CARRY_COLUMNS, carried_in, following_months, month_deltas, month_last, month_of
from locus.operators.covid import covid_batch
from locus.operators.dml import conform, upsert
from locus.operators.locations import NEW_LOCATION_OFFSET, upsert_location_dim, with_missing_locations
from locus.operators.mobility import distinct_routed, latest_mobility_all, place_routed
from locus.operators.quality import assert_quality, metrics_report, month_metrics
from locus.operators.totals import month_totals
from locus.operators.validity import (
    DIMENSION, LOAD_DAY, NEVER, added_versions, dimension_versions, staged_versions,
)
from locus.schemas import (
    CASE_REPORT_FIELDS, COVID_FACT, COVID_STAGING, FACT_KEY, LOCATION_LOOKUP, LOOKUP_STAGING, MOBILITY_CONFORMED,
    MOBILITY_FACT, MOBILITY_STAGING, STAGING_TABLES, TABLE_KEYS,
)
from locus.session import materialize, remove_path, scratch_scope, written
from locus.sources.readers import (
    ensure_each_day, ensure_each_not_empty, ensure_not_empty, normalize_case_report, read_case_reports, read_psv,
    read_source_csv, source_paths, with_load_day,
)
from locus.sources.tables import Staged, TableStore
from locus.sources.writers import dealt_evenly, land_json

SCOPES = ("us", "non_us")


@dataclass(frozen=True)
class SourceTemplates:
    """Landed file locations; ``{file_date}`` is replaced by MM-dd-yyyy."""

    covid: str  # JSON lines, e.g. .../covid/covid_{file_date}.json
    lookup: str  # gzip PSV, e.g. .../lookup/location_lookup_{file_date}.psv.gz
    mobility: str  # gzip PSV, e.g. .../mobility/google_mobility_{file_date}.psv.gz


# Header names of the landed lookup file (the staging names differ).
LOOKUP_SOURCE_HEADER = [
    "UID", "iso2", "iso3", "code3", "FIPS", "Admin2", "Province_State", "Country_Region",
    "Lat", "Long_", "Combined_Key", "Population",
]


def lookup_header() -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in LOOKUP_SOURCE_HEADER])


# -- landing ------------------------------------------------------------------

def land_reports(spark: SparkSession, raw: str, landed: str, dates: Iterable[dt.date]) -> list[str]:
    """Raw comma CSV reports of some days -> normalised JSON lines, one folder
    per day. Both are path templates with ``{file_date}``."""
    out = []
    for day in sorted(dates):
        source, target = source_paths(raw, [day])[0], source_paths(landed, [day])[0]
        report = ensure_not_empty(read_source_csv(spark, source), source)
        out.append(land_json(normalize_case_report(report, day), target))
    return out


# -- facts --------------------------------------------------------------------

def together(jobs: Mapping[str, Callable[[], object]]) -> dict:
    """Run independent Spark jobs side by side (the scheduler shares the
    cores), each in this context: its scratch tables are of this scope."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(contextvars.copy_context().run, job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def _months_of(df: DataFrame) -> list[str]:
    """The months of a batch (a few)."""
    return sorted(r[0] for r in df.select(month_of().alias("m")).distinct().collect() if r[0])


def month_carry(store: TableStore, table: str) -> DataFrame:
    """The carry rows of a fact; of months published without, from the fact."""
    name = f"{table}_carry"
    known, lacks = store.months(name), sorted({*store.months(table)} - {*store.months(name)})
    if not lacks:
        return store.read(name).select(*CARRY_COLUMNS) if known else month_last(store.read(table))
    found = month_last(store.read(table, lacks))
    return found.unionByName(store.read(name).select(*CARRY_COLUMNS)) if known else found


def stage_fact_months(store: TableStore, table: str, batch: DataFrame, with_deltas: bool) -> Staged | None:
    """The new content of every month of ``table`` that ``batch`` (written,
    de-duplicated) changes, written to a fresh folder; None for an empty batch.

    With deltas these are the batch's months and each batch row's next month
    with rows of its location; the carry rows of the same months go along."""
    if batch.isEmpty():
        return None
    touched = _months_of(batch)
    if not touched:  # no date at all: the gate refuses these rows
        return Staged(table, batch, "", ())
    if not with_deltas:
        months = store.stage(table, upsert(store.read(table, touched).select(*batch.columns), batch, FACT_KEY,
                                           unique_keys=True))
        return replace(months, also=(_totals(store, months),))
    carry = month_carry(store, table)
    if any(m > touched[0] for m in store.months(table)):
        after = following_months(carry, batch).collect()  # month names
        touched = sorted({*touched, *(r["month"] for r in after)})
    merged = upsert(store.read(table, touched).select(*batch.columns), batch, FACT_KEY, unique_keys=True)
    others = carry.where(~month_of().isin(touched))
    lasts = store.stage(f"{table}_carry", month_last(merged).select(*CARRY_COLUMNS))
    before = carried_in(others.unionByName(lasts.rows), touched)
    months = store.stage(table, month_deltas(merged, before).select(*batch.columns))
    return replace(months, also=(lasts, _totals(store, months)))


def _totals(store: TableStore, months: Staged) -> Staged:
    """Every location's sums of the staged months, to be published with them."""
    return store.stage(f"{months.table}_totals", month_totals(months.rows))


def check(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]]) -> dict[str, dict[str | None, dict]]:
    """The metrics of every table by month (a row per table and month comes to
    the driver); raises when a check fails."""
    found = None
    for name, df in sorted(tables.items()):
        part = month_metrics(df, keys[name], month_of() if "file_date" in keys[name] else None).select(
            F.lit(name).alias("table_name"), "*")
        found = part if found is None else found.unionByName(part)
    rows = found.collect()
    local = df.sparkSession.createDataFrame(rows, found.schema)
    assert_quality(metrics_report(local, list(tables)))
    out: dict[str, dict[str | None, dict]] = {name: {} for name in tables}
    for r in rows:
        out[r["table_name"]][r["month"]] = {c: r[c] for c in found.columns[2:]}
    return out


def kept_metrics(store: TableStore, tables: Iterable[str], keys: Mapping[str, list[str]] = TABLE_KEYS) -> DataFrame:
    """(table_name, month, rows, null_keys, duplicate_keys, distinct_keys,
    latest) as the loads kept them; a table that was published without a check
    is scanned."""
    spark, rows, scanned = store.spark, [], []
    for name in sorted(tables):
        known = store.metrics(name)
        if known is None:
            month = month_of() if "file_date" in keys[name] else None
            scanned.append(month_metrics(store.read(name), keys[name], month).select(F.lit(name).alias("table_name"), "*"))
            continue
        rows += [(name, m or None, x.get("rows", 0), x.get("null_keys", 0), x.get("duplicate_keys", 0),
                  x.get("distinct_keys", 0), x.get("latest")) for m, x in sorted(known.items())]
    out = spark.createDataFrame(rows, "table_name string, month string, rows long, null_keys long, "
                                      "duplicate_keys long, distinct_keys long, latest string")
    for part in scanned:
        out = out.unionByName(part)
    return out


def gate_and_publish(store: TableStore, facts: Mapping[str, Staged | None], dimension: Staged | None = None,
                     keys: Mapping[str, list[str]] = TABLE_KEYS, checked: Mapping[str, DataFrame] | None = None,
                     ledger: Mapping[str, int] | None = None, whole: bool = True) -> None:
    """Check everything that is staged (months that are not rewritten cannot
    gain a fault: fact keys hold the date), then publish it by one commit.
    What the check finds is kept by month with the tables. With a dimension it
    is a whole load (unless told otherwise), after which no table may be empty. ``checked`` are further tables to check, ``ledger`` the
    stream batches that the commit completes."""
    staged = {t: s for t, s in facts.items() if s is not None}
    if dimension is not None:
        bare = [t for t in facts if t not in staged and not store.months(t)]
        if bare and whole:
            raise ValueError(f"load refused by its quality gate: no rows for {', '.join(bare)}")
    found = {t: s.rows for t, s in staged.items()} | dict(checked or {})
    if dimension is not None:
        found.setdefault("location_lookup", dimension.rows)
    metrics = check(found, keys) if found else {}
    published = [replace(s, metrics=metrics[s.table]) for s in staged.values()]
    if dimension is not None:
        published.append(replace(dimension, metrics=metrics["location_lookup"]))
    if published or ledger:
        store.commit(published, ledger=ledger)


def _without_batch(store: TableStore, staged: dict[str, Staged | None], batch: str) -> dict[str, Staged | None]:
    """``staged``, the batch's folder gone: its rows stand in the staged months
    (but a batch without any date stays for the gate, which refuses it)."""
    if all(s is None or s.path for s in staged.values()):
        remove_path(store.spark, batch)
    return staged


def load_covid_months(store: TableStore, covid: DataFrame, dim: DataFrame,
                      spent: str | None = None) -> dict[str, Staged | None]:
    """Staged months of both case facts: one routing pass, one dedup. The
    folder ``spent`` (of the reports) goes once the batch is written."""
    batch, path = written(covid_batch(recode(covid, "admin2"), dim), "covid_batch")
    if spent:
        remove_path(store.spark, spent)

    def stage(scope: str) -> Staged | None:
        rows = batch.filter(F.col("_scope") == scope).select(*COVID_FACT.fieldNames())
        return stage_fact_months(store, f"covid_data_{scope}", rows, with_deltas=True)

    staged = together({f"covid_data_{scope}": partial(stage, scope) for scope in SCOPES})
    return _without_batch(store, staged, path)


def load_mobility_months(store: TableStore, mobility: DataFrame, dim: DataFrame,
                         spent: str | None = None) -> dict[str, Staged | None]:
    """Staged months of both mobility facts: one routing pass, one dedup. The
    folder ``spent`` (of the reports) goes once the batch is written."""
    batch, path = written(latest_mobility_all(mobility, dim), "mobility_batch")
    if spent:
        remove_path(store.spark, spent)

    def stage(scope: str) -> Staged | None:
        rows = batch.filter(F.col("_scope") == scope).select(*MOBILITY_FACT.fieldNames())
        return stage_fact_months(store, f"google_mobility_data_{scope}", rows, with_deltas=False)

    staged = together({f"google_mobility_data_{scope}": partial(stage, scope) for scope in SCOPES})
    return _without_batch(store, staged, path)


def publish_conformed(store: TableStore, mobility: DataFrame, dim: DataFrame) -> None:
    """The two conformed mobility staging tables, for a load that keeps its
    staging (the facts do not need them: their dedup drops repeats as well).
    The dimension has passed the gate: its ids are unique, so rows that are
    distinct before they meet their places are so afterwards."""
    routed = materialize(distinct_routed(mobility), "mobility_routed")
    store.commit([store.stage(f"google_mobility_data_{scope}_staging",
                              conform(place_routed(routed, dim, scope), MOBILITY_CONFORMED)) for scope in SCOPES])


# -- loads --------------------------------------------------------------------

def load_staging(store: TableStore, sources: Mapping[str, tuple[DataFrame, T.StructType]]) -> dict[str, DataFrame]:
    """Truncate and load staging tables: each source is parsed once, here, side
    by side; what a few unsplittable files put into few tasks is spread. A
    table without rows refuses the load before anything is published."""
    staged = together({name: partial(store.stage, name, dealt_evenly(conform(rows, schema)))
                       for name, (rows, schema) in sources.items()})
    for name, s in staged.items():
        ensure_not_empty(s.rows, name)
    store.commit(list(staged.values()))
    return {name: s.rows for name, s in staged.items()}


def run_load(
    spark: SparkSession,
    store: TableStore,
    covid: DataFrame,
    lookup: DataFrame,
    mobility: DataFrame,
    key_offset: int = NEW_LOCATION_OFFSET,
    keep_staging: bool = False,
) -> None:
    """One load of the three sources into the five final tables.

    ``key_offset``: new places get ids that far above the current maximum;
    choose a smaller one before repeated loads reach the end of INT."""
    with scratch_scope(spark):
        staging = load_staging(store, {
            "covid_data_staging": (covid, COVID_STAGING),
            "location_lookup_staging": (lookup, LOOKUP_STAGING),
            "google_mobility_data_staging": (mobility, MOBILITY_STAGING),
        })
        mobility = staging["google_mobility_data_staging"]
        # dimension: upsert + known fixes, then places only mobility knows
        merged = upsert_location_dim(store.read("location_lookup"), staging["location_lookup_staging"])
        dim = with_missing_locations(materialize(merged, "dim_upserted"), mobility, key_offset=key_offset)
        dim = store.stage("location_lookup", dim.select(*LOCATION_LOOKUP.fieldNames()))
        loads = together({"covid": partial(load_covid_months, store, staging["covid_data_staging"], dim.rows),
                          "mobility": partial(load_mobility_months, store, mobility, dim.rows)})
        gate_and_publish(store, loads["covid"] | loads["mobility"], dim)
        if keep_staging:
            publish_conformed(store, mobility, dim.rows)
        else:
            cleanup_staging(store)


def read_lookup(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    rows = read_psv(spark, paths, LOOKUP_STAGING, lookup_header())
    return ensure_each_not_empty(rows, paths)


def run_daily(spark: SparkSession, store: TableStore, run_date: dt.date, sources: SourceTemplates,
              fields: Mapping[str, str] = CASE_REPORT_FIELDS, key_offset: int = NEW_LOCATION_OFFSET) -> None:
    """Load the files of the previous day (the run processes yesterday's data)."""
    run_backfill(spark, store, [run_date - dt.timedelta(days=1)], sources, fields, key_offset)


def run_backfill(spark: SparkSession, store: TableStore, dates: Iterable[dt.date], sources: SourceTemplates,
                 fields: Mapping[str, str] = CASE_REPORT_FIELDS, key_offset: int = NEW_LOCATION_OFFSET) -> None:
    """Load several days, in date order, each with its own three files.

    A day's files are conformed with the dimension as it stands that day, and
    ids of new places follow from it, so the days are loaded one after the
    other; each touches its own months only. ``fields`` maps the reports' keys
    to staging columns."""
    for day in sorted(dates):
        covid, lookup, mobility = (source_paths(t, [day]) for t in (sources.covid, sources.lookup, sources.mobility))
        run_load(spark, store, read_case_reports(spark, covid, fields), read_lookup(spark, lookup),
                 read_psv(spark, mobility, MOBILITY_STAGING), key_offset)


def run_backfill_bulk(spark: SparkSession, store: TableStore, dates: Iterable[dt.date], sources: SourceTemplates,
                      fields: Mapping[str, str] = CASE_REPORT_FIELDS, key_offset: int = NEW_LOCATION_OFFSET) -> None:
    """The tables that ``run_backfill`` gives, by one load of all days: the
    number of Spark jobs does not grow with the days.

    Dimension rows carry the days they hold, so each day's rows are joined
    with the dimension as of that day (as-of join); of a key that several days
    bring the last day's row stays. The gate looks at all days together, and
    publishes all of them or none. Should a later lookup file bring an id that
    an earlier day's new place was given, nothing is published: load these
    days one after the other."""
    days = sorted(set(dates))
    with scratch_scope(spark):
        def staged(name: str, rows: DataFrame, schema: T.StructType, template: str) -> tuple[DataFrame, str]:
            dated = T.StructType([*schema.fields, T.StructField(LOAD_DAY, T.DateType())])
            rows, path = written(dealt_evenly(conform(with_load_day(rows, template), dated)), name)
            return ensure_each_day(rows, template, days), path

        paths = {t: source_paths(t, days) for t in (sources.covid, sources.lookup, sources.mobility)}
        reports = read_case_reports(spark, paths[sources.covid], fields)
        places = read_psv(spark, paths[sources.lookup], LOOKUP_STAGING, lookup_header())
        moves = read_psv(spark, paths[sources.mobility], MOBILITY_STAGING)
        staging = together({
            "covid": partial(staged, "covid_days", reports, COVID_STAGING, sources.covid),
            "lookup": partial(staged, "lookup_days", places, LOOKUP_STAGING, sources.lookup),
            "mobility": partial(staged, "mobility_days", moves, MOBILITY_STAGING, sources.mobility),
        })
        (covid, covid_path), (lookup, _), (mobility, mobility_path) = (staging[n] for n in ("covid", "lookup", "mobility"))
        final = store.read("location_lookup")
        versions = materialize(dimension_versions(final, lookup), "versions")
        added = materialize(added_versions(final, versions, lookup, mobility, key_offset), "added_versions")
        late = lookup.join(added, (F.col("uid") == F.col("location_identifier")) & (F.col(LOAD_DAY) > F.col("valid_from")),
                           "left_semi")
        if not late.isEmpty():
            raise ValueError("a lookup file brings the id of a place added before it; load these days one by one")
        versions = versions.unionByName(added)
        current = versions.where(F.col("valid_to") == F.lit(NEVER)).select(*DIMENSION)
        dim = store.stage("location_lookup", current)
        loads = together({"covid": partial(load_covid_months, store, covid, versions, covid_path),
                          "mobility": partial(load_mobility_months, store, mobility, versions, mobility_path)})
        gate_and_publish(store, loads["covid"] | loads["mobility"], dim,
                         keys=TABLE_KEYS | {"lookup_days": ["location_identifier", LOAD_DAY]},
                         checked={"lookup_days": staged_versions(lookup)})


def run_historical(spark: SparkSession, store: TableStore, covid_prefix: str, lookup_path: str,
                   mobility_path: str, fields: Mapping[str, str] = CASE_REPORT_FIELDS) -> None:
    """All past case reports under a prefix (glob) plus one snapshot of the
    lookup and mobility files."""
    run_load(spark, store, read_case_reports(spark, covid_prefix, fields), read_lookup(spark, lookup_path),
             read_psv(spark, mobility_path, MOBILITY_STAGING))


def cleanup_staging(store: TableStore) -> None:
    """DROP TABLE IF EXISTS for the staging tables."""
    store.drop(*STAGING_TABLES)
