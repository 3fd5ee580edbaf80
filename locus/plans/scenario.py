"""The load pipeline over the adapter views, as lazily built DataFrames.

Mirrors one run of the batch job: dimension upsert -> missing places ->
county-name corrections -> fact loads (an existing fact plus an
overlapping batch) -> analytics. Nothing here collects.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.functions.recode import recode
from locus.operators.dml import empty_like
from locus.operators.locations import upsert_location_dim, with_missing_locations
from locus.plans.adapters import Adapters
from locus.plans.jobs import SCOPES, gate_and_publish, load_covid_months, load_mobility_months, together
from locus.schemas import LOCATION_LOOKUP
from locus.session import colocated_session, file_system, materialize, scratch_path
from locus.sources.tables import TableStore, bucket_number

# The fact built from reports before SPLIT_OLD is the existing table; the
# batch holds every report from SPLIT_NEW on (half a year of overlap).
SPLIT_OLD = dt.date(2000, 1, 1)
SPLIT_NEW = dt.date(1999, 7, 1)

FACTS = tuple(f"{kind}_{scope}" for kind in ("covid_data", "google_mobility_data") for scope in SCOPES)


_SHARED: dict[tuple, "Scenario"] = {}


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files, so that changed input is
    never answered from tables built before."""
    fs, p = file_system(spark, sf_dir)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


@dataclass
class Scenario:
    spark: SparkSession
    sf_dir: str

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Scenario":
        """One scenario per application and state of the input folder: every
        registered query of a session reuses its published tables, as reports
        do."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _input_state(spark, sf_dir))
        if key not in _SHARED:
            _SHARED[key] = cls(spark, sf_dir)
        return _SHARED[key]

    @cached_property
    def src(self) -> Adapters:
        return Adapters(self.spark, self.sf_dir)

    # Staging tables: loaded once per run (truncate-and-load), then every
    # step scans the loaded table instead of re-deriving the source.
    @cached_property
    def lookup_staging(self) -> DataFrame:
        return materialize(self.src.location_lookup_staging, "location_lookup_staging")

    @cached_property
    def covid_staging(self) -> DataFrame:
        return materialize(self.src.covid_data_staging, "covid_data_staging")

    @cached_property
    def mobility_staging(self) -> DataFrame:
        return materialize(self.src.google_mobility_data_staging, "google_mobility_data_staging")

    @cached_property
    def lookup_dim(self) -> DataFrame:
        """Dimension after the upsert from staging (used three times by the
        missing-place step: written once)."""
        return materialize(upsert_location_dim(empty_like(self.spark, LOCATION_LOOKUP), self.lookup_staging),
                           "lookup_dim")

    @cached_property
    def lookup(self) -> DataFrame:
        """Dimension after the dimension upsert and the missing-place insert,
        materialised once: every load and report joins it."""
        return materialize(with_missing_locations(self.lookup_dim, self.mobility_staging), "lookup")

    @cached_property
    def covid_fixed(self) -> DataFrame:
        return recode(self.covid_staging, "admin2")

    @cached_property
    def store(self) -> TableStore:
        return TableStore(self.spark, scratch_path(self.spark, "warehouse"))

    @cached_property
    def facts(self) -> TableStore:
        """The four facts, published."""
        return self._load(self.store)

    @cached_property
    def bucketed(self) -> TableStore:
        """The same loads into facts bucketed by location, read in a session
        that joins them bucket by bucket. The buckets follow the size of the
        larger source and are the same for all, so that the facts can meet."""
        n = max(bucket_number(self.covid_staging), bucket_number(self.mobility_staging))
        loaded = self._load(TableStore(self.spark, scratch_path(self.spark, "bucketed"), buckets={t: n for t in FACTS}))
        return TableStore(colocated_session(self.spark), loaded.root, buckets=loaded.buckets)

    def _load(self, store: TableStore) -> TableStore:
        """The history before SPLIT_OLD, then the overlapping batch merged into
        the months it touches. Both sources go side by side and one commit
        publishes them."""
        sides = ((F.lit(SPLIT_OLD), lambda day, split: day < split), (F.lit(SPLIT_NEW), lambda day, split: day >= split))
        for split, test in sides:
            covid = self.covid_staging.filter(test(F.col("file_date"), split))
            mobility = self.mobility_staging.filter(test(F.col("date"), split))
            loads = together({"covid": partial(load_covid_months, store, covid, self.lookup),
                              "mobility": partial(load_mobility_months, store, mobility, self.lookup)})
            gate_and_publish(store, loads["covid"] | loads["mobility"])
        return store

    @cached_property
    def _fact_tables(self) -> dict[str, DataFrame]:
        return {name: self.facts.read(name) for name in FACTS}

    def covid_fact(self, scope: str) -> DataFrame:
        return self._fact_tables[f"covid_data_{scope}"]

    def mobility_fact(self, scope: str) -> DataFrame:
        return self._fact_tables[f"google_mobility_data_{scope}"]

    def final_tables(self) -> dict[str, DataFrame]:
        return {
            "location_lookup": self.lookup,
            "covid_data_us": self.covid_fact("us"),
            "covid_data_non_us": self.covid_fact("non_us"),
            "google_mobility_data_us": self.mobility_fact("us"),
            "google_mobility_data_non_us": self.mobility_fact("non_us"),
        }
