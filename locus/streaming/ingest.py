"""Incremental ingest of newly landed files (Structured Streaming).

Three file sources, each a stream of its own: location lookups, mobility
reports and case reports. ``ingest_drops`` runs them in that order, each until
it has nothing new: a mobility batch adds the places that only it knows to the
dimension, and case reports then find every place.

History-dependent work (dedup, keyed upsert, changes from day to day) runs per
micro-batch inside ``foreachBatch`` against the months that the batch touches:
non-time windows are not allowed on a stream. A batch is published by one
commit, which also writes (stream, batch id) to the store's ledger. Spark runs
a batch again when a run ends between that commit and the stream's own
checkpoint; the ledger tells, and the batch is not loaded twice. A batch that
dies before its commit, between two facts say, has published nothing. The
stream's id in the ledger is that of its checkpoint, so a new checkpoint is a
new stream. The batch loads' quality gate applies.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from locus.operators.dml import conform
from locus.operators.locations import upsert_location_dim, with_missing_locations
from locus.plans.jobs import gate_and_publish, load_covid_months, load_mobility_months, lookup_header
from locus.schemas import (
    CASE_REPORT_FIELDS, COVID_STAGING, LOCATION_LOOKUP, LOOKUP_STAGING, MOBILITY_STAGING, raw_report_schema,
)
from locus.session import file_system, materialize, scratch_scope
from locus.sources.readers import parse_case_reports, stream_psv
from locus.sources.tables import Staged, TableStore


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint."""
    fs, p = file_system(spark, f"{checkpoint}/metadata")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def _run(spark: SparkSession, rows: DataFrame, store: TableStore, checkpoint: str,
         load: Callable[[DataFrame, dict[str, int]], None]) -> int:
    """Process what is new, then stop (availableNow); the number of batches loaded."""
    loaded: list[int] = []

    def once(batch: DataFrame, batch_id: int) -> None:
        source = stream_id(spark, checkpoint)
        if batch_id <= store.ledger().get(source, -1):
            return  # published before the run ended: Spark only lacks its own note
        with scratch_scope(spark):
            load(batch, {source: batch_id})
        loaded.append(batch_id)

    query = rows.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return len(loaded)


def ingest_new_reports(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    checkpoint: str,
    lookup: DataFrame | None = None,
    max_files_per_trigger: int | None = None,
    fields: Mapping[str, str] = CASE_REPORT_FIELDS,
) -> int:
    """Process every report file not seen before, then stop.

    ``landing`` is a directory or glob of JSON-lines report files; ``lookup``
    defaults to the published location dimension. Returns the number of
    micro-batches loaded.
    """
    reader = spark.readStream.schema(raw_report_schema(fields)).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, ledger: dict[str, int]) -> None:
        dim = lookup if lookup is not None else store.read("location_lookup")
        staged = materialize(conform(batch, COVID_STAGING), "stream_batch")
        gate_and_publish(store, load_covid_months(store, staged, dim), ledger=ledger)

    return _run(spark, parse_case_reports(reader.json(landing), fields), store, checkpoint, load)


def _dimension(store: TableStore, merged: DataFrame) -> Staged:
    return store.stage("location_lookup", merged.select(*LOCATION_LOOKUP.fieldNames()))


def ingest_new_lookups(spark: SparkSession, landing: str, store: TableStore, checkpoint: str,
                       max_files_per_trigger: int | None = None) -> int:
    """Upsert the dimension from every lookup file not seen before. Files of
    one drop are one upsert: an id that two of them bring with other attributes
    is a duplicate, which the gate refuses."""
    rows = stream_psv(spark, landing, LOOKUP_STAGING, lookup_header(), max_files_per_trigger)

    def load(batch: DataFrame, ledger: dict[str, int]) -> None:
        staged = materialize(batch, "stream_lookup")
        dim = _dimension(store, upsert_location_dim(store.read("location_lookup"), staged))
        gate_and_publish(store, {}, dim, ledger=ledger)

    return _run(spark, rows, store, checkpoint, load)


def ingest_new_mobility(spark: SparkSession, landing: str, store: TableStore, checkpoint: str,
                        max_files_per_trigger: int | None = None, key_offset: int | None = None) -> int:
    """Load every mobility file not seen before: places that only it knows go
    to the dimension, its rows into both mobility facts, all by one commit."""
    rows = stream_psv(spark, landing, MOBILITY_STAGING, None, max_files_per_trigger)
    offset = {} if key_offset is None else {"key_offset": key_offset}

    def load(batch: DataFrame, ledger: dict[str, int]) -> None:
        staged = materialize(batch, "stream_mobility")
        dim = _dimension(store, with_missing_locations(store.read("location_lookup"), staged, **offset))
        gate_and_publish(store, load_mobility_months(store, staged, dim.rows), dim, ledger=ledger, whole=False)

    return _run(spark, rows, store, checkpoint, load)


def ingest_drops(spark: SparkSession, store: TableStore, checkpoint: str, lookups: str | None = None,
                 mobility: str | None = None, reports: str | None = None) -> dict[str, int]:
    """What is new of each source, in order: dimension, mobility, case reports.
    Checkpoints are folders below ``checkpoint``; returns the batches per source."""
    sources = (("lookups", lookups, ingest_new_lookups), ("mobility", mobility, ingest_new_mobility),
               ("reports", reports, ingest_new_reports))
    return {name: ingest(spark, landing, store, f"{checkpoint}/{name}")
            for name, landing, ingest in sources if landing is not None}
