"""Row-level table maintenance as pure DataFrame -> DataFrame functions.

Parquet tables have no UPDATE/DELETE/MERGE, so each statement becomes a
relational rewrite and the caller publishes the result once (see
``locus.sources.tables.TableStore``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def upsert(
    final: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    *,
    distinct_incoming: bool = True,
    unique_keys: bool = False,
) -> DataFrame:
    """DELETE final rows whose key arrives again, INSERT every incoming row.

    = final LEFT ANTI JOIN keys(incoming) UNION ALL DISTINCT incoming.
    Keys compare with '=' (a NULL key never deletes). ``incoming`` is used
    twice, so callers pass a written table; its size then tells Spark whether
    the key set is small enough to broadcast (a daily batch, which leaves the
    big final table unshuffled) or the anti join shuffles.
    ``unique_keys``: the caller guarantees distinct incoming rows (e.g. after
    ``dedup_latest``), so both DISTINCT shuffles are skipped (an anti join's
    result does not depend on duplicate keys).
    """
    keys = list(keys)
    batch_keys = incoming.select(*keys)
    if not unique_keys:
        batch_keys = batch_keys.distinct()
    kept = final.join(batch_keys, keys, "left_anti")
    new_rows = incoming.select(*final.columns)
    if distinct_incoming and not unique_keys:
        new_rows = new_rows.distinct()
    return kept.unionByName(new_rows)


def patch_rows(df: DataFrame, predicate: Column, values: Mapping[str, object]) -> DataFrame:
    """UPDATE df SET c = v ... WHERE predicate, as one projection."""
    out = df
    for c, v in values.items():
        value = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.when(predicate, value.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """INSERT ... SELECT with an explicit column list and implicit narrowing.

    Missing columns become typed NULLs; fractional -> integral casts round
    half-even first (the warehouse rounds, a bare Spark cast truncates).
    """
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src_type = df.schema[f.name].dataType
        c = F.col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)) and isinstance(
            src_type, (T.DoubleType, T.FloatType, T.DecimalType)
        ):
            c = F.bround(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty_like(spark_df_or_session, schema: T.StructType) -> DataFrame:
    """An empty table of the given schema (CREATE TABLE IF NOT EXISTS),
    built JVM-side (no Python data source, no Python workers)."""
    spark = getattr(spark_df_or_session, "sparkSession", spark_df_or_session)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
