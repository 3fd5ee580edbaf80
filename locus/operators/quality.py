"""Data-quality gates: has rows, NULL keys, duplicate keys.

All checks of one table run as one aggregate job; the report is a
DataFrame (table, check, value, passed), ``assert_quality`` raises.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECKS = ("has_rows", "check_nulls", "check_duplicates")


def quality_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row count, rows with a NULL key part, duplicate keys.

    One grouped pass: count rows per key (partial aggregation map-side, so a
    hot key costs one row per task), then sum over the groups. Duplicates =
    rows beyond the first of every key without a NULL part (a NULL part
    removes the row from both counts, as with a concatenated key).
    """
    keys = list(keys)
    if not keys:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            "rows", F.lit(0).cast("long").alias("null_keys"), F.lit(0).cast("long").alias("duplicate_keys"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
        F.coalesce(F.sum(F.when(~any_null, F.col("_n") - 1)), F.lit(0)).cast("long").alias("duplicate_keys"),
    )


def quality_report(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    checks: Sequence[str] = CHECKS,
) -> DataFrame:
    """(table_name, check_name, value, passed) for every table and check."""
    frames = []
    for name, df in sorted(tables.items()):
        m = quality_metrics(df, keys.get(name, []))
        per_check = {
            "has_rows": (F.col("rows"), F.col("rows") >= 1),
            "check_nulls": (F.col("null_keys"), F.col("null_keys") == 0),
            "check_duplicates": (F.col("duplicate_keys"), F.col("duplicate_keys") == 0),
        }
        stacked = F.explode(F.array(*[
            F.struct(F.lit(c).alias("check_name"), per_check[c][0].cast("long").alias("value"),
                     per_check[c][1].alias("passed"))
            for c in checks
        ])).alias("r")
        frames.append(m.select(F.lit(name).alias("table_name"), stacked).select("table_name", "r.*"))
    return reduce(DataFrame.unionByName, frames)


def month_metrics(df: DataFrame, keys: Sequence[str], month: Column | None = None) -> DataFrame:
    """``quality_metrics`` per month (one null month without ``month``), with
    distinct keys and the latest date. A key holds its date, so the months of a
    table add up: rows, null keys, duplicates and distinct keys by sum, the
    latest date by maximum."""
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    part = F.lit(None).cast("string") if month is None else month
    day = F.max("file_date") if "file_date" in keys else F.lit(None).cast("date")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else df.select(F.lit(1).cast("long").alias("_n"))
    n, whole = F.col("_n"), F.sum(F.when(~any_null, F.lit(1)).otherwise(0))
    return per_key.groupBy(part.alias("month")).agg(
        F.sum(n).alias("rows"), F.sum(F.when(any_null, n).otherwise(0)).alias("null_keys"),
        F.sum(F.when(~any_null, n - 1).otherwise(0)).alias("duplicate_keys"), whole.alias("distinct_keys"),
        day.cast("string").alias("latest"))


def metrics_report(metrics: DataFrame, tables: Sequence[str]) -> DataFrame:
    """(table_name, check_name, value, passed) from month metrics with their
    ``table_name``; a table without any has no rows."""
    spark = metrics.sparkSession
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in sorted(tables)])).alias("table_name"))
    sums = listed.join(metrics, "table_name", "left").groupBy("table_name").agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "null_keys", "duplicate_keys")])
    checks = {"has_rows": (F.col("rows"), F.col("rows") >= 1), "check_nulls": (F.col("null_keys"), F.col("null_keys") == 0),
              "check_duplicates": (F.col("duplicate_keys"), F.col("duplicate_keys") == 0)}
    return sums.select("table_name", F.explode(F.array(*[
        F.struct(F.lit(c).alias("check_name"), checks[c][0].alias("value"), checks[c][1].alias("passed"))
        for c in CHECKS])).alias("r")).select("table_name", "r.*")


def assert_quality(report: DataFrame) -> DataFrame:
    """Raise ValueError naming every failed check; returns the report rows
    (a handful: tables x checks) as a small local DataFrame otherwise."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        found = "; ".join(f"{r['check_name']} of {r['table_name']} gave {r['value']}" for r in failed)
        raise ValueError(f"load refused by its quality gate: {found}")
    return report
