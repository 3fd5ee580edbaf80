"""Sums per location and month, kept beside a fact.

A load writes them for the months it rewrites, so reports that sum over the
whole history read one row per location and month instead of one per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.operators.deltas import DELTA_COLUMNS
from locus.schemas import MOBILITY_MEASURES


def month_totals(rows: DataFrame) -> DataFrame:
    """location_identifier, file_date (the month's first day),
    location_granularity, days, and of a case fact the sums of the daily
    changes, of a mobility fact each measure's sum and count (``n_``).

    Sums are NULL where all values are, as SUM over the fact would be. Rows
    without a date are left out."""
    if DELTA_COLUMNS[0][1] in rows.columns:
        sums = [F.sum(F.col(new).cast("long")).alias(new) for _, new in DELTA_COLUMNS]
    else:
        sums = [x for m in MOBILITY_MEASURES for x in (F.sum(m).alias(m), F.count(m).alias(f"n_{m}"))]
    month = F.trunc("file_date", "month").alias("file_date")
    return rows.where(F.col("file_date").isNotNull()).groupBy(
        "location_identifier", month, "location_granularity").agg(F.count(F.lit(1)).alias("days"), *sums)


def avg_mobility_kept(totals: DataFrame, lookup: DataFrame, granularity: str, name_col: str) -> DataFrame:
    """``analytics.avg_mobility`` from the months' sums."""
    dim = lookup.select("location_identifier", name_col)
    avgs = totals.filter(F.col("location_granularity") == granularity).groupBy("location_identifier").agg(
        *[F.round(F.try_divide(F.sum(m), F.sum(f"n_{m}")), 6).alias(f"avg_{m}") for m in MOBILITY_MEASURES],
        F.sum("days").alias("days"))
    return avgs.join(dim, "location_identifier", "left").withColumnRenamed(
        name_col, "state" if name_col == "province_or_state" else "country")
