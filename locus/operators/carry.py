"""Daily changes month by month, with the state that crosses months kept.

LAG over a location's whole series needs its whole history. The carry table
holds each location's last row of every month (one row per location and month,
about a thirtieth of the fact), so the first day of a month finds the row
before it by lookup and a load reads and rewrites only the months that change:
those of its batch, and of each batch row the location's next month, whose
first change is taken from the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.operators.deltas import DELTA_COLUMNS

CARRIED = [total for total, _ in DELTA_COLUMNS]
CARRY_COLUMNS = ["location_identifier", "file_date", "location_granularity", *CARRIED]


def month_of(date: str = "file_date"):
    return F.date_format(date, "yyyy-MM")


def month_last(rows: DataFrame) -> DataFrame:
    """Each location's last row per month (rows without a key part carry nothing)."""
    known = rows.where(F.col("location_identifier").isNotNull() & F.col("file_date").isNotNull())
    last = known.groupBy("location_identifier", month_of().alias("_month")).agg(
        F.max_by(F.struct(*CARRY_COLUMNS[1:]), "file_date").alias("_last"))
    return last.select("location_identifier", "_last.*")


def following_months(carry: DataFrame, batch: DataFrame) -> DataFrame:
    """(month): for every location and month of ``batch`` the location's next
    month that has rows, by one window over months (not days)."""
    had = carry.select("location_identifier", month_of().alias("month"), F.lit(0).alias("new"))
    comes = batch.select("location_identifier", month_of().alias("month"), F.lit(1).alias("new"))
    series = had.unionByName(comes).groupBy("location_identifier", "month").agg(F.max("new").alias("new"))
    w = Window.partitionBy("location_identifier").orderBy("month")
    return series.withColumn("next", F.lead("month").over(w)).where(
        (F.col("new") == 1) & F.col("next").isNotNull()).select(F.col("next").alias("month")).distinct()


def carried_in(carry: DataFrame, months: list[str]) -> DataFrame:
    """Per location and month of ``months``: the totals of its last row in an
    earlier month (none for its first month)."""
    w = Window.partitionBy("location_identifier").orderBy("file_date")
    before = F.lag(F.struct(*CARRIED)).over(w)
    return carry.select("location_identifier", month_of().alias("_month"), before.alias("_before")).where(
        F.col("_month").isin(months) & F.col("_before").isNotNull())


def month_deltas(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """``daily_deltas`` of whole months: LAG inside the month, the carried row
    for a month's first day. Rows without a key part keep a window of their own."""
    columns = rows.columns
    w = Window.partitionBy("location_identifier", "_month").orderBy(F.col("file_date").asc())
    joined = rows.withColumn("_month", month_of()).join(carried, ["location_identifier", "_month"], "left")
    first = joined.withColumn("_first", F.row_number().over(w) == 1)
    out = first.select("*", *[
        F.when(F.col("_first"), F.col(f"_before.{total}")).otherwise(F.lag(total).over(w)).alias(f"_p_{total}")
        for total in CARRIED])
    changed = {new: F.coalesce(F.col(total) - F.col(f"_p_{total}"), F.col(total)).cast("int")
               for total, new in DELTA_COLUMNS}
    return out.withColumns(changed).select(*columns)
