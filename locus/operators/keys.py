"""Surrogate keys: a dense ROW_NUMBER() over a global order, distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.session import materialize

_POS_BITS = 33  # monotonically_increasing_id = partition_index << 33 | position


def global_row_number(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "row_number",
    partitions: int | None = None,
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` without a single-task window.

    1. range-partition on the order and sort inside each partition (sampled
       bounds, so every task gets a similar share even for skewed values);
    2. tag rows with ``monotonically_increasing_id`` (partition, position);
    3. write to the shared folder, so both uses below see the same rows even
       if an executor is lost and the input is re-read;
    4. per-partition counts (one number per partition, like zipWithIndex)
       -> running offsets as an array literal: number = offset + position + 1.
    ``order`` must be total for the numbering to be reproducible.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()),
        "row_number",
    )
    tagged = (
        tagged.withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
    )
    # One number per partition (bounded by the partition count, never by the
    # data): partition sizes -> running offsets, inlined as an array literal.
    sizes = dict(tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, total = [], 0
    for pid in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(pid, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), (F.col("_pid") + 1).cast("int")) \
        if offsets else F.lit(0).cast("long")
    return tagged.withColumn(name, offset + F.col("_pos") + F.lit(1)).drop("_mid", "_pid", "_pos")
