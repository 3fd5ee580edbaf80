"""Keep the latest row per key: ROW_NUMBER() ... = 1, made deterministic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locus.functions.columns import desc_nulls_first_key


def _order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """Declared order, then every remaining column as tie-break, so that the
    winner is a pure function of the rows (the source order leaves ties)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return list(order) + rest


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    method: str = "window",
) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (each DESC NULLS FIRST).

    ``window`` (default): ``ROW_NUMBER() ... = 1``. Catalyst plans it as a
    partial WindowGroupLimit before the shuffle and a final one after, so a
    hot key holding a third of all rows shrinks to one row per map task
    before anything moves; sorts stay in generated code.
    ``aggregate``: ``max(struct(order..., row))`` per key, the same map-side
    reduction as a partial aggregate (sort-based for struct buffers, slower
    here; kept as an equal alternative).
    """
    keys = list(keys)
    full_order = _order(df, keys, order)
    payload = [c for c in df.columns if c not in keys]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in full_order])
        return (
            df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1)
            .drop("_rn")
        )
    if method != "aggregate":
        raise ValueError(f"unknown dedup method {method!r}")
    best = F.max(
        F.struct(*desc_nulls_first_key(full_order), F.struct(*payload).alias("_row"))
    ).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*").select(*df.columns)


def latest_load(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """The rows of each key's last load: what loads in turn leave when a later
    one replaces the key's rows. Ranks keep ties, and are limited before the
    shuffle like the dedup."""
    w = Window.partitionBy(*keys).orderBy(F.col(day).desc())
    return df.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")
