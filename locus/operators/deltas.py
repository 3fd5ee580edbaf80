"""Daily changes from cumulative counts (the UPDATE ... FROM self join,
re-expressed as one window projection)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DELTA_COLUMNS: tuple[tuple[str, str], ...] = (
    ("ttl_confirmed_cases", "new_confirmed_cases"),
    ("ttl_deaths", "new_deaths"),
    ("ttl_recovered_cases", "new_recoveries"),
)


def daily_deltas(
    fact: DataFrame,
    location: str = "location_identifier",
    date: str = "file_date",
    pairs: Sequence[tuple[str, str]] = DELTA_COLUMNS,
) -> DataFrame:
    """new = NVL(cur - LAG(cur) OVER (PARTITION BY location ORDER BY date), cur).

    Falls back to the cumulative value when the previous or the current value
    is NULL; date gaps are not filled; negative changes are kept. Results are
    INT like the target column (overflow raises).

    One window partition is one location's series: after the keyed upsert it
    has at most one row per day, so no partition grows with the data volume.
    """
    w = Window.partitionBy(location).orderBy(F.col(date).asc())
    out = fact
    for src, dst in pairs:
        cur = F.col(src)
        out = out.withColumn(dst, F.coalesce(cur - F.lag(cur, 1).over(w), cur).cast("int"))
    return out


def refresh_deltas(
    fact: DataFrame,
    batch_keys: DataFrame,
    location: str = "location_identifier",
    date: str = "file_date",
    pairs: Sequence[tuple[str, str]] = DELTA_COLUMNS,
) -> DataFrame:
    """Recompute deltas only for the locations that a batch touches.

    ``batch_keys`` (location, date) names them. Their whole series in ``fact``
    goes through the LAG window; all other rows keep their deltas, rows
    without a location too. Equal to ``daily_deltas(fact)`` when ``fact``
    carried correct deltas before the upsert. A caller that passes a part of
    the history adds each touched location's last row before it (see
    ``load_fact_months``) and drops those rows afterwards.
    """
    touched = batch_keys.select(location).distinct()
    redone = daily_deltas(fact.join(touched, location, "left_semi"), location, date, pairs)
    keep = fact.join(touched, location, "left_anti")
    return keep.select(*fact.columns).unionByName(redone.select(*fact.columns))
