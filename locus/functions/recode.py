"""Ordered first-match value corrections (a CASE chain built from data)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    value: str
    replacement: str
    # optional second test: (column, required value)
    when_column: str | None = None
    when_value: str | None = None


# The known county-name corrections applied to staged case
# reports, in their original order (value, replacement, optional province).
ADMIN2_RULES: tuple[Rule, ...] = (
    Rule("New York", "New York City"),
    Rule("Yakutat", "Yakutat plus Hoonah-Angoon"),
    Rule("Walla Walla County", "Walla Walla"),
    Rule("Out-of-state", "Out of TN", "province_state", "Tennessee"),
    Rule("Garfield County", "Garfield"),
    Rule("Lake and Peninsula", "Bristol Bay plus Lake and Peninsula", "province_state", "Alaska"),
    Rule("Washington County", "Washington"),
    Rule("Southwest", "Southwest Utah"),
    Rule("Elko County", "Elko"),
    Rule("Doña Ana", "Dona Ana"),
    Rule("Unknown", "Unassigned", "province_state", "Tennessee"),
)


def recode_column(column: str, rules: Sequence[Rule]) -> Column:
    """CASE WHEN col = v1 [AND c = w1] THEN r1 ... ELSE col END.

    Comparisons are exact (case-sensitive, no trimming); NULL and unmatched
    values pass through unchanged.
    """
    expr = None
    for r in rules:
        cond = F.col(column) == F.lit(r.value)
        if r.when_column is not None:
            cond = cond & (F.col(r.when_column) == F.lit(r.when_value))
        expr = F.when(cond, F.lit(r.replacement)) if expr is None else expr.when(cond, F.lit(r.replacement))
    return F.col(column) if expr is None else expr.otherwise(F.col(column))


def recode(df: DataFrame, column: str = "admin2", rules: Sequence[Rule] = ADMIN2_RULES) -> DataFrame:
    """Apply the correction rules to ``column`` (a narrow, fused projection)."""
    return df.withColumn(column, recode_column(column, rules))
