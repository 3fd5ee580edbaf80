"""Column-level helpers: all built-in, JVM-side expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c: ColumnLike) -> Column:
    """Join normalisation used throughout the pipeline (case-insensitive)."""
    return F.lower(col(c))


def level_key(c: ColumnLike) -> Column:
    """Lower-cased key part; a NULL part becomes '' so that the level tag,
    not the null, decides which lookup rows can match."""
    return F.coalesce(F.lower(col(c)), F.lit(""))


def to_int_rounded(c: ColumnLike) -> Column:
    """float -> int the way the warehouse does it (round, not truncate).

    Computed via LONG so an out-of-range value raises under ANSI casts.
    """
    return F.bround(col(c)).cast("long").cast("int")


def null_of(dtype: T.DataType | str) -> Column:
    """NULL-typed padding column."""
    return F.lit(None).cast(dtype)


def empty_as_null(c: ColumnLike) -> Column:
    """EMPTYASNULL for string sources that are not CSV (CSV does it itself)."""
    return F.nullif(col(c), F.lit(""))


def or_raise(text: Column, parsed: Column, what: str) -> Column:
    """``parsed``, but text that is there and did not parse stops the job:
    as NULL it would sort first in the dedup and beat the good row. ``parsed``
    stands in it once: it is the dear part, and not evaluated again per row."""
    lost = F.raise_error(F.concat(F.lit(f"unreadable {what}: "), text.cast("string")))
    return F.coalesce(parsed, F.when(F.trim(text.cast("string")) != "", lost))


def parse_timestamp(c: ColumnLike, formats: Sequence[str]) -> Column:
    """First format that parses wins; empty text is NULL, other text raises."""
    parsed = F.coalesce(*[F.try_to_timestamp(col(c), F.lit(f)) for f in formats])
    return or_raise(col(c), parsed, "timestamp")


def parse_date(c: ColumnLike, layout: str) -> Column:
    """Text in one date layout; empty text is NULL, other text raises."""
    return or_raise(col(c), F.try_to_timestamp(col(c), F.lit(layout)).cast("date"), "date")


def parse_number(c: ColumnLike, target: T.DataType) -> Column:
    """Text to a number. Counts may be written as ``5.0`` (a column with gaps
    is often stored as floats) but must be whole; other text raises. Plain
    digits are read as they are; only other text goes by a decimal."""
    if isinstance(target, (T.LongType, T.IntegerType)):
        plain = F.nullif(F.trim(col(c)), F.lit("")).try_cast(target)
        exact = or_raise(col(c), F.nullif(F.trim(col(c)), F.lit("")).try_cast("decimal(38,9)"), "number")
        fraction = exact != F.floor(exact)
        whole = F.when(fraction, F.raise_error(F.concat(F.lit("count is not whole: "), col(c)))).otherwise(exact)
        return F.coalesce(plain, whole.cast(target))
    return or_raise(col(c), F.nullif(F.trim(col(c)), F.lit("")).try_cast(target), "number")


def desc_nulls_first_key(cols: Iterable[ColumnLike]) -> list[Column]:
    """Struct fields whose ascending order equals ``c DESC NULLS FIRST``.

    For each column we emit (is_null, value): a NULL sorts above every value,
    otherwise the larger value wins. ``max(struct(...))`` over these fields
    picks the first row of ``ORDER BY c1 DESC NULLS FIRST, c2 ...``.
    """
    out: list[Column] = []
    for i, c in enumerate(cols):
        out.append(col(c).isNull().alias(f"_n{i}"))
        out.append(col(c).alias(f"_v{i}"))
    return out
