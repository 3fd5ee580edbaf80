"""Regular-expression spans with code point offsets, by DataFrame functions.

A span is a struct (kind, rank, start, end, value). Spark has no function for
the offsets of all matches; they follow from the lengths of the matches and of
the pieces between them, since ``regexp_extract_all`` and ``split`` find the
same leftmost, non-overlapping matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CHUNK = 256


def _running(steps: Column, base: Column) -> Column:
    """base + the running sums of a short array."""
    return F.aggregate(
        steps, F.struct(base.alias("at"), F.array().cast("array<long>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out")),
        lambda acc: acc["out"])


def running_sums(steps: Column, n: Column) -> Column:
    """Running sums of an array of ``n`` longs (n > 0). Appending copies the
    array so far, so long arrays go chunk by chunk: the cost is linear."""
    zero = F.lit(0).cast("long")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _CHUNK).cast("int")),
                         lambda k: F.slice(steps, k * _CHUNK + 1, _CHUNK))
    ends = _running(F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x)), zero)
    return F.flatten(F.transform(
        chunks, lambda c, k: _running(c, F.when(k > 0, F.get(ends, k - 1)).otherwise(zero))))


def with_spans(df: DataFrame, text: str, out: str, pattern: str, kind: str, rank: int,
               where: Column | None = None, group: int = 0) -> DataFrame:
    """Add ``out``: the spans of all matches of ``pattern`` in column ``text``
    (of those rows for which ``where`` holds). ``value`` is the match, or its
    group ``group``."""
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    m, n = f"{out}_m", f"{out}_n"
    df = df.withColumn(m, found if where is None else F.when(where, found).otherwise(empty))
    df = df.withColumn(n, F.size(m))
    value = F.col(m) if not group else F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(F.col(text), pattern, -1), lambda g: F.length(g).cast("long"))
    lens = F.transform(F.col(m), lambda x: F.length(x).cast("long"))
    # a match ends where the one before it ends, plus the gap and its own length
    ends = running_sums(F.zip_with(F.slice(gaps, F.lit(1), F.col(n)), lens, lambda a, b: a + b), F.col(n))
    spans = F.transform(
        F.arrays_zip(ends.alias("e"), F.col(m).alias("m"), value.alias("v")),
        lambda z: F.struct(
            F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
            (z["e"] - F.length(z["m"])).alias("start"), z["e"].alias("end"), z["v"].alias("value")))
    none = F.array().cast("array<struct<kind:string,rank:int,start:bigint,end:bigint,value:string>>")
    return df.withColumn(out, F.when(F.col(n) > 0, spans).otherwise(none)).drop(m, n)


def by_place(*arrays: Column) -> Column:
    """All spans in order of start, then rank."""
    keyed = F.transform(F.concat(*arrays), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.sort_array(keyed)


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
