"""Exact deduplication by skew-safe combining.

Texts are equal when identical after lower-casing A-Z. Three combining
stages, each comparing the full content and not only its digest:

1. inside a task (the map side of the first aggregate) equal texts collapse;
2. what tasks have left meets under (digest, salt, content). The salt comes
   from the id, so a text that a third of all rows hold is spread over
   ``salts`` tasks;
3. at most ``salts`` winners of a text meet under (digest, content).

The classes then go back to the rows by a salted join on (digest, second
hash, length). Should two different contents ever share that key the job
fails instead of mixing them.

Defined results: a null text counts as empty (all empty texts are one class);
the row with the largest id stays; a null id is smaller than any other; rows
that repeat an id with equal texts count each, and one of them stays.
An empty table gives an empty result. Other columns are not looked at, so
clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.llm.common import ascii_lower, attach_salted, text_of

KEY = ["_digest", "_fp", "_len"]


def _content(df: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    return df.select(
        F.col(id_col).alias("_id"), row.alias("_row"), ascii_lower(text_of(text_col)).alias("_norm"),
    ).select("_id", "_row", "_norm", F.sha2("_norm", 256).alias("_digest"))


def _fingerprint() -> list[Column]:
    return [F.xxhash64("_norm").alias("_fp"), F.octet_length("_norm").alias("_len")]


def content_classes(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct content: key, winner (largest id, then row hash), size."""
    best = F.max(F.struct("_id", "_row")).alias("_best")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts))).groupBy(
        "_digest", "_salt", "_norm").agg(best, F.count(F.lit(1)).alias("_n"))
    merged = salted.groupBy("_digest", "_norm").agg(
        F.max("_best").alias("_best"), F.sum("_n").alias("_size"))
    keyed = merged.select("_digest", *_fingerprint(), "_best", "_size")
    one = keyed.groupBy(*KEY).agg(F.max("_best").alias("_best"), F.max("_size").alias("_size"),
                                  F.count(F.lit(1)).alias("_contents"))
    return one.where(F.assert_true(
        F.col("_contents") == 1, "two contents share digest, hash and length").isNull())


def _classified(df: DataFrame, id_col: str, text_col: str, row: Column, salts: int) -> DataFrame:
    """One row per (id, row mark, content): times it occurs, its class's winner and size."""
    rows = _content(df, id_col, text_col, row)
    # a class of one needs no join
    classes = content_classes(rows, salts).where("_size > 1").drop("_contents")
    light = rows.select("_id", "_row", "_digest", *_fingerprint()).groupBy("_id", "_row", *KEY).agg(
        F.count(F.lit(1)).alias("_times"))
    own = F.struct(F.col("_id"), F.col("_row"))
    return attach_salted(light, classes, KEY, F.struct("_id", "_row"), salts).select(
        "_id", "_row", "_digest", "_times", F.coalesce("_best", own).alias("_best"),
        F.coalesce("_size", F.lit(1)).alias("_size"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                salts: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    found = _classified(df, id_col, text_col, F.lit(0), salts)
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return each.select(
        F.col("_id").alias(id_col), F.col("_best._id").alias("keep_id"),
        F.col("_size").cast("long").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_best._id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_digest").alias("text_sha256"))


def keep_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               salts: int = 16) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows go by id and a hash over all columns, not by position, so the rows
    may be dealt anew between the decision and the join. Rows alike in every
    column are one row."""
    row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if "map" in t else F.col(f"`{c}`")
                       for c, t in df.dtypes])
    found = _classified(df, id_col, text_col, row, salts).where(F.col("_size") > 1)
    wins = F.struct("_id", "_row") == F.col("_best")
    drop = found.where(~wins).select("_id", "_row")
    again = found.where(wins & (F.col("_times") > 1)).select("_id", "_row")
    tagged = df.withColumn("_row", row)
    same = tagged[id_col].eqNullSafe(F.col("r._id")) & (tagged["_row"] == F.col("r._row"))
    marks = drop.withColumn("_drop", F.lit(True)).unionByName(again.withColumn("_drop", F.lit(False)))
    joined = tagged.join(marks.alias("r"), same, "left")
    single = joined.where(F.col("_drop").isNull()).select(*[tagged[f"`{c}`"] for c in df.columns])
    twice = joined.where(~F.col("_drop")).groupBy("r._id", "r._row").agg(
        F.first(F.struct(*[tagged[f"`{c}`"] for c in df.columns])).alias("_one")).select("_one.*")
    return single.unionByName(twice)
