"""Multi-party perspective rotation of dialogues (DataFrame functions only).

For every participant of a conversation the whole dialogue is rendered with
that speaker as ``assistant``; every other speaker is a ``user`` who carries
a name; ``system`` turns stay ``system`` and are nobody's perspective. A turn
becomes the segment::

    <|im_start|>user name=alice\\ntext<|im_end|>\\n

Only the assistant's text and its end mark are trained on: ``loss_start`` and
``loss_end`` are code point offsets in the rendered dialogue (null for turns
that are masked out). The dialogue of a perspective is its segments joined in
order of ``position``; ``seg_start`` places each of them, so a long dialogue
never has to sit in one row or one task.

A hot conversation is not collected: turns are dealt to ranges of about equal
size in the order of (conversation, turn, role, text), so that one conversation,
and even one turn number or none, may span many of them. Ranges are summed each
by itself and their running totals added back; speakers meet turns by
conversation and range.

Defined results: turns in order of turn, role, text (nulls first), repeated
rows each count; a null role is the speaker ``unknown``; a null text is
empty; a null conv_id is a conversation of its own; a null turn comes first;
names keep letters, digits, ``_`` and ``-`` (others become ``_``), and two
roles that would then share a name get a suffix from their hash; markers in a
text are defused by a zero-width space. A conversation of system turns alone
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locus.llm.common import materialize, shuffle_partitions

#: Chat markers.
START, END = "<|im_start|>", "<|im_end|>"
BREAK = "​"


def _safe(text: Column) -> Column:
    for mark in (START, END):
        text = F.replace(text, F.lit(mark), F.lit(f"<{BREAK}{mark[1:]}"))
    return text


def _name(role: Column) -> Column:
    plain = F.regexp_replace(role, "[^\\p{L}\\p{N}_-]", "_")
    return F.when((plain == role) & (role != ""), plain).otherwise(
        F.concat(plain, F.lit("_"), F.substring(F.sha2(role, 256), 1, 6)))


def _turns(df: DataFrame, ranges: int) -> DataFrame:
    """Turns with a range and the number of turns before them in it. Equal
    (turn, role, text) rows share no order, so they are counted once (map-side)
    and numbered as a block. Written once: a range is a partition of the sort
    order, which a task that runs again must not draw anew."""
    rows = df.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    blocks = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(blocks.repartitionByRange(ranges, *order).withColumn("rng", F.spark_partition_id()), "chat-turns")
    inner = Window.partitionBy("conv_id", "rng").orderBy("turn", "role", "text")
    before = F.sum("n").over(inner.rowsBetween(Window.unboundedPreceding, -1))
    return ranged.withColumn("before", F.coalesce(before, F.lit(0)))


def _prefix(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per (keys, rng) the sum of ``value`` over the earlier ranges."""
    sums = rows.groupBy(*keys, "rng").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*keys).orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, "rng", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))


def _join_null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    a, b = a.alias("a"), b.alias("b")
    on = None
    for k in keys:
        same = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = same if on is None else on & same
    return a.join(b, on).select("a.*", *[f"b.`{c}`" for c in b.columns if c not in keys])


def rotate_perspectives(df: DataFrame, system_role: str = "system",
                        ranges: int | None = None) -> DataFrame:
    """One row per (conversation, perspective, turn): position, turn, speaker,
    chat_role, name, segment, seg_start, loss_start, loss_end. ``ranges``: as
    many as the session has shuffle partitions unless given."""
    turns = _turns(df, ranges or shuffle_partitions(df.sparkSession))
    speakers = turns.where(F.col("role") != system_role).select(
        "conv_id", F.col("role").alias("perspective")).distinct()
    held = turns.select("conv_id", "rng").distinct()
    seen = _join_null_safe(turns, _join_null_safe(held, speakers, ["conv_id"]), ["conv_id", "rng"])
    mine, system = F.col("role") == F.col("perspective"), F.col("role") == system_role
    chat_role = F.when(system, "system").when(mine, "assistant").otherwise("user")
    name = F.when(~system & ~mine, _name(F.col("role")))
    seen = seen.withColumns({"chat_role": chat_role, "name": name})
    head = F.concat(F.lit(START), "chat_role",
                    F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n"))
    seen = seen.withColumns({"head": head, "segment": F.concat(
        head, _safe(F.col("text")), F.lit(f"{END}\n"))})
    seen = seen.withColumns({"seg_len": F.length("segment").cast("long"),
                             "block_len": F.length("segment") * F.col("n")})
    keys = ["conv_id", "perspective"]
    inner = Window.partitionBy(*keys, "rng").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, -1)
    seen = seen.withColumn("chars", F.coalesce(F.sum("block_len").over(inner), F.lit(0)))
    totals = _prefix(seen, keys, "block_len").withColumnRenamed("_base", "char_base")
    counts = _prefix(seen, keys, "n").withColumnRenamed("_base", "turn_base")
    bases = _join_null_safe(totals, counts, [*keys, "rng"])
    placed = _join_null_safe(seen, bases, [*keys, "rng"])
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    start = F.col("char_base") + F.col("chars") + F.col("copy") * F.col("seg_len")
    loss = F.col("chat_role") == "assistant"
    return placed.select(
        "conv_id", "perspective",
        (F.col("turn_base") + F.col("before") + F.col("copy")).cast("long").alias("position"),
        "turn", F.col("role").alias("speaker"), "chat_role", "name", "segment",
        start.cast("long").alias("seg_start"),
        F.when(loss, start + F.length("head")).cast("long").alias("loss_start"),
        F.when(loss, start + F.col("seg_len") - 1).cast("long").alias("loss_end"))
