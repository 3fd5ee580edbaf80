"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic) over all documents. The
cells' token weights are then raked: scaled in turn to the targets of each of
the three marginals, never above what a cell has, until the marginals hold. A
cell's weight over its tokens is the probability with which its documents are
sampled; the draw is a hash of id and text, so it is the same on every run.

Targets: a marginal's shares are its tokens to the power ``temper``
(normalised), or given ones (column, share). Shares apply to a budget of
``fraction`` of all tokens. What a category lacks for its target goes to the
others in proportion. Where the three marginals cannot hold at once the
weights are those of the round after which the misses stop shrinking; ``marginal_gap`` measures by how much.

Tokens are the ids that the tokenizer gives a text, plus an end id. Topics are
learned from all texts (see ``topics.py``); pass another column for topics of one's own.

Scale: texts are encoded where they are read, and only cells, counted map-side,
are shuffled. Raking sums the cells by each marginal with partial sums and joins
the sums back, so cells of a hot source, language or topic never gather; cells
come back to documents by a salted join.

Defined results: a null source or language is a category of its own, and so is
the topic of texts without tokens; empty texts count one token; rows without an id draw by their texts;
rows alike in id and text are drawn alike; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.llm.common import attach_salted, materialize, remove, written
from locus.llm.packing import VOCABULARY
from locus.llm.topics import Topics, fit_topics, topic_column, with_features, with_topic

DIMS = ("source", "lang", "topic")
NONE = "(none)"


def marginal_targets(cells: DataFrame, dim: str, budget: float, temper: float,
                     shares: DataFrame | None = None, rounds: int = 60) -> DataFrame:
    """(dim, target tokens): a share of the budget, none above what is there.

    A target is the smaller of ``have`` and level times share, with the one level
    at which the targets add up to the budget (or to all there is). A round
    raises the level so that the categories still below what they have would fill
    the budget; it sums one small table, and levels only rise, until no further
    category is full."""
    have = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("have"))
    if shares is None:
        rows = have.withColumn("share", F.pow("have", F.lit(temper)))
    else:
        rows = have.join(shares.select(dim, "share"), dim, "left").fillna(0.0, ["share"])
    rows = materialize(rows, "mixing-target")
    level, full = 0.0, -1
    for _ in range(rounds):
        short = F.col("have") > F.lit(level) * F.col("share")
        spent, open_shares, now = rows.agg(
            F.sum(F.when(~short, F.col("have"))), F.sum(F.when(short, F.col("share"))),
            F.sum((~short).cast("long"))).first()
        if not open_shares or now == full:
            break
        level, full = max(level, (budget - (spent or 0.0)) / open_shares), now
    return rows.select(dim, F.least("have", F.lit(level) * F.col("share")).alias("target"))


def _misses(rows: DataFrame, dims: list[str], budget: float) -> float:
    """The largest miss of a marginal's target as a share of the budget."""
    each = [rows.groupBy(d).agg((F.abs(F.sum("weight") - F.first(f"_{d}")) / F.lit(budget)).alias("miss")).select("miss")
            for d in dims]
    return reduce(DataFrame.unionAll, each).agg(F.max("miss")).first()[0] or 0.0


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, rounds: int = 36,
         per_look: int = 3, tolerance: float = 1e-4) -> tuple[DataFrame, float]:
    """Cells with ``weight``, and the largest miss of a marginal as a share of the budget.
    A round is one job; every ``per_look`` rounds the misses are looked at, and it
    ends when they are below ``tolerance`` or have not shrunk by it (the targets
    cannot hold at once)."""
    rows = cells
    for dim, target in targets.items():
        rows = rows.join(target.withColumnRenamed("target", f"_{dim}"), dim)
    whole = cells.agg(F.sum("tokens")).first()[0] or 1
    rows = materialize(rows.withColumn("weight", F.col("tokens") * F.lit(budget / whole)), "mixing-cells")
    gap, last = 0.0, float("inf")
    for done in range(1, rounds + 1):
        for dim in targets:
            now = rows.groupBy(dim).agg(F.sum("weight").alias("_now"))
            scaled = F.when(F.col("_now") > 0, F.col("weight") * F.col(f"_{dim}") / F.col("_now")).otherwise(0.0)
            rows = rows.join(now, dim).withColumn("weight", F.least(scaled, F.col("tokens").cast("double"))).drop("_now")
        rows = materialize(rows, "mixing-cells")
        if done % per_look == 0 or done == rounds:
            gap = _misses(rows, list(targets), budget)
            if gap <= tolerance or gap > last - tolerance:
                break
            last = gap
    return rows.drop(*[f"_{d}" for d in targets]), gap


def _draw(id_col: str, text_col: str, seed: int) -> Column:
    """A number in [0, 1) of a row's id and text: rows that share an id, or
    have none, draw by their texts."""
    return F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def _placed(df: DataFrame, columns: list[Column], id_col: str, text_col: str, source_col: str, lang_col: str,
            topic: Column | None, seed: int) -> DataFrame:
    """Per row ``columns``, its draw, source, lang, topic (null: to be learned) and text."""
    source, lang = (F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in (source_col, lang_col))
    return df.select(*columns, _draw(id_col, text_col, seed).alias("_draw"), source.alias("source"),
                     lang.alias("lang"), F.coalesce(topic.cast("string"), F.lit(NONE)).alias("topic")
                     if topic is not None else F.lit(None).cast("string").alias("topic"),
                     F.col(text_col).alias("_text"))


def _learned(placed: DataFrame, learn: bool, vocabulary: str) -> tuple[DataFrame, Topics | None, str]:
    """The rows without their texts, with tokens and topic; the topics; and the
    folder that the rows are read from."""
    sketches, path = written(with_features(placed, "_text", vocabulary), "mixing-sketches")
    model = fit_topics(sketches, "lang", "_draw") if learn else None
    return with_topic(sketches, model, "lang", none=NONE), model, path


def _probabilities(rows: DataFrame, fraction: float, temper: float,
                   shares: dict[str, DataFrame] | None) -> tuple[DataFrame, float]:
    """The cells' probabilities, and the marginal gap."""
    cells = materialize(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "mixing-cells")
    budget = fraction * (cells.agg(F.sum("tokens")).first()[0] or 0)
    if not budget:
        plan, gap = cells.withColumn("weight", F.lit(0.0)), 0.0
    else:
        targets = {d: marginal_targets(cells, d, budget, temper, (shares or {}).get(d)) for d in DIMS}
        plan, gap = rake(cells, targets, budget)
    return plan.select(*DIMS, (F.col("weight") / F.col("tokens")).alias("probability")), gap


def sampling_plan(df: DataFrame, fraction: float = 0.8, temper: float = 0.7, id_col: str = "doc_id",
                  text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
                  topic: Column | None = None, shares: dict[str, DataFrame] | None = None,
                  seed: int = 17, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: id, source, lang, topic, tokens, probability, kept, marginal_gap."""
    placed = _placed(df, [F.col(id_col).alias("_id")], id_col, text_col, source_col, lang_col, topic, seed)
    found, _, path = _learned(placed, topic is None, vocabulary)
    # documents' cells are written once, without texts and features
    rows = materialize(found, "mixing-rows")
    remove(df.sparkSession, path)
    plan, gap = _probabilities(rows, fraction, temper, shares)
    drawn = attach_salted(rows, plan, list(DIMS), F.col("_draw"))
    return drawn.select(F.col("_id").alias(id_col), *DIMS, "tokens", "probability",
                        (F.col("_draw") < F.col("probability")).alias("kept"), F.lit(gap).alias("marginal_gap"))


def keep_sampled(df: DataFrame, fraction: float = 0.8, temper: float = 0.7, id_col: str = "doc_id",
                 text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
                 topic: Column | None = None, shares: dict[str, DataFrame] | None = None,
                 seed: int = 17, vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows that ``sampling_plan`` marks as kept, with their columns as they
    were. Decided row by row, so ids may be null or repeat across cells. Texts
    are encoded once to learn the topics and count the cells and, unless topics
    are given, once more to place the rows, which do not go to Python whole."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    placed = _placed(df, [row], id_col, text_col, source_col, lang_col, topic, seed)
    found, model, path = _learned(placed.drop("row"), topic is None, vocabulary)
    plan, _ = _probabilities(found, fraction, temper, shares)
    remove(df.sparkSession, path)
    if topic is None:
        own = topic_column(model, F.col("_text"), F.col("lang"), F.col("topic"), vocabulary, NONE)
        placed = placed.withColumn("topic", own)
    drawn = attach_salted(placed.drop("_text"), plan, list(DIMS), F.col("_draw"))
    return drawn.where("_draw < probability").select("row.*")
