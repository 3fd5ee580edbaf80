"""Quality verdicts by weak supervision (DataFrame functions only).

Every rule looks at one surface feature of a text and votes good (1), bad
(-1) or abstains (0). Expectation-maximisation over all documents estimates
how far each rule's votes can be trusted, and a document stays when its
posterior probability of being good reaches ``threshold``; no single rule
decides. Documents with equal vote patterns are one row of the estimation, so
it runs on at most 3**rules rows, however many documents there are.

The model: a class (good or bad) with prior ``p``, and per rule the chance of
a good, bad or no vote given the class, with add-one-share smoothing. It
starts from bad votes that are right 19 times in 20, good votes that are right
6 times in 10 and a prior of 0.85, which fixes which class is called good.

The base of the contract (``n_words`` below 50, or over half of the words in
repeated three-word windows) fails a document whatever the posterior says.

Defined results: a null text has no words; such rows and all below 50 words
fail; an empty table gives an empty result; repeated rows are judged each;
other columns are ignored. Repeated windows are found by 64-bit hashes whose
low bits give way to the word's position; equal hashes are confirmed on the
words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.llm.common import SPACE, materialize, text_of

#: The symbols that the contract counts.
SYMBOLS = "[#*$%&|<>]"


def _window_keys(words: Column, n: Column, mask: Column) -> Column:
    """Three-word windows as sorted keys: a window's hash with the low bits
    (``mask``) replaced by its position, so that equal windows are neighbours."""

    def key(w: Column, i: Column) -> Column:
        h = F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
        return h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))

    return F.sort_array(F.transform(F.slice(words, 1, n - 2), key))


def text_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the further features that only the rules use."""
    rows = df.select(F.col(id_col), text_of(text_col).alias("_t"))
    rows = rows.withColumn("_w", F.filter(F.split("_t", SPACE), lambda w: w != ""))
    rows = rows.withColumns({
        "n_words": F.size("_w").cast("long"),
        "_lines": F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        "_joined": F.array_join("_w", ""),
    })
    n, words, mask, keys = F.col("n_words"), F.col("_w"), F.col("_mask"), F.col("_keys")
    bits = F.length(F.bin(n))
    rows = rows.withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    rows = rows.withColumn("_keys", F.when(n >= 4, _window_keys(words, n.cast("int"), mask)))

    def same(a: Column, b: Column) -> Column:
        p, q = a.bitwiseAND(mask).cast("int"), b.bitwiseAND(mask).cast("int")
        alike = (F.get(words, p) == F.get(words, q)) & (F.get(words, p + 1) == F.get(words, q + 1)) & (
            F.get(words, p + 2) == F.get(words, q + 2))
        return (a.bitwiseXOR(b) <= mask) & (a.bitwiseXOR(b) >= 0) & alike

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get(keys, i - 1), F.get(keys, i + 1)
        return F.coalesce(same(x, before), F.lit(False)) | F.coalesce(same(x, after), F.lit(False))

    at = F.transform(F.filter(keys, repeated), lambda x: x.bitwiseAND(mask))
    rows = rows.withColumn("_at", F.sort_array(at))
    starts = F.col("_at")
    covered = F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"])
    letters = F.length("_joined") - F.length(F.regexp_replace("_joined", "\\p{L}+", ""))
    upper = F.length("_joined") - F.length(F.regexp_replace("_joined", "\\p{Lu}+", ""))
    symbols = F.length("_joined") - F.length(F.regexp_replace("_joined", f"{SYMBOLS}+", ""))
    return rows.select(
        id_col, "n_words",
        F.length("_joined").cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        letters.cast("long").alias("n_letters"),
        upper.cast("long").alias("n_upper"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"))


def rule_votes() -> dict[str, Column]:
    """Votes from the features. Rules for a defect vote bad or abstain: that a
    text lacks one defect says little about the others."""
    words, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")

    def share(part: str, whole: Column) -> Column:
        return F.col(part) / F.greatest(whole, F.lit(1))

    def vote(bad: Column, good: Column | None = None) -> Column:
        votes = F.when(bad, -1)
        return (votes if good is None else votes.when(good, 1)).otherwise(0)

    per_word, symbols = share("word_chars", words), share("n_symbols", words)
    upper, letters = share("n_upper", chars), share("n_letters", chars)
    return {
        "length": vote(words < 50, words >= 50),
        "word_length": vote((per_word < 2.5) | (per_word > 14)),
        "symbols": vote(symbols > 0.2),
        "dup_lines": vote(share("n_dup_lines", lines) > 0.3),
        "repeats": vote(share("n_repeat_words", words) > 0.35),
        "letters": vote(letters < 0.7),
        "upper": vote(upper > 0.4),
        # distinct words grow with about the root of a text's length
        "variety": vote(F.pow(F.col("n_distinct_words").cast("double"), 2) < 2 * words),
        "plain": vote(F.lit(False), (symbols < 0.02) & (upper < 0.1) & (letters > 0.8)),
    }


def _log_ratio(votes: list[str], tables: dict) -> Column:
    """log P(good, votes) - log P(bad, votes) under the current estimate."""
    total = F.lit(tables["prior"])
    for name in votes:
        total = total + F.element_at(F.array(*[F.lit(x) for x in tables[name]]), F.col(name) + 2)
    return total


def fit_votes(patterns: DataFrame, votes: list[str], rounds: int = 20, tolerance: float = 1e-4) -> dict:
    """EM over vote patterns (with their counts ``n``): per rule the log odds
    that a vote of -1, 0, 1 lends to good, and the prior's."""
    import math

    def tables(good: dict, bad: dict, n_good: float, n_bad: float) -> dict:
        out = {"prior": math.log((n_good + 1) / (n_bad + 1))}
        for v in votes:
            # a rule's votes may speak against its intent only up to no information
            odds = [math.log((g + 1) / (n_good + 3)) - math.log((b + 1) / (n_bad + 3)) for g, b in zip(good[v], bad[v])]
            out[v] = [min(odds[0], 0.0), odds[1], max(odds[2], 0.0)]
        return out

    now = {"prior": math.log(0.85 / 0.15)} | {v: [math.log(0.05 / 0.95), 0.0, math.log(0.6 / 0.4)] for v in votes}
    for _ in range(rounds):
        scored = patterns.withColumn("_g", 1 / (1 + F.exp(-_log_ratio(votes, now))))
        sums = [F.sum(F.col("n") * F.col("_g")).alias("g"), F.sum(F.col("n") * (1 - F.col("_g"))).alias("b")]
        for v in votes:
            for x in (-1, 0, 1):
                hit = F.when(F.col(v) == x, F.col("n")).otherwise(0)
                sums += [F.sum(hit * F.col("_g")).alias(f"g_{v}_{x}"), F.sum(hit * (1 - F.col("_g"))).alias(f"b_{v}_{x}")]
        s = scored.agg(*sums).first()
        if s["g"] is None:
            return now
        good = {v: [s[f"g_{v}_{x}"] for x in (-1, 0, 1)] for v in votes}
        bad = {v: [s[f"b_{v}_{x}"] for x in (-1, 0, 1)] for v in votes}
        new = tables(good, bad, s["g"], s["b"])
        moved = max(abs(a - b) for v in votes for a, b in zip(new[v], now[v]))
        now = new
        if moved < tolerance:
            break
    return now


def judge_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.5) -> DataFrame:
    """Per row: the contract's features, base_failed, kept and the posterior."""
    features = materialize(text_features(df, id_col, text_col), "quality-features")
    rules = rule_votes()
    votes = list(rules)
    voted = features.withColumns(rules)
    patterns = materialize(voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-votes")
    fitted = fit_votes(patterns, votes)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-_log_ratio(votes, fitted)))
    return voted.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (posterior >= threshold)).alias("kept"),
        posterior.alias("posterior"))
