"""Secret scans through a trigram inverted index (DataFrame functions only).

From every rule's regular expression a Boolean trigram query is derived: what
a match must contain, as an AND of ORs of ANDs of trigrams. The index holds,
for the trigrams that some query asks for, the postings (trigram, id) of all
documents over their lower-cased whole texts. Per rule the postings are
intersected; what is left are candidates, and only these are verified with
the regular expression itself. Rules without mandatory trigrams scan every
text.

Base kinds of the contract: ``assign`` (its value of 6+ characters),
``access`` (20+ characters) and ``hex`` (24+ characters); a match that fails
is dropped and not tried again. The method adds the kinds of ``RULES`` beyond
these. Lower-casing can only add candidates, so none is lost; a posting list
is rows, never an array, so a frequent trigram is spread over tasks.

Postings name a document by its id and a hash of its text, so rows without an
id, or with one repeated id, spread like others.

Defined results: a null text is empty; rows alike in id and text share their
candidate rules and are verified each; null ids are ids; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.llm.common import text_of
from locus.llm.spans import as_text, by_place, with_spans


class Rule(NamedTuple):
    kind: str
    pattern: str
    base: bool
    group: int = 0  # the group whose length must reach ``least``
    least: int = 0


#: The contract's rules, then the method's own.
RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", True, 0, 20),
    Rule("hex", "[0-9a-f]{24,}", True),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", False),
    Rule("google", "AIza[0-9A-Za-z_-]{35}", False),
    Rule("stripe", "[rs]k_live_[0-9A-Za-z]{16,}", False),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+", False),
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", False),
)

#: A query: every one of the clauses must hold; a clause holds when all
#: trigrams of one of its alternatives occur.
Query = list[list[frozenset[str]]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str, most: int = 64) -> Query:
    """The mandatory trigrams of a regular expression, in lower case.

    The parsed expression is walked from left to right with the set of strings
    that the current stretch can be; what is not a small set of strings ends
    the stretch, which then gives a clause."""
    clauses: Query = []
    stretch: list[set[str]] = [{""}]

    def close() -> None:
        found = {_trigrams(s) for s in stretch[0]}
        if frozenset() not in found:
            least = [a for a in found if not any(b < a for b in found)]
            clauses.append(sorted(least, key=sorted))
        stretch[0] = {""}

    def options(op, arg) -> set[str] | None:
        """All strings that a part can be, if these are few."""
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN:
            if any(o is not sre.LITERAL for o, _ in arg):
                return None
            return {chr(a).lower() for _, a in arg}
        if op is sre.SUBPATTERN:
            return strings(arg[3])
        if op is sre.BRANCH:
            sets = [strings(b) for b in arg[1]]
            return None if None in sets else set().union(*sets)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1:
            inner = strings(arg[2])
            return None if inner is None else inner | ({""} if arg[0] == 0 else set())
        return None

    def strings(parts) -> set[str] | None:
        out = {""}
        for op, arg in parts:
            few = options(op, arg)
            if few is None or len(out) * len(few) > most:
                return None
            out = {a + b for a in out for b in few}
        return out

    def walk(parts) -> None:
        for op, arg in parts:
            few = options(op, arg)
            if few is not None and len(stretch[0]) * len(few) <= most:
                stretch[0] = {a + b for a in stretch[0] for b in few}
                continue
            close()
            if few is not None and len(few) <= most:
                stretch[0] = few
            elif op is sre.SUBPATTERN:
                walk(arg[3])
                close()
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                walk(arg[2])
                close()

    walk(sre_parser.parse(pattern, re.ASCII))
    close()
    return clauses


def document_key(id_col: str, text_col: str) -> Column:
    """An id alone may be null or repeat for any share of the rows: with a hash
    of the text such rows spread by their texts, and each has its own rules."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text"))


def build_index(df: DataFrame, id_col: str, text_col: str, grams: list[str]) -> DataFrame:
    """Postings: one row (gram, document key) per trigram of ``grams`` in a text."""
    low = F.lower(text_of(text_col))
    rows = df.select(document_key(id_col, text_col).alias("id"), low.alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return rows.select("id", F.explode(held).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(id, rules): the rules whose query the postings of an id satisfy."""
    spark = index.sparkSession
    terms = [(gram, rule, c, a, len(alternative))
             for rule, query in queries.items() for c, clause in enumerate(query)
             for a, alternative in enumerate(clause) for gram in sorted(alternative)]
    table = spark.createDataFrame(terms, "gram string, rule string, clause int, alternative int, need int")
    clauses = F.create_map(*[x for r, q in queries.items() for x in (F.lit(r), F.lit(len(q)))])
    # the terms are as many as the rules have trigrams
    met = index.distinct().join(F.broadcast(table), "gram").groupBy(
        "id", "rule", "clause", "alternative", "need").agg(F.count(F.lit(1)).alias("n")).where("n = need")
    rules = met.select("id", "rule", "clause").distinct().groupBy("id", "rule").agg(F.count(F.lit(1)).alias("n"))
    return rules.where(F.col("n") == clauses[F.col("rule")]).groupBy("id").agg(F.collect_set("rule").alias("rules"))


def _long_enough(spans: str, least: int) -> Column:
    return F.filter(spans, lambda s: F.length(s["value"]) >= least)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the id, counts of the base kinds, base_sha256, spans, n_other."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    grams = sorted({g for q in indexed.values() for clause in q for alternative in clause for g in alternative})
    found = candidates(build_index(df, id_col, text_col, grams), indexed)
    rows = df.select(F.col(id_col), text_of(text_col).alias("_t"), document_key(id_col, text_col).alias("_key"))
    rows = rows.join(found.select(F.col("id").alias("_id"), F.col("rules").alias("_rules")),
                     F.col("_key").eqNullSafe(F.col("_id")), "left").drop("_id", "_key")
    for rank, rule in enumerate(rules):
        where = F.coalesce(F.array_contains("_rules", rule.kind), F.lit(False)) if rule.kind in indexed else None
        rows = with_spans(rows, "_t", f"_{rule.kind}", rule.pattern, rule.kind, rank, where, rule.group)
        if rule.least:
            rows = rows.withColumn(f"_{rule.kind}", _long_enough(f"_{rule.kind}", rule.least))
    base = [F.col(f"_{r.kind}") for r in rules if r.base]
    other = [F.col(f"_{r.kind}") for r in rules if not r.base]
    return rows.select(
        id_col, *[F.size(f"_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in rules if r.base],
        F.sha2(as_text(by_place(*base)), 256).alias("base_sha256"),
        as_text(by_place(*base, *other)).alias("spans"),
        F.size(F.concat(*other)).cast("long").alias("n_other"))
