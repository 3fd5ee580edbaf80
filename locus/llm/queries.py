"""Registered queries of the pipeline operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.common import documents
from locus.llm.exact_dedup import exact_dedup
from locus.llm.hard_negatives import mine_hard_negatives
from locus.llm.jaccard_join import jaccard_components
from locus.llm.language_id import identify
from locus.llm.mixing import sampling_plan
from locus.llm.packing import pack_documents
from locus.llm.perspective import rotate_perspectives
from locus.llm.pii import find_pii
from locus.llm.quality_votes import judge_quality
from locus.llm.secrets import find_secrets
from locus.llm.simhash_dedup import simhash_components
from locus.llm.vector_codes import compress_vectors
from locus.llm.warc import archive_round_trip


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling_plan(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(documents(spark, sf_dir, "pages"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(documents(spark, sf_dir, "conversations"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the id divides by 7 the label is first replaced, as the task asks."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(documents(spark, sf_dir, "embeddings"), label=moved)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(documents(spark, sf_dir, "embeddings"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_language_id, op3_pii, op4_packing, op5_secret_scan,
        op6_source_mixing, op7_exact_dedup, op8_quality_rules, op9_warc, op10_chat_formatting,
        op11_hard_negatives, op12_vector_codes, op13_simhash_dedup,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Product codes by a full search: each round is an assignment (a) and new codebooks (b)."""
    ctes = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, len(embedding) // {parts} AS k,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE {_FINITE}),
p AS MATERIALIZED (
  SELECT r, part, v[part * k + 1 : part * k + k] AS x FROM v, (SELECT unnest(range({parts})) AS part) t),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= {entries})"""]
    for i in range(rounds + 1):
        ctes.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, part, min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)
                           AS BIGINT) * {entries} + entry) AS best
  FROM p JOIN b{i} USING (part) GROUP BY r, part)""")
        if i < rounds:
            ctes.append(f"""
s{i} AS (SELECT part, best % {entries} AS entry, x, unnest(range(1, len(x) + 1)) AS pos FROM a{i} JOIN p USING (r, part)),
m{i} AS (SELECT part, entry, pos, floor(sum(x[pos]) / count(*)) AS mean FROM s{i} GROUP BY ALL),
n{i} AS (SELECT part, entry, list(mean ORDER BY pos) AS c FROM m{i} GROUP BY ALL),
b{i + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN n{i} USING (part, entry))""")
    return "WITH" + ",".join(ctes) + f""",
e AS (
  SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code,
         CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','),
                               ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN e USING (r), h"""


ORACLE_SQL: dict[str, str] = {
    # every two documents with a shingle in common (x), links (l), and all that links lead to (c)
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
  FROM w),
x AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS g FROM s),
l AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM x a JOIN x b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
c AS (SELECT r, r AS o FROM s UNION SELECT c.r, l.b FROM c JOIN l ON c.o = l.a)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id
FROM s JOIN c USING (r) JOIN s t ON c.o = t.r GROUP BY s.r, s.doc_id
""",
    "op11_hard_negatives": f"""
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM q a, q b WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same AND other <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
""",
    "op12_vector_codes": _codes_sql(),
    "op7_exact_dedup": f"""
WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM n WINDOW same AS (PARTITION BY norm)
""",
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, strlen(html) AS n, sha1(html) AS d,
             CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
      FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM r
""",
    "op10_chat_formatting": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
         replace(replace(coalesce(text, ''), '<|im_start|>', '<' || chr(8203) || '|im_start|>'),
                 '<|im_end|>', '<' || chr(8203) || '|im_end|>') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS position
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
s AS (
  SELECT t.conv_id, perspective, position, turn, role AS speaker,
         CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' ELSE 'user' END AS chat_role,
         CASE WHEN role <> 'system' AND role <> perspective THEN role END AS name, text
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (
  SELECT *, '<|im_start|>' || chat_role || coalesce(' name=' || name, '') || chr(10) AS head FROM s),
g AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM h),
o AS (
  SELECT *, coalesce(sum(length(segment)) OVER (
      PARTITION BY conv_id, perspective ORDER BY position
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT conv_id, perspective, CAST(position AS BIGINT) AS position, turn, speaker, chat_role, name, segment,
       CAST(before AS BIGINT) AS seg_start,
       CAST(CASE WHEN chat_role = 'assistant' THEN before + length(head) END AS BIGINT) AS loss_start,
       CAST(CASE WHEN chat_role = 'assistant' THEN before + length(segment) - 1 END AS BIGINT) AS loss_end
FROM o
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
