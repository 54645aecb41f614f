"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.block_names import exact_groups
from tessera.llm.boilerplate import main_text
from tessera.llm.common import read_table
from tessera.llm.decontaminate import contaminated
from tessera.llm.langid import predict_documents
from tessera.llm.maxent_lm import score_documents
from tessera.llm.piece_codec import encode_documents
from tessera.llm.quality import judge_documents
from tessera.llm.sharding import shard_report
from tessera.llm.simhash import simhash_components
from tessera.llm.strassen_negatives import mine_embeddings
from tessera.llm.token_alignment import align_documents
from tessera.llm.token_counts import count_documents
from tessera.llm.warc import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_documents(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(read_table(spark, sf_dir, "documents"))


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_documents(read_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_embeddings(read_table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_maxent_lm": op7_maxent_lm,
    "op8_langid": op8_langid,
    "op9_html_extraction": op9_html_extraction,
    "op10_piece_codec": op10_piece_codec,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

#: The others draw at random, estimate, learn or search; tests/llm compares them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
h AS (SELECT page_id, n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS holder FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < holder THEN holder END AS refers_to
FROM h
""",
    # pages of the one template that the tables have: an article, bold the only inline element
    "op9_html_extraction": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, url, replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                                           '&#x27;', chr(39)), '&amp;', '&') AS t FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM d
""",
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW best AS (PARTITION BY t ORDER BY n DESC, doc_id)
""",
    "op12_hard_negatives": """
WITH u AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM u a JOIN u b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
