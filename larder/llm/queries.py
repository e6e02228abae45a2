"""The queries of this subpackage: name -> ``(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    byte_bpe,
    decontaminate,
    hard_negatives,
    html_text,
    jaccard_join,
    language_id,
    quality_rules,
    sentencepiece_codec,
    token_counts,
    token_file,
    toxicity,
    warc,
    whitening,
)
from larder.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip_digests(table(spark, sf_dir, "documents"), PIECES)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.write_and_read(table(spark, sf_dir, "documents"), WORDS)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), BYTES)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", other))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_jaccard_join, op2_html_extraction, op3_token_counts, op4_sentencepiece, op5_warc,
              op6_quality_rules, op7_toxicity, op8_decontamination, op9_token_binary, op10_language_id,
              op11_whitening, op12_byte_bpe, op13_hard_negatives)
}

ORACLE_SQL: dict[str, str] = {
    "op5_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), g AS (
            SELECT payload_digest AS digest, max(page_id) AS largest FROM p WHERE payload_bytes >= 1000 GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN largest > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN largest > page_id THEN largest END AS refers_to
        FROM p LEFT JOIN g ON payload_digest = digest AND payload_bytes >= 1000
    """,
    "op8_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), bw AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS k, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS words
            FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
        ), dw AS (
            SELECT doc_id, k, i, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS words
            FROM d, (SELECT DISTINCT k FROM bw) AS ks, unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k
        ), hits AS (
            SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.words = bw.words
        ), covered AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + k)) AS t(j) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op13_hard_negatives": """
        WITH r AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), a AS (
            SELECT * FROM r WHERE id % 100 = 0
        ), s AS (
            SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
            FROM a, r WHERE a.id <> r.id
        ), p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 5
    """,
}
