"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import (
    byte_cnn,
    class_model,
    fm_decontaminate,
    host_rules,
    near_duplicates,
    page_text,
    pii_boost,
    rtree_negatives,
    secret_scan,
    sentence_spans,
    sequence_packing,
    trie_variants,
)
from faremill.llm.piece_bpe import KEPT_WORDS, encode_documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_digests(docs: DataFrame, kept_words: int = KEPT_WORDS) -> DataFrame:
    """Number and digest of the ids of each text, and digest of what they decode to."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), kept_words).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_model.score_documents(_table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge_documents(_table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated(_table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.find_personal_data(_table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_pages(_table(spark, sf_dir, "pages"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sequence_packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pieces": op1,
        "op2_class_model": op2,
        "op3_secrets": op3,
        "op4_decontamination": op4,
        "op5_host_rules": op5,
        "op6_sentence_spans": op6,
        "op7_byte_cnn": op7,
        "op8_personal_data": op8,
        "op9_near_duplicates": op9,
        "op10_page_text": op10,
        "op11_spelling_variants": op11,
        "op12_hard_negatives": op12,
        "op13_sequence_packing": op13,
        "pipeline": pipeline,
    }


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM bw, unnest(generate_series(1, greatest(1, len(w) - 9))) AS g(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM win
), spots AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n)
), met AS (
  SELECT doc_id, i, s.n, item FROM spots s JOIN win USING (win)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM met) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

HOST_RULES = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t
), spots AS (
  SELECT doc_id, i, words[i:i + 2] AS win FROM w, unnest(generate_series(1, len(words) - 2)) AS g(i) WHERE len(words) >= 3
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM spots) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 2)) AS k FROM again) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT w.doc_id, host, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id)
), j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM j GROUP BY host
), total AS (
  SELECT sum(f) / sum(n) AS mean, avg(1.0 / n) AS part FROM h
), spread AS (
  SELECT mean, avg((f / n - mean) ** 2) - mean * (1 - mean) * any_value(part) AS own FROM h, total GROUP BY mean
), prior AS (
  SELECT mean, CASE WHEN own > 0 THEN least(greatest(mean * (1 - mean) / own - 1, 1), 1e6) ELSE 1e6 END AS strength FROM spread
), verdict AS (
  SELECT host, (f + mean * strength) / (n + strength) > 0.5 AS rejected FROM h, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM j JOIN verdict USING (host)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": DECONTAMINATION,
        "op5_host_rules": HOST_RULES,
        "op12_hard_negatives": HARD_NEGATIVES,
    }
