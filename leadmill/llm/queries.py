"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leadmill.llm import (
    decontaminate,
    hard_negatives,
    hmm,
    html_text,
    langid,
    mixing,
    mtree,
    pii,
    quality_rules,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from leadmill.llm.shared import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned outside of the held-out fold."""
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words a balanced mix of all sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document lie in passages of the benchmark."""
    found = decontaminate.find_passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.contamination(found)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids in bit-packed files."""
    file = public_tokenizers.path("word_bpe_49k.json")
    return token_files.tokenized(table(spark, sf_dir, "documents"), file)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the group of near duplicates of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every document under a hidden Markov model."""
    return hmm.score_held_out(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.predict_held_out(table(spark, sf_dir, "documents"))


def op10_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector with all others."""
    return mtree.top_products(table(spark, sf_dir, "embeddings"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned outside of the held-out fold."""
    return quality_rules.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives just below the positives of every 100th vector."""
    return hard_negatives.mine_labelled(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with the spelling each is a variant of."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_html_text": op4_html_text,
    "op5_token_files": op5_token_files,
    "op6_simhash": op6_simhash,
    "op7_hmm_scores": op7_hmm_scores,
    "op8_personal_data": op8_personal_data,
    "op9_language_id": op9_language_id,
    "op10_mtree_topk": op10_mtree_topk,
    "op11_quality_rules": op11_quality_rules,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op3_decontamination": r"""
        WITH said AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), asked AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark WHERE item_id IS NOT NULL
        ), windows AS (
            SELECT DISTINCT item_id, size, words FROM (
                SELECT item_id, least(len(w), 10) AS size,
                       array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
                FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                      FROM asked WHERE len(w) > 0)
            )
        ), sizes AS (SELECT DISTINCT size FROM windows
        ), places AS (
            SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS words
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM said, sizes WHERE len(w) >= size)
        ), hits AS (
            SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, words)
        ), marked AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
                SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits
            ) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items,
                   string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits)
            GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words,
               coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM said LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op10_mtree_topk": """
        WITH good AS (
            SELECT DISTINCT vec_id,
                   [floor(64 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                       AS place
            FROM scored
        )
        SELECT query_id, place::INTEGER AS rank, vec_id, score
        FROM ranked WHERE place <= 20
    """,
    "op12_hard_negatives": """
        WITH good AS (
            SELECT vec_id, label, v FROM (
                SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v,
                       CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            )
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1
        ), scored AS (
            SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS alike,
                   list_inner_product(a.v, o.v)::BIGINT AS score
            FROM good a JOIN good o ON a.vec_id <> o.vec_id
            WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT * FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), ranked AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
                   p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                                      ORDER BY n.score DESC, n.vec_id) AS place
            FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
            WHERE 80 * p.score <= 100 * n.score AND n.score <= p.score
        )
        SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id,
               positive_score, negative_score
        FROM ranked WHERE place <= 5
    """,
}
