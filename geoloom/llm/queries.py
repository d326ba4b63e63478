"""Queries of the training-data operators, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embedding_dups, exact_dedup, language, packing, pii, simhash, token_counts, toxicity, warc
from .storage import ship_code, stash


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

#: The key of surrogates in these queries; a deployment has its own.
PII_KEY = "an example key"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(_table(spark, sf_dir, "documents"), PII_KEY, count_col="n_entities").select("doc_id", "text", "n_entities")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, max_distance=2)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits that its length places. The trees
    are stored, as they are between batches of edits."""
    path = public_tokenizers.path("word_bpe_49k.json")
    trees, _ = stash(token_counts.build(_table(spark, sf_dir, "documents").select("doc_id", "text"), path), "segment-trees")
    edited = trees.withColumn("edits", token_counts.trial_edits(F.col("text")))
    return token_counts.recount(edited, path, with_text=False).select("doc_id", "n_tokens", "n_tokens_after", "reencoded_chars", "text_chars")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with exact_dedup.one_off_index(spark) as index:
        return exact_dedup.verdicts(_table(spark, sf_dir, "documents"), index)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=1)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.7)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(_table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator where markup and addresses are at hand; fitted on documents."""
    return language.identify_pages(_table(spark, sf_dir, "pages"), language.fit(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "language_id_pages": language_id_pages,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)""",
    "op5_embedding_near_dedup": """
        WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        sized AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM vectors),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.vec_id <> b.vec_id WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.95),
        reached(a, b) AS (SELECT vec_id, vec_id FROM vectors UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, min(b) AS component_id, vec_id = min(b) AS kept FROM vectors JOIN reached ON a = vec_id GROUP BY vec_id""",
    "op9_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), kept AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
        FROM kept""",
}
