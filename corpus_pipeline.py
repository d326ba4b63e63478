"""A training corpus from raw documents, in stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns
a DataFrame, which ``run`` writes as Parquet in the shared folder and reads again, so that a
lost executor costs no more than a stage's own tasks. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from geoloom.llm import exact_dedup, language, near_copies, packing, pii
from geoloom.llm.queries import PII_KEY
from geoloom.llm.storage import release_heaps, ship_code, stash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted."""
    ship_code(spark)
    return language.keep_accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    with exact_dedup.one_off_index(spark) as index:
        return exact_dedup.keep_first(docs, index)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies (five-word shingles, Jaccard similarity 0.8 or more), the
    document with the smallest doc_id. SimHash links them first, prefixes what it leaves."""
    ship_code(spark)
    return near_copies.keep_one(docs, words=5, per_cent=80)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    return pii.replace(docs, PII_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ship_code(spark)
    release_heaps(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=1)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("simhash_near_dedup", near), ("pii", surrogates), ("packing", pack)]

#: SQL has no expression for the language model, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
