"""A training corpus from ``documents``: five stages, each written as Parquet
and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import exact_radix, language_mixture, ngram_join, packing, secret_ledger
from ferry.llm.queries import tokenizer_path
from ferry.llm.textbatch import documents, prepare
from ferry.plans.sizing import materialize

#: Least share of the predicted language in a document that stays.
LEAST_LANGUAGE_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a main language, go."""
    prepare(spark)
    return language_mixture.keep_languages(docs, None, LEAST_LANGUAGE_SHARE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    prepare(spark)
    return exact_radix.drop_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the smallest id stays."""
    prepare(spark)
    return ngram_join.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked."""
    prepare(spark)
    return secret_ledger.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of the corpus, piece by piece."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("ngram_jaccard_join", ngram_jaccard_join),
          ("secret_scans", secret_scans), ("packing", pack)]

#: The learned and packed stages have no SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
