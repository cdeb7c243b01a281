"""The corpus pipeline: five stages that turn raw documents into packed sequences.

Every stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and returns a DataFrame; run() writes each stage's result as
Parquet in the shared folder and reads it back as the next one's input.  All
stages but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from moodlake.llm import exact_dedup, jaccard_join, language_id, packing, secret_scan
from moodlake.llm.common import documents, stored


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language go on; null texts, texts without a
    letter and texts that no learned language knows anything of do not."""
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts goes on, the one of smallest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates goes on, the one of smallest doc_id."""
    return jaccard_join.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document goes on; found secrets are masked in its text, and n_chars follows."""
    return secret_scan.mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", keep_languages), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies),
          ("secret_scan", mask_secrets), ("packing", pack_sequences)]

#: None: prediction, masking by a trained model and tokenisation are beyond SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
