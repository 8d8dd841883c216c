"""The corpus pipeline: documents in, encoded training documents out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vendaflow.llm import benchmark, pieces, quality, simhash, substrings
from vendaflow.llm.common import saved, table
from vendaflow.llm.queries import VOCABULARY, quality_model


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the factorisation machine does not reject."""
    return quality.keep_good(docs, quality_model(spark, sf_dir, docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest doc_id."""
    return simhash.near_dedup(docs, words_per_shingle=4, max_bits=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 20 words that occur earlier."""
    return substrings.without_repeats(docs, window=20)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return benchmark.without_items(docs, table(spark, sf_dir, "benchmark"), spare_nameless=False)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the decoded text."""
    return pieces.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]

# A trained model decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
