"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import public_tokenizers
from vendaflow.llm import (
    benchmark, credentials, language, pieces, prefixes, quality, simhash, substrings, suffixes, urls, vectors, warc,
    whitening,
)
from vendaflow.llm.common import table
from vendaflow.session import scratch_path

VOCABULARY = "piece_bpe_32k.model"


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo n: decides which rows a model may learn from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), window=200)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    entries = urls.intervals(urls.list_changes(pages))
    return urls.judge(urls.dated_captures(pages), entries)


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(3) == 1
    model = language.fit(docs.filter(~held_out))
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path)


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    printed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.FactorisationMachine | None:
    """Learned from the labels of the documents of four folds out of five."""
    return quality.fit(docs, table(spark, sf_dir, "labels").filter(remainder(5) != 0))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.scores(docs, quality_model(spark, sf_dir, docs))
    return found.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    kept = F.sha2(F.col("kept").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digests(credentials.scan(table(spark, sf_dir, "documents")))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_suffix_dedup": suffix_dedup,
    "op2_url_filters": url_filters,
    "op3_language_id": language_id,
    "op4_sentencepiece": sentencepiece,
    "op5_warc": warc_round_trip,
    "op6_simhash": simhash_groups,
    "op7_decontamination": decontamination,
    "op8_quality": quality_scores,
    "op9_embedding_dedup": embedding_groups,
    "op10_substring_dedup": substring_dedup,
    "op11_secret_scan": secret_scan,
    "op12_prefix_trie": conversation_trie,
    "op13_embedding_whitening": embedding_whitening,
}

ORACLE_SQL = {
    "op2_url_filters": urls.JUDGE_SQL,
    "op5_warc": warc.RECORDS_SQL,
    "op7_decontamination": benchmark.CONTAINED_SQL,
    "op9_embedding_dedup": vectors.NEAR_SQL,
    "op10_substring_dedup": substrings.REMOVED_SQL,
    "op11_secret_scan": credentials.SCAN_SQL,
    "op12_prefix_trie": prefixes.PREFIX_SQL,
}
