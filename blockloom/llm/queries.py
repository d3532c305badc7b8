"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import (
    bpe, conversations, fingerprints, html_extract, language_id, lexical_search, licenses, line_dedup, mixing, ngram_join, packing, quality_divergence,
    token_counts,
)
from blockloom.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {"op2_mix_sources": mixing.oracle(), "op8_line_dedup": line_dedup.oracle(), "op12_ranked_search": lexical_search.oracle()}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@_query
def op1_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality_divergence.quality(table(spark, folder, "documents"))


@_query
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept")


@_query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents laid out as a tree of files, 64 ids to a directory, of which each sixteenth is named as a license file."""
    name = F.when(F.col("doc_id") % 16 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", "source", "lang", F.expr("doc_id div 64").cast("string"), name)
    return licenses.scan_licenses(table(spark, folder, "documents").withColumn("path", path))


@_query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.with_digests(bpe.decode(encoded, ranks)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, folder, "documents"))


@_query
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


@_query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The source column stands for the host, the lang column for the declared language."""
    return language_id.identify(table(spark, folder, "documents")).select("doc_id", "lang", "source", "language", "posterior", "n_trigrams", "kept")


@_query
def pages_language(spark: SparkSession, folder: str) -> DataFrame:
    """Operator 7 over the pages, with the language of their markup and the hosts and suffixes of their addresses."""
    return language_id.identify_pages(table(spark, folder, "pages"))


@_query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@_query
def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


@_query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@_query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    original = table(spark, folder, "conversations")
    return conversations.audited(original, conversations.damage(original))


@_query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    index, documents = lexical_search.build_index(table(spark, folder, "documents"))
    return lexical_search.search(index, documents, table(spark, folder, "benchmark"))


@_query
def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
