"""From raw documents to token ids: language, lines, near copies, mixture, tokens.

Each stage reads what the one before it wrote and works on all of it; all but the last return the columns of documents.
Columns beyond those pass through them untouched, whatever their names are.  What null and empty texts, repeated rows and
null ids give is told by each operator; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import bpe, language_id, line_dedup, mixing, ngram_join
from blockloom.llm.tables import stored, table
from blockloom.session import scratch

#: Language identification is a trained model, which SQL does not express; tests hold the stages against plain Python.
ORACLE_SQL = None


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with further columns renamed out of the way of the operators, and the way back."""
    seen, own = set(), []
    for i, name in enumerate(docs.columns):
        own.append(name if name in COLUMNS and name not in seen else f"_further_{i}")
        seen.add(name)
    return docs.toDF(*own), lambda out: out.select(*own).toDF(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is told; the others go."""
    docs, back = _apart(docs)
    return back(language_id.identify(docs).where("kept"))


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the lines that match an earlier one, with their new length; a document left without words goes."""
    docs, back = _apart(docs)
    done = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.rlike("text", F.lit(mixing.WORD))
    return back(done.where(~emptied).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    docs, back = _apart(docs)
    return back(ngram_join.one_of_each(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """A sample that meets the token margins of sources, languages and topics."""
    docs, back = _apart(docs)
    return back(mixing.mix(docs).where("kept"))


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each text, and digests of them and of the text decoded from them."""
    docs = _apart(docs)[0].select("doc_id", "text")
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = stored(bpe.encode(docs, ranks, public_tokenizers.PATTERN))  # else each task holds a worker that encodes and one that decodes
    return bpe.with_digests(bpe.decode(encoded, ranks)).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
