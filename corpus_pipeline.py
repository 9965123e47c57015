"""Corpus pipeline: from documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of documents. Null ids and texts pass as the operators
define: a null or empty text fails the quality rules, a row without an id is
never a copy of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import bpe_replay, decontaminate, quality_rules, secret_scan, simhash_gph
from eventide.session import shared_dir
from eventide.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule list learned from ``labels`` keeps."""
    return quality_rules.keep(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near copies."""
    return simhash_gph.keep_one(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets."""
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256, decoded_sha256)`` of all documents."""
    import public_tokenizers

    ranks = bpe_replay.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe_replay.recode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("secret scans", secrets), ("byte-level bpe", tokens)]

#: Learned rules, XXH64 fingerprints and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = shared_dir(spark, "corpus_pipeline")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
