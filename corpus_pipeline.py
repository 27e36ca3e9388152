"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, PII, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Nothing
but a stage's own decisions removes rows: texts of no known language, all but the least id of each near-duplicate group,
and contaminated documents. Personal data is written as <KIND> in the texts that stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import bpe_codec, decontaminate, lang_id, ngram_join, pii
from pairloom.llm.common import read, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.keep(docs, lang_id.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit integers) and the digest of the decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe_codec.encode(docs, path, decoded=True)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminated), ("PII", redacted), ("BPE encoding and decoding", encoded)]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
