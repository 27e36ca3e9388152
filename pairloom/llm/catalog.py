"""The queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import bpe_codec, chat_format, decontaminate, embedding_dedup, lang_id, ngram_join, ngram_lm, pii, token_counts, toxicity
from pairloom.llm.common import read, remainder
from pairloom.llm.oracle import ORACLE  # noqa: F401


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents", "doc_id", "text", "lang"), remainder("doc_id", 4) == 2
    model = toxicity.learn(docs.where(~held_out), read(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out))
    scored = toxicity.score(docs, model, lang_col="lang")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "threshold", "flagged")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.over_limit(token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")), 4096)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe_codec.encode(read(spark, sf_dir, "documents", "doc_id", "text"), path, decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.expand(chat_format.with_probe(turns)))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.judge(decontaminate.find_hits(docs, benchmark))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(read(spark, sf_dir, "documents", "doc_id", "text")))


def op7_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    found = lang_id.predict(docs, lang_id.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents", "doc_id", "text"), remainder("doc_id", 7) == 2
    scored = ngram_lm.learn_and_score(docs.where(~held_out), docs)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_token_counts, op3_bpe_codec, op4_chat_format, op5_decontaminate, op6_pii, op7_lang_id, op8_embedding_dedup, op9_ngram_join, op10_ngram_lm)}
