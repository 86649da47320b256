"""The registered queries: every operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, exact_dedup, jaccard_join, language_id, merkle, minhash, mixing, quality_model, quality_rules,
               secrets, sharding, substring_dedup, whitening)
from .common import read_documents, read_labels

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_documents(read_documents(spark, sf_dir), VOCABULARY, ["doc_id"], decode=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(read_documents(spark, sf_dir), read_labels(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_documents(spark, sf_dir), read_labels(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.drop_repeats(read_documents(spark, sf_dir), substring_dedup.digest)
    return rows.withColumnRenamed("kept", "kept_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_documents(spark, sf_dir), 40)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages_of(read_documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(read_documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(read_documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(read_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_quality_model, op3_quality_rules, op4_substring_dedup, op5_exact_dedup, op6_sharding,
    op7_language_id, op8_secrets, op9_mixing, op10_jaccard_join, op11_whitening, op12_minhash,
    op13_merkle_manifest)}
