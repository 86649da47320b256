"""Corpus pipeline: documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwise.llm import bpe, exact_dedup, jaccard_join, language_id, mixing
from cartwise.llm.common import read_documents, written
from cartwise.llm.queries import VOCABULARY


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; learnt from the labelled rows of the same documents."""
    return language_id.known_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text (A-Z lower-cased): the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of near copies: the smallest id."""
    return jaccard_join.one_per_component(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids (little-endian 32-bit words) of every document of the mix."""
    return bpe.encode_documents(docs, VOCABULARY, ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", tell_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
]

# learnt language labels, hashed shuffles and byte-pair merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
