"""A training corpus from `documents`, stage by stage, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import byte_bpe, exact_dedup, language_id, mixing, simhash
from tickloom.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell."""
    return language_id.keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's repetition rate asks."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the decoded text of every document of the mix."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.encode_decode(docs, vocabulary, public_tokenizers.PATTERN)
    return tokens.selectExpr("doc_id", "ids", "n_tokens", "decode(decoded, 'UTF-8') as decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: The network and the merges have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
