"""From raw documents to packed training sequences; each stage is one operator.

Filtering stages return the columns of ``documents``; the last returns pieces of sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termloom.llm import langid
from termloom.llm.encoders import WORD_PIECES
from termloom.llm.near_dup import drop_near_duplicates
from termloom.llm.packing import pack
from termloom.llm.quality import drop_low_quality


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay: those with a letter and a score that no guess among many reaches."""
    return langid.drop_unidentified(docs, langid.fit(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay that pass the base rules and are more probably good than bad."""
    return drop_low_quality(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the end id 2, in pieces of sequences of 4096 ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), WORD_PIECES, end_id=2)


STAGES = [("language", language), ("quality", quality), ("near-dedup", dedup), ("packing", packing)]

#: fitted models, similarity of sets and tokenizers have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from what its predecessor has kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
