"""The operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import new_path
from . import langid, oracles
from .divergence import divergence
from .encoders import BYTE_LEVEL_PIECES, WORD_PIECES
from .licenses import scan_licenses
from .near_dup import near_duplicates
from .packing import pack
from .page_text import extract_pages
from .pieces import encode_and_decode
from .quality import quality
from .repeats import drop_repeats
from .sharding import shard_rows
from .token_files import token_digest, write_token_files
from .top_products import top_products
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer, BYTE_LEVEL_PIECES, end_id=2)
    return token_digest(spark, path)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, similarity=Fraction(85, 100))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"), weights=[1.0] * 24)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), WORD_PIECES, end_id=2
    )


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(_table(spark, sf_dir, "documents"))
    # two engines agree in so many places
    return found.withColumn("posterior", F.round("posterior", 6))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_pieces": op1_pieces,
    "op2_pages": op2_pages,
    "op3_licenses": op3_licenses,
    "op4_token_files": op4_token_files,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_shards": op6_shards,
    "op7_packing": op7_packing,
    "op8_top_products": op8_top_products,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_repeats": op12_repeats,
    "op13_divergence": op13_divergence,
}
ORACLES: dict[str, str] = dict(oracles.ORACLES)
