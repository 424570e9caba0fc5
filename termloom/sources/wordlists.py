"""Word lists and result folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TERMS_DIR = "terms"
TERMS_BY_DF_DIR = "terms-by-df"


def read_stopwords(spark: SparkSession, path: str | None) -> DataFrame:
    """One word per line, taken verbatim; no path, no words."""
    if path is None:
        return spark.createDataFrame([], "term string")
    return spark.read.text(path).select(F.col("value").alias("term")).distinct()


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """Words of a list with ``#`` comments, blank lines and padded entries."""
    words = spark.read.text(path).select(F.trim("value").alias("term"))
    return words.filter((F.col("term") != "") & ~F.startswith("term", F.lit("#"))).distinct()


def write_terms(df: DataFrame, working_dir: str, folder: str = TERMS_DIR, fmt: str = "parquet") -> str:
    """Replace ``<working_dir>/<folder>`` with these rows."""
    path = f"{working_dir.rstrip('/')}/{folder}"
    if fmt == "tsv":
        line = F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns])
        df.select(line.alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)
    return path
