"""Term counts of mail that keeps arriving, slice by slice.

A store is a folder with one table of counts per slice, and a manifest that says which table
each slice has. A slice that is added again replaces its earlier table, so a job that was cut off
can simply be run again. Counts of the whole are the sum over the manifest's tables; texts are
never read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import shuffles_removed
from .llr import term_counts

_COUNTS = "email string, term string, k11 long"
_ENTRY = "slice string, table string"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def _manifest(spark: SparkSession, store: str) -> dict[str, str]:
    """Table of every slice; one small row for each, read by the driver as any list of files is."""
    if not _exists(spark, f"{store}/manifest"):
        return {}
    # a later entry of a slice replaces earlier ones
    rows = spark.read.schema(_ENTRY + ", nth long").json(f"{store}/manifest").orderBy("nth").collect()
    return {r.slice: r.table for r in rows}


def add_slice(spark: SparkSession, store: str, slice_name: str, terms: DataFrame) -> None:
    """Counts the terms (email, term) of a slice and enters them into the store.

    The counts are written first, under a name of their own; the slice has them from the moment
    when its line in the manifest is there. A slice without terms is entered, too. One slice
    is added at a time.
    """
    table = f"{store}/counts/{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        term_counts(terms).write.option("compression", "zstd").parquet(table)
    nth = len(spark.read.schema(_ENTRY).json(f"{store}/manifest").collect()) if _exists(spark, f"{store}/manifest") else 0
    entry = spark.createDataFrame([(slice_name, table, nth)], _ENTRY + ", nth long").coalesce(1)
    entry.write.mode("append").json(f"{store}/manifest")


def slices(spark: SparkSession, store: str) -> list[str]:
    return sorted(_manifest(spark, store))


def merged_counts(spark: SparkSession, store: str, only: list[str] | None = None) -> DataFrame:
    """(email, term, k11) over all slices of the store, or some."""
    tables = _manifest(spark, store)
    paths = [table for name, table in tables.items() if only is None or name in only]
    if not paths:
        return spark.createDataFrame([], _COUNTS)
    counts = spark.read.schema(_COUNTS).parquet(*paths)
    return counts.groupBy("email", "term").agg(F.sum("k11").alias("k11"))
