"""Document frequency: in how many users' texts a term occurs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_count(terms: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct users per term as ``doc_count``.

    Spark removes duplicate (term, user) pairs first, spread by both columns, so a
    term everybody uses does not gather in one task.
    """
    count = F.approx_count_distinct("email") if approx else F.count_distinct("email")
    return terms.groupBy("term").agg(count.alias("doc_count"))


def unique_users(docs: DataFrame) -> DataFrame:
    return docs.select("email").distinct()


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def total_docs(docs: DataFrame) -> DataFrame:
    """One row: number of distinct users, those without any term included."""
    return docs.agg(F.count_distinct("email").alias("total_docs"))


def df_ratio(doc_count: Column, total: Column, float32: bool = False) -> Column:
    """Share of users; ``float32=True`` divides and stores in single precision."""
    if float32:
        return (doc_count.cast("float") / total.cast("float")).cast("float")
    return doc_count.cast("double") / total.cast("double")


def document_frequency(doc_counts: DataFrame, total: DataFrame, float32: bool = False) -> DataFrame:
    """Attach the total, one row of ``total_docs``, to every term and divide."""
    joined = doc_counts.crossJoin(F.broadcast(total.agg(F.max("total_docs").alias("total_docs"))))
    return joined.select(
        "term",
        df_ratio(F.col("doc_count"), F.col("total_docs"), float32).alias("df"),
        "doc_count",
        "total_docs",
    )


def top_df(df: DataFrame, limit: int = 2000) -> DataFrame:
    """The terms used by most users, as a global top-k."""
    return df.orderBy(F.desc("df"), F.asc("term")).limit(limit)


def bad_words(df: DataFrame, max_df: float, limit: int | None = None) -> DataFrame:
    """Terms used by more than this share of the users, commonest first."""
    out = df.filter(~(F.col("df") <= F.lit(float(max_df)))).orderBy(F.desc("df"), F.asc("term"))
    return out if limit is None else out.limit(limit)
