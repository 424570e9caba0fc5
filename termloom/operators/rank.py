"""Ranking, nesting and flattening of per-user term lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def top_n_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, spread_by: str, limit_in_tasks: int | None = None
) -> DataFrame:
    """First ``n`` rows of every group.

    Spark keeps only ``n`` rows per group and task before it shuffles, up to an ``n`` of
    ``limit_in_tasks`` (by default Spark's own setting for this); beyond it, the same is done
    here in two explicit rounds, the first over parts of each group.
    """
    if limit_in_tasks is None:
        limit_in_tasks = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit_in_tasks:
        part = F.pmod(F.hash(spread_by), F.lit(SALTS))
        first = Window.partitionBy(*group, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_rank", F.row_number().over(first))
            .filter(F.col("_rank") <= n)
            .drop("_part", "_rank")
        )
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def sort_terms(top: DataFrame) -> DataFrame:
    """Users descending, their best terms first."""
    return top.orderBy(F.desc("email"), F.desc("score"), F.asc("term"))


def nest_terms(top: DataFrame) -> DataFrame:
    """One row per user with parallel arrays ``terms`` and ``scores``, best first.

    Only for lists already cut to a top-N, which bounds the arrays.
    """
    pairs = F.array_sort(
        F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("term"), F.col("score")))
    )
    return (
        top.groupBy("email")
        .agg(pairs.alias("pairs"))
        .select("email", F.col("pairs.term").alias("terms"), F.col("pairs.score").alias("scores"))
    )


def flatten_terms(nested: DataFrame) -> DataFrame:
    """One row per entry of the parallel arrays."""
    return nested.select(
        "email", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("scores").alias("score")))
    ).toDF("email", "term", "score")
