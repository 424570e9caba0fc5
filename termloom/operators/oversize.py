"""Filter of messages that are much longer than the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rule: how many times the mean, and from which message on.
FACTOR = 4
WARM_UP = 100


def _too_long(length: Column, total: Column, count: Column) -> Column:
    # whole-number division, as the rule is stated
    limit = F.floor(F.lit(FACTOR).cast("bigint") * total / count)
    return (count > WARM_UP) & (length > limit)


def mark_oversized_global(df: DataFrame, length: Column) -> DataFrame:
    """Adds ``oversized``: whether a row is longer than four times the mean of the whole table.

    One pass for the mean (a one-row result, broadcast), one to mark. Rows of null length
    count as rows, add no length, and are never too long.
    """
    mean = df.agg(
        F.coalesce(F.sum(length), F.lit(0)).alias("_total"), F.count(F.lit(1)).alias("_count")
    )
    return (
        df.crossJoin(F.broadcast(mean))
        .withColumn("oversized", F.coalesce(_too_long(length, F.col("_total"), F.col("_count")), F.lit(False)))
        .drop("_total", "_count")
    )


def skip_oversized_global(df: DataFrame, length: Column) -> DataFrame:
    """Drop rows longer than four times the mean of the whole table."""
    return mark_oversized_global(df, length).filter(~F.col("oversized")).drop("oversized")


def running_sizes(
    df: DataFrame, length: Column, group: list[str], chunk: list[str], order: list[str]
) -> DataFrame:
    """Add ``_count`` and ``_total``: rows and summed length so far within ``group``.

    A running sum over one huge group would sort it in a single task. Instead the
    group is cut into its ``chunk`` pieces (file blocks, ranges of the order key;
    chunks must follow each other in ``order``): the chunk sums get a running sum
    of their own, and each chunk only adds up its own rows.
    """
    sized = df.withColumn("_length", F.coalesce(length.cast("bigint"), F.lit(0).cast("bigint")))
    before = Window.partitionBy(*group).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        sized.groupBy(*group, *chunk)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_length").alias("_s"))
        .select(
            *group,
            *chunk,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s_before"),
        )
    )
    within = (
        Window.partitionBy(*group, *chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sized.withColumn("_n_here", F.count(F.lit(1)).over(within))
        .withColumn("_s_here", F.sum("_length").over(within))
        .join(sums, [*group, *chunk])
        .withColumn("_count", F.col("_n_here") + F.col("_n_before"))
        .withColumn("_total", F.col("_s_here") + F.col("_s_before"))
        .drop("_n_here", "_s_here", "_n_before", "_s_before")
    )


def oversized_running(
    df: DataFrame, length: Column, group: list[str], chunk: list[str], order: list[str]
) -> tuple[DataFrame, list[str]]:
    """Keys of the rows longer than four times the mean of the rows up to and including them.

    The mean also covers rows that were dropped before; a null length adds nothing to it and
    is never too long. The running sums are made from the keys and the length alone.
    """
    keys = list(dict.fromkeys([*group, *chunk, *order]))
    slim = df.select(*keys, length.cast("bigint").alias("_len"))
    sizes = running_sizes(slim, F.col("_len"), group, chunk, order)
    return sizes.filter(_too_long(F.col("_length"), F.col("_total"), F.col("_count"))).select(*keys), keys


def skip_oversized_running(
    df: DataFrame, length: Column, group: list[str], chunk: list[str], order: list[str]
) -> DataFrame:
    """Drop a row longer than four times the mean of the rows up to and including it.

    The texts themselves are shuffled only for the anti join, which Spark turns into a
    broadcast when few rows are dropped.
    """
    dropped, keys = oversized_running(df, length, group, chunk, order)
    return df.join(dropped, keys, "left_anti")
