"""Input in more pieces than its files have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows dealt evenly over that many partitions; ``None`` leaves them where they are.

    For few files that can't be split, or whose row groups are few: analysing text costs far
    more than moving it. How many splits a scan has says nothing about where its rows are, so
    this is the caller's choice alone.
    """
    return df if partitions is None else df.repartition(partitions)
