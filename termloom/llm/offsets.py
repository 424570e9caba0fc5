"""Running sums over a numbered table without one task that sees all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: consecutive numbers that are summed together; only one row for each such run meets in one task
RUN = 10_000


def shifts(df: DataFrame, key: str, n: str, run: int = RUN) -> DataFrame:
    """(key, shift): the sum of ``n`` over all smaller keys. Keys are distinct numbers from 0."""
    rows = df.select(key, n).withColumn("_run", F.floor(F.col(key) / run))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("_run").agg(F.sum(n).alias("_n"))
    runs = runs.select("_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_run").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(runs, "_run").select(
        key, (F.col("_before") + F.coalesce(F.sum(n).over(within), F.lit(0))).alias("shift")
    )
