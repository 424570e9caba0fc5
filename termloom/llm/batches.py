"""How many rows go to a Python worker at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS = 1_000
_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Lowers the session's Arrow batches to that many rows; texts are long, and a batch is held several times."""
    now = int(spark.conf.get(_CONF, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(_CONF, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most that many rows for what is executed inside."""
    before = spark.conf.get(_CONF, "10000")
    spark.conf.set(_CONF, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_CONF, before)
