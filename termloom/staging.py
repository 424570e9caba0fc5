"""Intermediate tables that several branches of one job read.

A staged table is written once as parquet into the shared folder the cluster
names in ``spark.checkpoint.dir``. That cuts the lineage (a lost executor
re-reads the table instead of re-tokenising the corpus), and later branches
scan only the columns they need. Nothing is kept in executor memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# folder of the job that is running, if one has been begun, and the tables it has in the catalog
_job: ContextVar[str | None] = ContextVar("termloom_job", default=None)
_tables: ContextVar[list[str] | None] = ContextVar("termloom_tables", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the session's checkpoint directory, which must be set.

    A machine-local folder would not be readable by other machines, so none is made here.
    """
    configured = spark.conf.get(_CONF, "")
    if not configured:
        raise ValueError(f"set {_CONF} to a folder all executors can reach")
    return configured.rstrip("/")


def _unique(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    folder = _job.get() or f"{shared_dir(spark)}/termloom/{spark.sparkContext.applicationId}"
    return f"{folder}/{_unique(name)}"


@contextmanager
def job_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """What is staged inside goes to one folder, which is deleted at the end.

    For jobs that write their result to a file: nothing lazy may outlive the folder. A job
    within a job uses the outer one's folder.
    """
    if _job.get():
        yield _job.get()
        return
    path = new_path(spark, name)
    token, listed = _job.set(path), _tables.set([])
    try:
        yield path
    finally:
        for table in _tables.get():
            spark.sql(f"drop table if exists {table}")
        _tables.reset(listed)
        _job.reset(token)
        discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a staged table that nothing reads any more: what was made of it is written, too."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside are removed as soon as it has ended.

    For results that are written: nobody reads those shuffles again, and on local disks they
    would add up until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, "false")
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    ``path`` is one of :func:`new_path`, for callers that will :func:`discard` it.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` once in sorted buckets by ``keys`` and return the table.

    Joins and groupings by these keys read the buckets where they lie. The table has a name in
    the session's catalog, which a job drops at its end.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = "termloom_" + path.rsplit("/", 1)[1].replace("-", "_")
    with shuffles_removed(spark):
        in_buckets = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        in_buckets.option("path", path).option("compression", "zstd").saveAsTable(table)
    if _tables.get() is not None:
        _tables.get().append(table)
    return spark.table(table)
