"""mbox files that keep arriving, each file once, whatever stops and starts in between.

The stream only tells which files are new: a file's messages are then read as from any archive,
split over tasks, with the same places and the same strict joining. A batch is written to a
folder of its own, which a batch that is repeated after a failure replaces; so nothing is lost
and nothing comes twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.mbox import scan_mbox

_FILE = "path string, modificationTime timestamp, length long, content binary"


def _new_files(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    # the content is never read: only the names are asked for
    files = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", files_per_batch)
    return files.load(folder).select("path")


def stream_mbox(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    strict: bool = False,
    files_per_batch: int = 1_000,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    **trigger,
) -> StreamingQuery:
    """Writes the messages of every mbox file that appears in ``folder`` to ``out``/batch=n.

    ``transform`` turns the messages (path, block_start, seq, message) into what is written.
    ``trigger`` is that of the stream, such as ``availableNow=True``. A file has to be moved into
    the folder whole, and is never read again.
    """

    def write(names: DataFrame, batch: int) -> None:
        # names of at most files_per_batch files
        paths = [r.path for r in names.collect()]
        if not paths:
            return
        messages = scan_mbox(names.sparkSession, paths, strict)
        rows = messages if transform is None else transform(messages)
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream = _new_files(spark, folder, files_per_batch).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"processingTime": "0 seconds"})).start()


def streamed(spark: SparkSession, out: str) -> DataFrame:
    """All that has been written so far, without the number of the batch."""
    return spark.read.parquet(out).drop("batch")
