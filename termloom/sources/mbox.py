"""mbox archives as a splittable source.

Spark's text source splits at ``lineSep``; with the divider as separator one huge
archive is read by many tasks, and a record is one whole message.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.let import let
from ..functions.mail import byte_view, view_bytes
from ..functions.tokens import as_col
from .spread import spread

# helpers travel with the job, so executors need no extra files
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIVIDER = "From "
_BLOCK = ["path", "block_start"]


def _normal_lines(c: Column) -> Column:
    return let(c, lambda v: F.when(v.contains("\r"), F.regexp_replace(v, "\r\n?", "\n")).otherwise(v))


def _one_final_newline(c: Column) -> Column:
    return F.concat(F.regexp_replace(c, r"\n+$", ""), F.lit("\n"))


@F.arrow_udf(BooleanType())
def _is_first(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Whether a row is the first record of its file: the first of a task with block 0 of that file."""
    before = None
    for paths, starts in batches:
        first = []
        for path, start in zip(paths.to_pylist(), starts.to_pylist(), strict=True):
            first.append(start == 0 and path != before)
            before = path
        yield pa.array(first, pa.bool_())


def _joined_at_blank_lines(records: DataFrame) -> DataFrame:
    """Records whose predecessor does not end in a blank line, joined with it.

    ``records`` are (path, block_start, seq, value), where a value lacks the line end before
    the next divider. A block passes on two things only: how its last record ends, and in
    which block the message that reaches its end began, so no file is gathered in one task.
    """
    ends_blank = F.col("value").rlike(r"\n\z") | (F.col("value") == "")
    lean = records.select(*_BLOCK, "seq", ends_blank.alias("blank"))
    in_block = Window.partitionBy(*_BLOCK).orderBy("seq")
    lean = lean.withColumn("starts", F.lag("blank").over(in_block))
    # what comes before a block's first record is the last record of the block before
    blocks = Window.partitionBy("path").orderBy("block_start")
    last = lean.groupBy(*_BLOCK).agg(F.max_by("blank", "seq").alias("blank"), F.min("seq").alias("first_seq"))
    last = last.withColumn("blank_before", F.coalesce(F.lag("blank").over(blocks), F.lit(True)))
    lean = lean.join(last.select(*_BLOCK, "blank_before"), _BLOCK).select(
        *_BLOCK, "seq", F.coalesce("starts", "blank_before").alias("starts")
    )
    # the message a record belongs to: the last start up to it, in its block or an earlier one
    here = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lean = lean.withColumn("own", F.last(F.when(F.col("starts"), F.col("seq")), ignorenulls=True).over(here))
    ended = lean.groupBy(*_BLOCK).agg(F.max_by("own", "seq").alias("open"))
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    ended = ended.select(*_BLOCK, F.last("open", ignorenulls=True).over(earlier).alias("open_before"))
    owner = lean.join(ended, _BLOCK).select(*_BLOCK, "seq", F.coalesce("own", "open_before", "seq").alias("message_seq"))
    joined = records.join(owner, [*_BLOCK, "seq"])
    parts = F.array_sort(F.collect_list(F.struct("block_start", "seq", "value")))
    return (
        joined.groupBy("path", "message_seq")
        .agg(parts.alias("parts"), F.max("first").alias("first"))
        .select(
            "path",
            F.get("parts", F.lit(0))["block_start"].alias("block_start"),
            F.col("message_seq").alias("seq"),
            F.array_join(F.col("parts.value"), "\n" + DIVIDER).alias("value"),
            "first",
        )
    )


def scan_mbox(
    spark: SparkSession,
    paths: str | list[str],
    strict: bool = False,
    raw: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Messages of mbox files (files, folders or globs), each with its divider line.

    A message's place in its file is ``(path, block_start, seq)``. Every line that
    starts with ``From `` begins a message; ``strict=True`` also wants a blank line
    before it. Text before the first divider is a message of its own. Trailing
    blank lines are reduced to one line end. ``raw=True`` leaves ``message`` as the
    bytes of the file, else it is their text in UTF-8. ``partitions`` deals the
    messages over that many tasks.
    """
    scanned = spark.read.text(paths, lineSep="\n" + DIVIDER).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").cast("binary").alias("value"),
        # told from the bytes: a test of what they become would be pushed down, and make that twice.
        # Only what begins like a blank record is looked through
        F.when(
            F.substring("value", 1, 1).isin("", " ", "\r"), F.trim(F.regexp_replace("value", r"\r\z", "")) == ""
        ).otherwise(False).alias("blank"),
    )
    # only a file's first record can have its divider, or none at all; all others lost theirs to the separator.
    # It looks back, so no row may be filtered before it is asked; the messages themselves stay in the JVM
    marked = scanned.withColumn("first", _is_first.asNondeterministic()(*_BLOCK))
    if not strict:
        marked = marked.filter("not blank")
    marked = marked.withColumn("value", _normal_lines(F.regexp_replace(byte_view("value"), r"\r\z", "")))
    records = _joined_at_blank_lines(marked) if strict else marked
    whole = F.when(F.col("first"), F.col("value")).otherwise(F.concat(F.lit(DIVIDER), F.col("value")))
    if strict:
        records = records.filter(F.length(F.trim(F.col("value"))) > 0)
    messages = records.select(
        *_BLOCK, "seq", view_bytes(_one_final_newline(whole)).alias("message")
    )
    if not raw:
        messages = messages.withColumn("message", F.col("message").cast("string"))
    return spread(messages, partitions)


def scan_mbox_list(
    spark: SparkSession, file_list: str, strict: bool = False, raw: bool = False, partitions: int | None = None
) -> DataFrame:
    """Messages of all mbox files named in a text file, one path per line.

    The names, not the data, pass through the driver, as they do for any scan; for very
    many files give a folder or a glob to :func:`scan_mbox` instead.
    """
    names = [r.value.strip() for r in spark.read.text(file_list).collect()]
    return scan_mbox(spark, [n for n in names if n], strict, raw, partitions)


def split_mbox(df: DataFrame, col: str) -> DataFrame:
    """Messages of archives that sit in a text column, with their position ``seq``.

    The other columns are carried along.
    """
    others = [c for c in df.columns if c != col]
    pieces = F.split(_normal_lines(as_col(col)), r"(?m)^" + DIVIDER)
    return (
        df.select(*others, F.posexplode(pieces).alias("seq", "piece"))
        .filter((F.col("seq") > 0) | (F.col("piece") != ""))
        .select(
            *others,
            "seq",
            _one_final_newline(
                F.when(F.col("seq") > 0, F.concat(F.lit(DIVIDER), F.col("piece"))).otherwise(F.col("piece"))
            ).alias("message"),
        )
    )


def write_mbox(messages: DataFrame, path: str, col: str = "message") -> None:
    """Write whole messages (divider line included) as mbox files."""
    messages.select(F.regexp_replace(as_col(col), r"\n$", "").alias("value")).write.mode("overwrite").text(path)
