"""Job: mbox archives to an e-mail table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.oversize import mark_oversized_global, oversized_running
from ..operators.parse import email_table, parse_messages, parsed, rejected, with_parse_metrics
from ..sources.emails_tsv import write_emails_tsv
from ..sources.mbox import scan_mbox, scan_mbox_list
from ..staging import job_folder, stage

TOO_LONG = "longer than four times the mean"
#: messages of one archive block whose running sums are made together
RANGE = 10_000


def with_oversized(messages: DataFrame, oversize: str | None) -> DataFrame:
    """Adds ``oversized``, by the length of the messages that could be parsed.

    ``global``: against the mean of all messages. ``running``: against the mean so far in
    the same archive. ``None``: no message is. All messages count, rejected ones with no
    length.
    """
    length = F.when(F.col("parse_error").isNull(), F.length("content"))
    if oversize is None:
        return messages.withColumn("oversized", F.lit(False))
    if oversize == "global":
        return mark_oversized_global(messages, length)
    if oversize == "running":
        # a compressed archive is one block, so blocks are cut into ranges
        ranged = messages.withColumn("_range", F.floor(F.col("seq") / RANGE))
        dropped, keys = oversized_running(ranged, length, ["path"], ["block_start", "_range"], ["seq"])
        marked = ranged.join(dropped.withColumn("oversized", F.lit(True)), keys, "left")
        return marked.withColumn("oversized", F.coalesce("oversized", F.lit(False))).drop("_range")
    raise ValueError(f"unknown oversize mode {oversize!r}")


def _write(emails: DataFrame, output_dir: str, fmt: str) -> None:
    if fmt == "tsv":
        write_emails_tsv(emails, output_dir)
    else:
        emails.write.mode("overwrite").format(fmt).save(output_dir)


def parse_archives(
    spark: SparkSession,
    output_dir: str,
    file_list: str | None = None,
    paths: str | list[str] | None = None,
    oversize: str | None = None,
    fmt: str = "tsv",
    strict_dividers: bool = False,
    rejects_dir: str | None = None,
    max_line_len: int | None = None,
    partitions: int | None = None,
) -> dict[str, int]:
    """Parse archives and replace ``output_dir``; returns the counts of the run.

    ``n_messages`` were seen, ``n_rejected`` could not be parsed, ``n_skipped`` were too
    long by the ``oversize`` rule. ``rejects_dir`` gets the place of every message that is
    not in the output, and why. Archives are read once. Only with a length rule or
    ``rejects_dir``, when messages are read more than once, are they staged, for the time
    of the job.
    """
    if (file_list is None) == (paths is None):
        raise ValueError("give either file_list or paths")
    scan, source = (scan_mbox, paths) if paths else (scan_mbox_list, file_list)
    raw = scan(spark, source, strict_dividers, raw=True, partitions=partitions)
    messages, seen = with_parse_metrics(parse_messages(raw, max_line_len))
    if oversize is None and rejects_dir is None:
        _write(email_table(parsed(messages)), output_dir, fmt)
        return dict(seen.get) | {"n_skipped": 0}
    with job_folder(spark, "parse-archives"):
        messages = with_oversized(stage(messages, "messages"), oversize)
        if oversize is not None:
            messages = stage(messages, "judged")
        n_skipped = messages.filter("oversized").count()
        _write(email_table(parsed(messages.filter("not oversized"))), output_dir, fmt)
        if rejects_dir:
            reason = F.when(F.col("oversized"), F.lit(TOO_LONG)).otherwise(F.col("parse_error"))
            rejected(messages.withColumn("parse_error", reason)).write.mode("overwrite").parquet(rejects_dir)
        return dict(seen.get) | {"n_skipped": n_skipped}
