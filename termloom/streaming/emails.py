"""E-mail files that keep arriving.

Parsing, cleaning and analysis hold no state, so they run unchanged on a stream;
only the source differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.emails_tsv import parse_email_lines


def stream_emails_tsv(spark: SparkSession, folder: str, mode: str = "permissive", **options) -> DataFrame:
    """(email, content) of every e-mail file that appears in ``folder``."""
    return parse_email_lines(spark.readStream.text(folder), "value", mode, **options)
