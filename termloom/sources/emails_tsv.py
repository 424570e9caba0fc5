"""The one-line-per-e-mail text format: seven tab-separated fields, no header, no quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import escape_content, normalize_email, unescape_content
from ..functions.tokens import as_col
from ..schemas import EMAIL_FIELDS
from .spread import spread

_DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def email_line(df: DataFrame) -> Column:
    """The line of an e-mail row; every field is escaped, nulls are empty."""
    kinds = dict(df.dtypes)

    def field(name: str) -> Column:
        c = F.col(name)
        if kinds[name] == "timestamp":
            # written in UTC whatever the session's time zone is
            utc = F.to_utc_timestamp(c, F.current_timezone())
            c = F.date_format(utc, _DATE_FORMAT)
        return F.coalesce(escape_content(c.cast("string")), F.lit(""))

    return F.concat_ws("\t", *[field(f) for f in EMAIL_FIELDS])


def email_fields(line) -> Column:
    return F.split(as_col(line), "\t", -1)


def is_email_line(line) -> Column:
    return F.size(email_fields(line)) == len(EMAIL_FIELDS)


def parse_email_lines(
    lines: DataFrame, col: str = "value", mode: str = "strict", unescape_tabs: bool = True, drop_blank: bool = False
) -> DataFrame:
    """(email, content) of e-mail lines.

    A line without exactly seven fields fails the job (``strict``) or is left out
    (``permissive``; see :func:`rejected_lines`). Messages without an address form
    a user of their own unless ``drop_blank`` is set.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "permissive":
        lines = lines.filter(is_email_line(col))
    fields = email_fields(col)
    checked = F.when(F.size(fields) == len(EMAIL_FIELDS), fields).otherwise(
        F.raise_error(F.concat(F.lit("Invalid input line: "), F.col(col)))
    )
    docs = lines.select(checked.alias("fields")).select(
        normalize_email(F.get("fields", F.lit(EMAIL_FIELDS.index("email")))).alias("email"),
        unescape_content(F.get("fields", F.lit(EMAIL_FIELDS.index("content"))), unescape_tabs).alias("content"),
    )
    return docs.filter(F.col("email") != "") if drop_blank else docs


def rejected_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that are not e-mails, with the number of fields found."""
    return lines.filter(~is_email_line(col)).select(F.col(col), F.size(email_fields(col)).alias("n_fields"))


def read_emails_tsv(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "strict",
    unescape_tabs: bool = True,
    drop_blank: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """(email, content) of e-mail files or folders; a missing path fails at once.

    ``partitions`` deals the lines over that many tasks.
    """
    return parse_email_lines(spread(spark.read.text(path), partitions), "value", mode, unescape_tabs, drop_blank)


def write_emails_tsv(emails: DataFrame, path: str) -> None:
    emails.select(email_line(emails).alias("value")).write.mode("overwrite").text(path)
