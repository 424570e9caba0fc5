"""raw messages -> e-mails."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import mail
from ..schemas import EMAIL_FIELDS

ADDRESS_HEADERS = ["From", "To", "Cc", "Bcc"]
PLACE = ["path", "block_start", "seq"]


def parse_messages(raw: DataFrame, max_line_len: int | None = None, trim_author: bool = True) -> DataFrame:
    """One row per message: the e-mail fields, recipients and ``parse_error``.

    Columns of ``raw`` other than ``message`` are carried along. Headers are read
    by built-in expressions. Python only sees bodies that are multipart or
    transfer-encoded, header values with encoded words and rare charsets.

    ``message`` is text, or binary: then bodies are decoded by the charset that they
    declare, and headers as UTF-8. A message with a line or header beyond
    ``max_line_len`` signs, bytes if binary, is rejected; without a limit none is.
    """
    binary = dict(raw.dtypes)["message"] == "binary"
    if binary:
        raw = raw.withColumn("message", mail.byte_view("message"))
    coding = mail.BYTE_VIEW if binary else "utf-8"
    header_text = mail.utf8_text if binary else F.col
    carried = [c for c in raw.columns if c != "message"]
    # one projection per stage: each value is computed once and used by name
    whole = raw.select(*carried, mail.without_divider("message").alias("_mail"))
    split = whole.select("*", mail.header_block("_mail").alias("_head"))
    # the limit is for lines, and for headers after they are unfolded
    if max_line_len is None:
        long = F.lit(False)
    else:
        long = mail.over_long("_mail", max_line_len) | mail.over_long("_head", max_line_len)
    parts = split.select("*", long.alias("_long"))
    headers = parts.select(
        *carried,
        "_long",
        "_mail",
        "_head",
        (mail.needs_mime("_head") & ~F.col("_long")).alias("_mime"),
        header_text("_head").alias("_text_head"),
    )
    headers = headers.select(
        "*",
        *[
            mail.header_value("_text_head", name).alias(f"_{name}")
            for name in ("Message-ID", "In-Reply-To", "Subject")
        ],
        *[mail.address_marks(mail.header_value("_text_head", name)).alias(f"_{name}") for name in ADDRESS_HEADERS],
        (~F.col("_mime") & ~F.col("_long") & mail.is_text_body("_text_head")).alias("_plain"),
    )
    # the only projection that calls Python, for all values at once
    decoded = headers.select(
        "*",
        # names are decoded after the lists are taken apart: what they spell out parts nothing
        *[mail.decoded(f"_{name}").alias(f"_{name}_names") for name in ADDRESS_HEADERS],
        mail.decoded("_Subject").alias("subject"),
        mail.mime_body(F.when(F.col("_mime"), F.col("_mail")), coding).alias("_decoded"),
        (
            mail.charset_text(F.when(F.col("_plain"), mail.body_block("_mail")), mail.charset_of("_text_head"))
            if binary
            else F.when(F.col("_plain"), mail.body_block("_mail"))
        ).alias("_body"),
    )
    bodies = decoded.select(
        "*",
        F.col("_Message-ID").alias("id"),
        mail.sender_of("_From_names").alias("_creator"),
        mail.mail_date(mail.last_header_value("_text_head", "Date")).alias("date"),
        F.col("_In-Reply-To").alias("replyid"),
        mail.recipients_of("_To_names").alias("to"),
        mail.recipients_of("_Cc_names").alias("cc"),
        mail.recipients_of("_Bcc_names").alias("bcc"),
    )
    error = F.when(F.col("_long"), F.lit("line too long")).when(
        F.col("_mime") & F.col("_decoded").isNull(), F.lit("undecodable body")
    )
    return bodies.select(
        *carried,
        "id",
        mail.author_of("_creator", trim_author).alias("author"),
        mail.address_of("_creator").alias("email"),
        "subject",
        "date",
        "replyid",
        F.when(F.col("_mime"), F.col("_decoded"))
        .when(F.col("_plain"), mail.part_text(mail.body_type("_text_head"), F.col("_body")))
        .otherwise(F.lit(""))
        .alias("content"),
        "to",
        "cc",
        "bcc",
        error.alias("parse_error"),
    )


def parsed(messages: DataFrame) -> DataFrame:
    """The messages that could be parsed."""
    return messages.filter(F.col("parse_error").isNull())


def rejected(messages: DataFrame) -> DataFrame:
    """The messages that could not be parsed, with their place and reason."""
    place = [c for c in PLACE if c in messages.columns]
    return messages.filter(F.col("parse_error").isNotNull()).select(*place, "id", "parse_error")


def email_table(messages: DataFrame) -> DataFrame:
    """Only the seven fields of the e-mail format."""
    return messages.select(*EMAIL_FIELDS)


def with_parse_metrics(messages: DataFrame, name: str = "parse_metrics") -> tuple[DataFrame, Observation]:
    """Count messages seen and rejected while the data passes by."""
    seen = Observation(name)
    counted = messages.observe(
        seen,
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(F.col("parse_error").isNotNull()).alias("n_rejected"),
    )
    return counted, seen
