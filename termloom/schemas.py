"""Explicit schemas of the tables the jobs exchange (never inferred)."""

from pyspark.sql import types as T

EMAIL_FIELDS = ["id", "author", "email", "subject", "date", "replyid", "content"]

RAW_MESSAGES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

EMAILS = T.StructType(
    [
        T.StructField(f, T.TimestampType() if f == "date" else T.StringType())
        for f in EMAIL_FIELDS
    ]
)

USER_DOCS = T.StructType(
    [T.StructField("email", T.StringType()), T.StructField("content", T.StringType())]
)

TERMS = T.StructType(
    [T.StructField("email", T.StringType()), T.StructField("term", T.StringType())]
)

TOP_TERMS = T.StructType(
    [
        T.StructField("email", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)

TERM_DF = T.StructType(
    [T.StructField("term", T.StringType()), T.StructField("df", T.DoubleType())]
)
