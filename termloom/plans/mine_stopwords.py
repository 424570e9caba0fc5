"""Job: the terms most users share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.frequency import bad_words, document_frequency, top_df, unique_count
from ..operators.terms import user_terms
from ..sources.emails_tsv import read_emails_tsv
from ..sources.wordlists import TERMS_BY_DF_DIR, write_terms
from ..staging import job_folder, stage

# Fixed values of the job: the size of the list without a threshold.
TOP_TERMS = 2000


def term_frequencies(docs: DataFrame, lang: str = "en", stem: bool = True, float32: bool = False) -> DataFrame:
    """df of every term of (email, content) rows, reading the texts once.

    Every document also emits a row without term. Counted like any other, that row
    gives the number of users, those without terms included, so the total needs no
    second pass over the texts.
    """
    terms = user_terms(docs, lang=lang, stem=stem, once=True, mark_docs=True)
    counts = stage(unique_count(terms), "doc-counts")
    total = counts.filter(F.col("term").isNull()).select(F.col("doc_count").alias("total_docs"))
    return document_frequency(counts.filter(F.col("term").isNotNull()), total, float32)


def mine_stopwords_of(
    docs: DataFrame, max_df: float | None = None, limit: int | None = None, **options
) -> DataFrame:
    """(term, df) of the commonest terms: the top ``limit``, 2000 unless given, or all above ``max_df``."""
    df = term_frequencies(docs, **options)
    if max_df is None:
        listed = top_df(df, TOP_TERMS if limit is None else limit)
    else:
        listed = bad_words(df, max_df, limit)
    return listed.select("term", "df")


def mine_stopwords(
    spark: SparkSession,
    input_path: str,
    working_dir: str,
    max_df: float | None = None,
    mode: str = "strict",
    fmt: str = "parquet",
    drop_blank: bool = False,
    partitions: int | None = None,
    **options,
) -> str:
    """E-mail files to ``<working_dir>/terms-by-df``; returns that path.

    ``partitions`` deals the input over that many tasks first.
    """
    docs = read_emails_tsv(spark, input_path, mode, drop_blank=drop_blank, partitions=partitions)
    with job_folder(spark, "mine-stopwords"):
        return write_terms(mine_stopwords_of(docs, max_df, **options), working_dir, TERMS_BY_DF_DIR, fmt)
