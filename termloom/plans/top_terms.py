"""Job: the terms that set each user apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import strip_quote_header, strip_quoted_text
from ..operators.counting import counted_terms
from ..operators.llr import MAX_TERMS, MIN_SCORE, term_counts, top_terms_by_llr
from ..operators.rank import sort_terms
from ..operators.terms import drop_stopwords, user_terms
from ..sources.emails_tsv import read_emails_tsv
from ..sources.wordlists import TERMS_DIR, read_stopwords, write_terms
from ..staging import job_folder, stage


def top_terms_of(
    docs: DataFrame,
    max_terms: int = MAX_TERMS,
    shingle_size: int = 1,
    stopwords: Iterable[str] | DataFrame | None = None,
    min_score: float = MIN_SCORE,
    predicate: Column | None = None,
    drop_quotes: bool = False,
    lang: str = "en",
    stem: bool = True,
    analyzer: Callable[[Column], Column] | None = None,
    max_token_len: int | None = None,
    **llr_options,
) -> DataFrame:
    """Top terms of (email, content) rows, sorted: email, term, score.

    Stop words are a list, which becomes part of the analysis, or a table of any size,
    which is joined with the counts. Both leave the same terms.
    """
    listed = None
    if isinstance(stopwords, DataFrame):
        listed, stopwords = stopwords, None
    content = strip_quoted_text("content") if drop_quotes else F.col("content")
    cleaned = docs.select("email", strip_quote_header(content).alias("content"))
    # terms of several words are mostly rare, and are counted in columns
    in_columns = shingle_size > 1 and analyzer is None and not llr_options.get("buckets")
    terms = user_terms(
        cleaned,
        lang=lang,
        shingle_size=shingle_size,
        stopwords=stopwords,
        stem=stem,
        analyzer=analyzer,
        max_token_len=max_token_len,
        in_pieces=in_columns,
    )
    if in_columns:
        cuts = {option: llr_options[option] for option in ("share", "piece_rows") if option in llr_options}
        counts = counted_terms(terms, shingle_size, **cuts)
    else:
        counts = term_counts(terms)
    if listed is not None:
        counts = drop_stopwords(stage(counts, "all-counts"), listed)
    return sort_terms(top_terms_by_llr(counts, max_terms, min_score, predicate, **llr_options))


def top_terms(
    spark: SparkSession,
    input_path: str,
    working_dir: str,
    stopwords: str | None = None,
    max_terms: int = MAX_TERMS,
    shingle_size: int = 1,
    mode: str = "strict",
    fmt: str = "parquet",
    drop_blank: bool = False,
    partitions: int | None = None,
    **options,
) -> str:
    """E-mail files to ``<working_dir>/terms``; returns that path.

    ``stopwords`` names a file of stemmed words, one per line. ``partitions`` deals the
    input over that many tasks first; see :func:`spread`.
    """
    docs = read_emails_tsv(spark, input_path, mode, drop_blank=drop_blank, partitions=partitions)
    words = None if stopwords is None else read_stopwords(spark, stopwords)
    with job_folder(spark, "top-terms"):
        result = top_terms_of(docs, max_terms, shingle_size, words, **options)
        return write_terms(result, working_dir, TERMS_DIR, fmt)
