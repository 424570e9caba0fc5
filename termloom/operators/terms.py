"""From texts to one row per term."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import min_length, require_language, stem_words
from ..functions.cjk import cjk_bigrams
from ..functions.folding import fold
from ..functions.let import let
from ..functions.tokens import (
    filter_words,
    is_noise_word,
    ngrams_at,
    ngrams_by_end,
    possessive_base,
    tokenize,
)

# words handled as one row: bounds the memory of a batch whatever the length of a text
PIECE_WORDS = 1000


def explode_terms(df: DataFrame, terms: Column, keep: list[str]) -> DataFrame:
    """One row per entry of ``terms``, other columns carried; nulls are left out."""
    return df.select(*keep, F.explode(terms).alias("term")).filter(F.col("term").isNotNull())


def _pieces(words: Column, overlap: int, mark: bool) -> Column:
    """The words of a text in pieces: array of (words, context, mark).

    A piece starts with the last ``overlap`` words of the piece before it, counted
    by ``context``, so that terms across the border can be formed. With ``mark``
    there is one more piece that holds a single null.
    """

    def cut(w: Column) -> Column:
        def piece(start: Column) -> Column:
            context = F.when(start > 0, F.lit(overlap)).otherwise(F.lit(0))
            return F.struct(
                F.slice(w, start - context + 1, context + PIECE_WORDS).alias("words"),
                context.alias("context"),
                F.lit(False).alias("mark"),
            )

        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(PIECE_WORDS))
        return F.transform(starts, piece)

    pieces = let(F.coalesce(words, F.array().cast("array<string>")), cut)
    if not mark:
        return pieces
    null_word = F.array(F.lit(None).cast("string")).alias("words")
    return F.concat(pieces, F.array(F.struct(null_word, F.lit(0).alias("context"), F.lit(True).alias("mark"))))


def user_terms(
    docs: DataFrame,
    content: str = "content",
    keep: list[str] | None = None,
    lang: str = "en",
    shingle_size: int = 1,
    stopwords: Iterable[str] | None = None,
    min_len: int | None = None,
    stem: bool = True,
    once: bool = False,
    mark_docs: bool = False,
    analyzer: Callable[[Column], Column] | None = None,
    max_token_len: int | None = None,
    in_pieces: bool = False,
) -> DataFrame:
    """One row per term occurrence of every document: ``keep`` columns and ``term``.

    Single words are exploded first and filtered as rows, in generated code. Only
    longer terms need arrays with the gaps left in. Long texts are cut into pieces
    of words that overlap as far as the longest term needs.

    ``once=True`` drops repetitions within a document early, for callers that only
    ask which users have a term. ``mark_docs=True`` adds one row with a null term
    per document, so that a count of documents or users can be taken in the same
    pass. ``analyzer`` replaces the whole chain except ``stopwords``: its terms are
    left out if one of their words is listed. Words of any length are kept unless
    ``max_token_len`` is given.

    ``in_pieces=True`` returns what longer terms are made of instead, for callers that count
    them: ``words`` of a piece with nulls for those left out, and ``context``, the number of words at
    its start with which no term of this piece ends.
    """
    require_language(lang)
    if in_pieces and (shingle_size == 1 or once or mark_docs or analyzer is not None):
        raise ValueError("pieces are only made for terms of several words, all of their occurrences, and no own analyzer")
    min_len = min_length(lang, min_len)
    keep = ["email"] if keep is None else keep
    text = F.col(content)
    if analyzer is not None:
        words, shingle_size = analyzer(text), 1
    elif lang == "zh-cn":
        words = cjk_bigrams(text)
    else:
        words = tokenize(fold(text), max_token_len)
    has_stems = analyzer is None and lang != "zh-cn"
    # possessives of unstemmed single words are cheaper to remove row by row
    bare_rows = has_stems and lang == "en" and not stem and shingle_size == 1
    if once and shingle_size == 1:
        words = F.array_distinct(words)
    pieces = docs.select(*keep, F.inline(_pieces(words, shingle_size - 1, mark_docs)))
    normal = stem_words(F.col("words"), lang, stem) if has_stems and not bare_rows else F.col("words")

    wanted = F.col("term").isNotNull()
    if shingle_size == 1:
        rows = pieces.select(*keep, "mark", F.explode(normal).alias("term"))
        if bare_rows:
            rows = rows.withColumn("term", possessive_base("term"))
        if analyzer is None:
            wanted = wanted & ~is_noise_word("term", stopwords, min_len)
        elif listed := sorted(set(stopwords or ())):
            wanted = wanted & ~F.exists(F.split("term", " "), lambda w: w.isin(listed))
    else:
        # a projection of its own, so that the stemmer runs once however often it is used
        stemmed = pieces.select(*keep, "mark", "context", normal.alias("words"))
        filtered = stemmed.withColumn("words", filter_words("words", stopwords, min_len))
        if in_pieces:
            return filtered.select(*keep, "context", "words")
        if once:
            grams = let(
                F.col("words"),
                lambda w: F.concat(
                    *[F.slice(g, F.col("context") + 1, F.size(w)) for g in ngrams_by_end(w, shingle_size)]
                ),
            )
            terms = F.when(F.col("mark"), F.col("words")).otherwise(F.array_distinct(grams))
            rows = filtered.select(*keep, "mark", F.explode(terms).alias("term"))
        else:
            # one row per word, then one per term that ends with it, in generated code: no array of
            # all terms is made, and a dropped word has none. With the plain explode Spark would ask for
            # texts with words first, and filter the words twice for it
            places = filtered.select(*keep, "mark", "context", "words", F.posexplode_outer("words").alias("at", "word"))
            ends = places.filter(F.col("mark") | (F.col("word").isNotNull() & (F.col("at") >= F.col("context"))))
            terms = F.when(F.col("mark"), F.array("word")).otherwise(F.array(*ngrams_at("words", "at", shingle_size)))
            rows = ends.select(*keep, "mark", F.explode(terms).alias("term"))
    return rows.filter(wanted | F.col("mark") if mark_docs else wanted).drop("mark")


def drop_stopwords(terms: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Rows whose term holds no word of a stop-word table of any size.

    A dropped word takes along exactly the n-grams that contain it, so n-grams made
    without the list lack nothing but these. Meant for counts: there a common term has few
    rows to move. ``terms`` is read twice and should be a stored table.
    """
    words = terms.select("term").distinct().select("term", F.explode(F.split("term", " ")).alias("_word"))
    listed = stopwords.select(F.col("term").alias("_word"))
    holding = words.join(listed, "_word", "left_semi").select("term").distinct()
    return terms.join(holding, "term", "left_anti").select(*terms.columns)
