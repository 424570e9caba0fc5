"""Analysis chains: text to an array of terms, per language."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import shipping  # noqa: F401  (helpers travel with the UDFs)
from .cjk import cjk_bigrams
from .folding import fold
from .light_stem import LIGHT_STEMMERS, stem_tokens_light
from .stem_en import stem_tokens_en
from .tokens import MIN_WORD_LEN, as_col, elision, filter_words, shingles, strip_possessive, tokenize

# Elided articles of French and Italian, and the words the English
# chain never stems.
FRENCH_ARTICLES = ["l", "m", "t", "qu", "n", "s", "j"]
ITALIAN_ARTICLES = [
    "c", "l", "all", "dall", "dell", "nell", "sull", "coll", "pell", "gl", "agl", "dagl",
    "degl", "negl", "sugl", "un", "m", "t", "s", "v", "d",
]
PROTECTED_ENGLISH = ["dontstems", "zwhacky"]

ARTICLES = {"fr": FRENCH_ARTICLES, "it": ITALIAN_ARTICLES}
LANGUAGES = ("en", "zh-cn", *LIGHT_STEMMERS)
# words shorter than this are noise; Chinese terms are one or two signs
MIN_LENGTHS = {"zh-cn": 1}


def require_language(lang: str) -> None:
    if lang not in LANGUAGES:
        raise ValueError(f"no analysis chain for language {lang!r}; known: {', '.join(LANGUAGES)}")


def min_length(lang: str, min_len: int | None = None) -> int:
    """The given minimum, or else the language's."""
    return MIN_LENGTHS.get(lang, MIN_WORD_LEN) if min_len is None else min_len


def stem_words(words, lang: str = "en", stem: bool = True, protected: Iterable[str] | None = None) -> Column:
    """The language's steps behind folding: elision or possessive, then the stemmer."""
    if lang == "en":
        keep = PROTECTED_ENGLISH if protected is None else protected
        return stem_tokens_en(words, keep) if stem else strip_possessive(words)
    if lang in ARTICLES:
        words = elision(words, ARTICLES[lang])
    return stem_tokens_light(words, lang) if stem else as_col(words)


def words_of(
    text,
    lang: str = "en",
    stem: bool = True,
    protected: Iterable[str] | None = None,
    max_token_len: int | None = None,
) -> Column:
    """Normalised words of a text in order, before the noise filter."""
    require_language(lang)
    text = as_col(text)
    if lang == "zh-cn":
        return cjk_bigrams(text)
    return stem_words(tokenize(fold(text), max_token_len), lang, stem, protected)


def analyze(
    text,
    lang: str = "en",
    shingle_size: int = 1,
    stopwords: Iterable[str] | None = None,
    min_len: int | None = None,
    stem: bool = True,
    protected: Iterable[str] | None = None,
    max_token_len: int | None = None,
) -> Column:
    """Terms of a text in order, duplicates kept: words and n-grams of up to
    ``shingle_size`` words that no dropped word interrupts.

    ``stopwords`` are compared after stemming, so they must be in stemmed form.
    ``min_len`` is the language's own unless given; words of any length are kept
    unless ``max_token_len`` is given.
    """
    words = words_of(text, lang, stem, protected, max_token_len)
    return shingles(filter_words(words, stopwords, min_length(lang, min_len)), shingle_size)
