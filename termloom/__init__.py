"""Weighted text features of message corpora, as Spark jobs."""

from .functions.analysis import LANGUAGES, analyze
from .plans.mine_stopwords import mine_stopwords, mine_stopwords_of
from .plans.parse_archives import parse_archives
from .plans.top_terms import top_terms, top_terms_of

__all__ = [
    "LANGUAGES",
    "analyze",
    "mine_stopwords",
    "mine_stopwords_of",
    "parse_archives",
    "top_terms",
    "top_terms_of",
]
