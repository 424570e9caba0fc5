"""Word-level text functions: tokens, term filters, shingles.

Everything here is a Column -> Column composition of built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .folding import is_ascii
from .let import let

MIN_WORD_LEN = 3

# A mark that joins two letters (it's, gmail.com) or two digits (1,324; 1.456)
# belongs to the word; anywhere else it separates. Words are found by replacing
# separators, not by matching words: that needs no repetition of groups, so
# "1,1,1,..." lines of any length cannot exhaust the regex stack. Letters fail the
# first class, all other conditions are only tried on the few marks between words.
_JOINED = (
    r"['’.](?=\p{L})(?<=[\p{L}\p{M}].)"
    r"|['’.,;](?=\p{N})(?<=\p{N}.)"
    r"|[:·](?=\p{L})(?<=[\p{L}\p{M}].)"
)
_SEPARATOR = rf"[^\p{{L}}\p{{M}}\p{{N}}_](?<!{_JOINED})[^\p{{L}}\p{{M}}\p{{N}}_'’.:·,;]*"
# Scripts written without blanks: every ideograph / hiragana sign is a word.
# A class of scripts looks every sign up in a table. The intersections, here and below, let all signs
# before its first one fail after a comparison; they leave none out.
_SINGLE_SIGN = r"([\u2E80-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}]])"


# The word rules of Unicode text segmentation, for texts with signs that the separators above do
# not tell apart. The signs of the rules' classes, beyond the scripts' own.
_EXTEND = r"[\u00AD\u0300-\x{10FFFF}&&[\p{M}\p{Cf}\uFF9E\uFF9F\x{1F3FB}-\x{1F3FF}]&&[^\u200B]]"
_MID_LETTER = r":\u00B7\u0387\u055F\u05F4\u2027\uFE13\uFE55\uFF1A"
_MID_NUMBER = r",;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B"
_MID_BOTH = r"'.\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
_KATAKANA = r"\p{IsKatakana}\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70&&[^\uFF9E\uFF9F]"
_NO_BLANKS = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_CONNECTOR = r"\p{Pc}\u202F"
_SINGLE = r"\p{IsHan}\p{IsHiragana}"
_HEBREW = r"[\u0591-\uFB4F&&[\p{IsHebrew}&&\p{L}]]"
# the letters of everyday Latin texts come first
_LETTER = (
    rf"[a-zA-Z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F[\p{{IsAlphabetic}}"
    rf"&&[^\p{{M}}\p{{N}}{_SINGLE}{_NO_BLANKS}]&&[^{_KATAKANA.split('&&')[0]}]]]"
)
_NUMBER = r"[\p{N}\u066B]"


def _word_rules() -> str:
    """One word, as a pattern without repetitions that recurse or go back."""
    e = f"{_EXTEND}*+"
    # a letter and what joins it to the next one; quotes inside and after Hebrew words
    hebrew = rf"""{_HEBREW}{e}(?:"{e}(?={_HEBREW})|[{_MID_LETTER}{_MID_BOTH}]{e}(?={_LETTER}))?+"""
    letter = rf"{_LETTER}{e}(?:[{_MID_LETTER}{_MID_BOTH}]{e}(?={_LETTER}))?+"
    number = rf"{_NUMBER}{e}(?:[{_MID_NUMBER}{_MID_BOTH}]{e}(?={_NUMBER}))?+"
    run = rf"(?:(?:{hebrew}|{letter}|{number})++(?:(?<={_HEBREW})'{e})?+|(?:[{_KATAKANA}]{e})++)"
    connected = rf"(?:[{_CONNECTOR}]{e})"
    word = rf"{connected}*+{run}(?:{connected}++{run})*+{connected}*+|{connected}++"
    return rf"{word}|[{_SINGLE}]{e}|(?:[{_NO_BLANKS}]{e})++"


_WORD_RULES = _word_rules()
# signs whose class the separators do not know
_RULED_SIGNS = (
    rf"[\u00AD\u037E-\x{{10FFFF}}"
    rf"&&[{_KATAKANA.split('&&')[0]}{_NO_BLANKS}\p{{IsHebrew}}\p{{Cf}}\uFF9E\x{{1F3FB}}-\x{{1F3FF}}\u202F"
    rf"\p{{Pc}}{_MID_LETTER}{_MID_NUMBER}{_MID_BOTH}\u066B]&&[^_'’.:·,;]]"
)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# every character up to the blank counts as white space at the ends of a field
_BLANKS = "".join(chr(c) for c in range(1, 33))


def strip_blanks(c) -> Column:
    return F.trim(as_col(c), F.lit(_BLANKS))


def split_words(text) -> Column:
    """Raw split of a text; may hold empty strings (use when rows are filtered later).

    Words are told by the rules of Unicode text segmentation. Most texts only hold signs for
    which a separator pattern does the same; the others are matched word by word. Ideographs
    and hiragana are words of their own; runs of scripts without blanks are one word. Any number
    sign counts as a digit, and connectors alone are a word. Emoji and flags are none.
    """

    def spaced(t: Column) -> Column:
        apart = F.regexp_replace(t, _SINGLE_SIGN, " $1 ")
        return F.when(is_ascii(t) | ~t.rlike(_SINGLE_SIGN), t).otherwise(apart)

    def words(t: Column) -> Column:
        # the split at a single blank needs no regular expression
        simple = F.split(F.regexp_replace(spaced(t), _SEPARATOR, " "), " ")
        ruled = ~is_ascii(t) & t.rlike(_RULED_SIGNS)
        return F.when(ruled, F.regexp_extract_all(t, F.lit(_WORD_RULES), F.lit(0))).otherwise(simple)

    return let(as_col(text), words)


def tokenize(text, max_token_len: int | None = None) -> Column:
    """Words of a text in order; with ``max_token_len``, longer ones are left out."""
    if max_token_len is None:
        return F.filter(split_words(text), lambda t: t != "")
    return F.filter(split_words(text), lambda t: F.length(t).between(1, max_token_len))


def possessive_base(token) -> Column:
    """One token without a trailing 's."""
    token = as_col(token)
    # most words end otherwise, which is seen without making strings
    ends = F.endswith(token, F.lit("s")) | F.endswith(token, F.lit("S"))
    owned = ends & F.lower(F.substr(token, F.lit(-2))).isin("'s", "’s", "＇s")
    return F.when(owned, F.substr(token, F.lit(1), F.length(token) - 2)).otherwise(token)


def strip_possessive(tokens) -> Column:
    return F.transform(as_col(tokens), possessive_base)


def is_noise_word(token, stopwords: Iterable[str] | None = None, min_len: int = MIN_WORD_LEN) -> Column:
    """True for words too short, made only of digits and ``,`` ``.``, or listed."""
    token = as_col(token)
    # all signs of the pattern come before the letters of ASCII, or after ASCII
    may_be = (token < ":") | (token >= "\u0080")
    noise = (F.length(token) < min_len) | (may_be & token.rlike(r"^[\p{Nd},.]+$"))
    words = sorted(set(stopwords or ()))
    return noise | token.isin(words) if words else noise


def filter_words(tokens, stopwords: Iterable[str] | None = None, min_len: int = MIN_WORD_LEN) -> Column:
    """Null out noise words but keep their place, so shingles cannot bridge the gap."""
    return F.transform(as_col(tokens), lambda t: F.when(~is_noise_word(t, stopwords, min_len), t))


def ngrams_by_end(words: Column, size: int) -> list[Column]:
    """One array per n-gram length; entry i is the n-gram ending at word i or null.

    ``concat`` with a null operand is null, which is exactly the "a dropped word
    breaks the n-gram" rule.
    """
    grams = [words]
    for _ in range(size - 1):
        shifted = F.concat(F.array(F.lit(None).cast("string")), grams[-1])
        grams.append(F.zip_with(shifted, words, lambda head, w: F.concat(head, F.lit(" "), w)))
    return grams


def ngrams_at(words, at, size: int) -> list[Column]:
    """The n-grams of 1..size words that end at one place (from 0), each null if a word is missing."""
    words, at = as_col(words), as_col(at)
    # an index before the first word gives null
    before = [F.get(words, at - back) for back in range(size)]
    return [F.concat(*[x for w in before[k::-1] for x in (F.lit(" "), w)][1:]) for k in range(size)]


def shingles(words, size: int) -> Column:
    """N-grams of 1..size words, by end position and short first, nulls removed."""
    if size < 1:
        raise ValueError("shingle size must be at least 1")
    if size == 1:
        return F.array_compact(as_col(words))

    def in_order(w: Column) -> Column:
        # longer terms are only looked for where a word was kept
        per_word = F.transform(w, lambda x, i: F.when(x.isNotNull(), F.array(*ngrams_at(w, i, size))))
        return F.array_compact(F.flatten(F.array_compact(per_word)))

    return let(as_col(words), in_order)


def num_words(term) -> Column:
    """Number of words in a term."""
    return F.size(F.split(as_col(term), " "))


def elision(tokens, articles: Iterable[str]) -> Column:
    """Remove a leading elided article (l', dell', ...) from every token, any case."""
    pattern = f"^(?i:{'|'.join(sorted(set(articles)))})['’]"

    def bare(t: Column) -> Column:
        # most words hold no mark: a search for it is cheaper than the pattern
        marked = F.contains(t, F.lit("'")) | F.contains(t, F.lit("’"))
        return F.when(marked, F.regexp_replace(t, pattern, "")).otherwise(t)

    return F.transform(as_col(tokens), bare)
