"""English stemming (Porter 1980) as an Arrow UDF over token arrays.

The rules need the "measure" of the remaining stem, which built-in expressions
cannot state compactly, so Python runs here. The
UDF works on the *distinct* tokens of a batch: Arrow dictionary-encodes the
flattened column in C++, only new words reach Python, and a cache of the worker
process keeps them across batches and tasks.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Hashable, Iterable, Iterator
from types import ModuleType

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix tables of the published algorithm, with the author's
# later amendments "bli" and "logi".
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _by_ending(rules: Iterable[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    """Rules grouped by the last two letters of their suffix, longest suffix first."""
    out: dict[str, list[tuple[str, str]]] = {}
    for rule in sorted(rules, key=lambda r: -len(r[0])):
        out.setdefault(rule[0][-2:], []).append(rule)
    return out


_RULES2, _RULES3 = _by_ending(STEP2), _by_ending(STEP3)
_RULES4 = _by_ending((suffix, "") for suffix in STEP4)

# A y behind a consonant is a vowel. Whether one is depends on what precedes it, so
# all are replaced by a mark at the start and removed suffixes change nothing.
_Y = "\x01"
_VOWEL, _CONSONANT = f"[aeiou{_Y}]", f"[^aeiou{_Y}]"
_HAS_VOWEL = re.compile(_VOWEL).search
_ONE_GROUP = re.compile(f"{_CONSONANT}*{_VOWEL}+{_CONSONANT}").match
_TWO_GROUPS = re.compile(f"{_CONSONANT}*{_VOWEL}+{_CONSONANT}+{_VOWEL}+{_CONSONANT}").match
_SHORT_END = re.compile(f"{_CONSONANT}{_VOWEL}[^aeiouwxy{_Y}]$").search
_DOUBLE_END = re.compile(rf"({_CONSONANT})\1$|{_Y}y$").search


def _mark_vowel_y(word: str) -> str:
    out = []
    for ch in word:
        is_vowel = ch == "y" and out and out[-1] not in "aeiou" + _Y
        out.append(_Y if is_vowel else ch)
    return "".join(out)


def _split_suffix(word: str, rules: dict[str, list[tuple[str, str]]]) -> tuple[str, str, str] | None:
    """(stem, suffix, replacement) for the longest suffix of the word in the rules."""
    for suffix, replacement in rules.get(word[-2:], ()):
        if word.endswith(suffix):
            return word[: -len(suffix)], suffix, replacement
    return None


def porter_stem(word: str) -> str:
    if len(word) < 3:
        return word
    w = _mark_vowel_y(word) if "y" in word else word
    # plurals
    if w[-1] == "s":
        if w.endswith(("sses", "ies")):
            w = w[:-2]
        elif w[-2] != "s":
            w = w[:-1]
    # -eed, -ed, -ing
    if w.endswith("eed"):
        if _ONE_GROUP(w[:-3]):
            w = w[:-1]
    elif w.endswith(("ed", "ing")):
        stem = w[:-2] if w[-1] == "d" else w[:-3]
        if _HAS_VOWEL(stem):
            w = stem
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif _DOUBLE_END(w) and w[-1] not in "lsz":
                w = w[:-1]
            elif _SHORT_END(w) and _ONE_GROUP(w) and not _TWO_GROUPS(w):
                w += "e"
    if w[-1:] in ("y", _Y) and _HAS_VOWEL(w[:-1]):
        w = w[:-1] + "i"
    # derivational suffixes, longest match only
    for rules in (_RULES2, _RULES3):
        found = _split_suffix(w, rules)
        if found and _ONE_GROUP(found[0]):
            w = found[0] + found[2]
    found = _split_suffix(w, _RULES4)
    if found and _TWO_GROUPS(found[0]) and (found[1] != "ion" or found[0][-1] in "st"):
        w = found[0]
    # final e and double l
    if w[-1:] == "e":
        stem = w[:-1]
        if _TWO_GROUPS(stem) or (_ONE_GROUP(stem) and not _SHORT_END(stem)):
            w = stem
    if w.endswith("ll") and _TWO_GROUPS(w[:-1]):
        w = w[:-1]
    return w.replace(_Y, "y")


def _normal_form(word: str, protected: frozenset[str]) -> str:
    if word[-2:] in ("'s", "'S", "’s", "’S", "＇s", "＇S"):
        word = word[:-2]
    return word if word in protected else porter_stem(word)


_CACHE_LIMIT = 500_000


_KEPT = "_termloom_stems"


def known_stems(rules: Hashable) -> dict[str, str]:
    """What this process has stemmed by the same rules; words of the rules used before are let go.

    A worker process runs many tasks, each of which unpickles this code anew; so the words
    hang on a module of their own.
    """
    store = sys.modules.setdefault(_KEPT, ModuleType(_KEPT)).__dict__
    if store.get("rules") != rules:
        store["rules"], store["stems"] = rules, {}
    return store["stems"]


def stem_distinct(tokens, stem_word: Callable[[str], str], rules: Hashable) -> Column:
    """``stem_word`` of every token of an array, called for words that the worker has not seen yet.

    ``rules`` names what ``stem_word`` does: equal rules share their words.
    """

    @F.arrow_udf("array<string>")
    def stem(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = known_stems(rules)
        for arr in batches:
            encoded = arr.flatten().dictionary_encode()
            stems = []
            for word in encoded.dictionary.to_pylist():
                known = cache.get(word)
                if known is None:
                    known = stem_word(word)
                    if len(cache) < _CACHE_LIMIT:
                        cache[word] = known
                stems.append(known)
            values = pa.array(stems, pa.string()).take(encoded.indices)
            lengths = pc.fill_null(pc.list_value_length(arr), 0)
            ends = pc.cumulative_sum(lengths.cast(pa.int32()))
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
            yield pa.ListArray.from_arrays(offsets, values, mask=arr.is_null() if arr.null_count else None)

    return stem(F.col(tokens) if isinstance(tokens, str) else tokens)


def stem_tokens_en(tokens, protected: Iterable[str] = ()) -> Column:
    """Possessive removal, protected-word check and Porter stem of every token."""
    keep = frozenset(protected)
    return stem_distinct(tokens, lambda word: _normal_form(word, keep), ("en", *sorted(keep)))
