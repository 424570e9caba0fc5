"""Search-style character folding as JVM-side column expressions.

Folding = compatibility decomposition, case folding, removal of combining
marks, native digits to ASCII digits. Spark has no ``normalize``/``unaccent``,
but the rule is per character, so the mapping is derived once on the driver
from the Unicode database and shipped as the arguments of ``translate``.

Only letters, marks and numbers are folded. Punctuation stays as it is, which
is why folding a whole text and then tokenising it gives the same tokens as
tokenising first and folding every token.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let

# Letters whose stroke is part of the letter (no decomposition exists).
STROKE_LETTERS = {
    "ø": "o",
    "đ": "d",
    "ħ": "h",
    "ł": "l",
    "ŧ": "t",
    "ƀ": "b",
    "ɨ": "i",
    "ɉ": "j",
    "ɍ": "r",
    "ɏ": "y",
}

# Code points that can fold to something else: both lower planes, variation
# selectors and the supplementary compatibility ideographs.
_SCANNED = (range(0x80, 0xD800), range(0xE000, 0x20000), range(0x2F800, 0x2FA20), range(0xE0100, 0xE01F0))
# Alphabets in everyday use live below this; full-width ASCII is added to them.
_COMMON_END = 0x2000
_FULL_WIDTH = range(0xFF10, 0xFF5B)


def fold_text(s: str) -> str:
    """The folding rule itself, for one Python string."""

    def bare(x: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c) != "Mn")

    out = bare(bare(s).casefold())
    out = "".join(
        str(unicodedata.digit(c)) if unicodedata.category(c) == "Nd" else STROKE_LETTERS.get(c, c)
        for c in out
    )
    return unicodedata.normalize("NFC", out)


@lru_cache(maxsize=1)
def _tables():
    """(common 1:1, common deletions, rare 1:1, rare deletions, expansions)."""
    common, rare, common_del, rare_del, expand = {}, {}, [], [], {}
    for block in _SCANNED:
        for cp in block:
            c = chr(cp)
            if unicodedata.category(c)[0] not in "LMN":
                continue
            folded = fold_text(c)
            if folded == c:
                continue
            is_common = cp < _COMMON_END or cp in _FULL_WIDTH
            if not folded:
                (common_del if is_common else rare_del).append(c)
            elif len(folded) == 1:
                (common if is_common else rare)[c] = folded
            elif all(unicodedata.category(x)[0] in "LN" for x in folded):
                expand[c] = folded
    return common, common_del, rare, rare_del, expand


def _guard_class(chars, gap: int = 32) -> str:
    """Regex class covering these characters: a cheap test whether a text may hold one.

    Neighbouring ranges are merged, so it can also hit other characters; a false
    hit only means a table lookup that changes nothing. The intersection makes
    every character below the first range fail after a single comparison.
    """
    runs: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if runs and cp <= runs[-1][1] + gap:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    ranges = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)
    return f"[\\x{{{runs[0][0]:x}}}-\\x{{10ffff}}&&[{ranges}]]"


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def fold(c: Column) -> Column:
    """Folded text; ASCII text takes the ``lower`` shortcut."""
    common, common_del, rare, rare_del, expand = _tables()
    # upper-case ASCII is folded here too, so mixed text needs no second pass
    ascii_up = {chr(u): chr(u + 32) for u in range(ord("A"), ord("Z") + 1)}
    frm = "".join(ascii_up) + "".join(common) + "".join(common_del)
    to = "".join(ascii_up.values()) + "".join(common.values())
    seldom = [x for x in expand if x not in "ßẞ"]
    # one string literal that the optimizer turns into a map, not a thousand literals
    lookup = F.str_to_map(F.lit(";".join(f"{x}={expand[x]}" for x in seldom)), F.lit(";"), F.lit("="))

    def expanded(t: Column) -> Column:
        chars = F.transform(
            F.split(t, ""),
            lambda ch: F.when(F.octet_length(ch) > 1, F.coalesce(F.try_element_at(lookup, ch), ch)).otherwise(ch),
        )
        return F.when(t.rlike(_guard_class(seldom, gap=0)), F.array_join(chars, "")).otherwise(t)

    def everyday(t: Column) -> Column:
        sharp_s = F.replace(F.replace(t, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss"))
        return F.translate(sharp_s, frm, to)

    def all_letters(t: Column) -> Column:
        one_to_one = F.translate(t, "".join(rare) + "".join(rare_del), "".join(rare.values()))
        needed = t.rlike(_guard_class(list(rare) + rare_del + seldom))
        return F.when(needed, let(one_to_one, expanded)).otherwise(t)

    return let(c, lambda t: F.when(is_ascii(t), F.lower(t)).otherwise(let(everyday(t), all_letters)))
