"""Chinese analysis: width folding and overlapping bigrams of ideographs."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let
from .tokens import as_col, tokenize

# full-width ASCII forms and the ideographic blank; half-width katakana
_WIDE = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {"　": " "}
_NARROW = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF65, 0xFF9E)}
# voiced sound marks follow their sign as a separate half-width character
_VOICED = ["ﾞ", "ﾟ"]

# signs before the first of these scripts fail after a comparison
_RUN = r"[\u1100-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]"
_OTHER = r"[[^\s\u1100-\x{10FFFF}][\u1100-\x{10FFFF}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]]"
# In one pass: overlapping pairs of a run, a run of one sign, and what stands between runs and blanks.
# Of a pair only its first sign is used up; the last sign of a run begins none.
_PARTS = rf"(?=({_RUN}{{2}}|(?<!{_RUN}){_RUN}|{_OTHER}++))(?:{_RUN}|{_OTHER}++)"
# parts that are terms as they are: of runs, or without a sign that separates
_WHOLE = rf"^(?:{_RUN}{{1,2}}|[a-zA-Z0-9_]+)$"


def cjk_width(c) -> Column:
    """Full-width ASCII to ASCII, half-width katakana to katakana."""
    table = _WIDE | _NARROW

    def attach_marks(t: Column) -> Column:
        for mark, combining in zip(_VOICED, ["\u3099", "\u309a"]):
            for sign, wide in _NARROW.items():
                joined = unicodedata.normalize("NFC", wide + combining)
                if len(joined) == 1:
                    t = F.replace(t, F.lit(sign + mark), F.lit(joined))
        return t

    prepared = let(as_col(c), lambda t: F.when(t.rlike("[ﾞﾟ]"), attach_marks(t)).otherwise(t))
    return F.translate(prepared, "".join(table), "".join(table.values()))


def cjk_bigrams(text) -> Column:
    """Terms of a Chinese text: bigrams of ideograph runs, other words as they are."""
    parts = F.regexp_extract_all(F.lower(cjk_width(text)), F.lit(_PARTS), F.lit(1))
    per_part = F.transform(parts, lambda p: F.when(p.rlike(_WHOLE), F.array(p)).otherwise(tokenize(p)))
    return F.flatten(per_part)
