"""Light stemmers as ordered suffix rules, run as an Arrow UDF over token arrays.

A language is a list of *steps*. A step is a list of ``(pattern, replacement)``
rules of which the first that matches is applied, or a single such pair that
replaces everywhere in the word. A dozen patterns for every word of a corpus cost
far more than its words do, so like the English stemmer this one works on the
*distinct* words of a batch. Rules expect folded (accent-free, lower-case) tokens.

Patterns state the least length of what remains, e.g. ``(.{3,})ern`` needs three
letters before the suffix. They use only syntax shared by common regex dialects;
the step for doubled letters is a function of its own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column

from .stem_en import stem_distinct

Rule = tuple[str, str | None]
Step = list[Rule] | Rule

# replacement of a rule that only stops the search
KEEP = None
# step of words longer than four letters: repeated letters become single
DOUBLED: Rule = (r"(\p{L})\1+", "$1")


def _cut(least: int, suffixes: str) -> tuple[str, str]:
    """Rule: drop one of the suffixes if at least ``least`` letters remain."""
    return (f"^(.{{{least},}})(?:{suffixes})$", "$1")


_ST = "[bdfghklmnt]"
GERMAN: list[Step] = [
    [_cut(3, "ern"), _cut(3, "e[mnrs]"), _cut(3, "e"), (f"^(.{{2,}}{_ST})s$", "$1")],
    [_cut(3, "est"), _cut(3, "e[rn]"), (f"^(.{{2,}}{_ST})st$", "$1")],
]

SPANISH: list[Step] = [
    [_cut(4, "[oae]"), ("^(.+es)es$", "$1"), ("^(.{2,})ces$", "$1z"), _cut(3, "[oae]s")],
]

ITALIAN: list[Step] = [
    [_cut(4, "[ih]e|[ih]i|ia|io"), _cut(5, "[eiao]")],
]

PORTUGUESE: list[Step] = [
    [
        ("^(.{2,}[rslz])es$", "$1"),
        ("^(.{2,})ns$", "$1m"),
        ("^(.{2,})eis$", "$1el"),
        ("^(.{2,})ais$", "$1al"),
        ("^(.{3,})is$", "$1il"),
        _cut(2, "mente"),
        _cut(3, "s"),
    ],
    [
        ("^(.{4,})(inh|iac|eir)a$", "$1$2o"),
        ("^(.{4,})(os|ic|id|ad|iv|am)a$", "$1$2o"),
        ("^(.{4,})ona$", "$1ao"),
        ("^(.{4,})(or|es)a$", "$1$2"),
        ("^(.{5,})na$", "$1no"),
    ],
    [_cut(4, "[eao]")],
]

SWEDISH: list[Step] = [
    [_cut(4, "s")],
    [
        _cut(3, "elser|heten"),
        _cut(3, "arne|erna|ande|else|aste|orna|aren"),
        _cut(3, "are|ast|het"),
        _cut(3, "ar|er|or|en|at|te|et"),
        _cut(3, "[taen]"),
    ],
]

RUSSIAN: list[Step] = [
    [
        _cut(3, "иями|оями"),
        _cut(3, "иям|иях|оях|ями|оям|оьв|ами|его|ему|ери|ими|ого|ому|ыми|оев"),
        _cut(3, "ая|яя|ях|юю|ах|ею|их|ия|ию|ие|ий|им|ое|ом|ой|ов|ые|ый|ым|ми"),
        _cut(3, "[аеиоуйыяь]"),
    ],
    [_cut(3, "[ьи]"), ("^(.{2,}н)н$", "$1")],
]

FRENCH: list[Step] = [
    [("^(.{2,}[^e])aux$", "$1al"), _cut(5, "x")],
    [_cut(3, "x")],
    [_cut(3, "s")],
    [
        ("^(.{2,})issement$", "$1ir"),
        ("^(.{3,})issant$", "$1ir"),
        ("^(.+)ivement$", "$1if"),
        ("^(.{2,})ement$", "$1e"),
        ("^(.{3,})ficat(?:rice|eur)$", "$1fier"),
        ("^(.{3,})cat(?:rice|eur)$", "$1quer"),
        ("^(.{3,})at(?:rice|eur)$", "$1er"),
        ("^(.{3,})t(?:rice|euse|eur)$", "$1ter"),
        ("^(..)trice$", "$1teur"),
        ("^(.{2,})euse$", "$1eu"),
        ("^(.{5,})ive$", "$1if"),
        ("^(.*[fm])olle$", "$1ou"),
        ("^(.{4,})nnelle$", "$1n"),
        ("^(.{6,})nnel$", "$1n"),
        _cut(5, "ique"),
        ("^(.{5,})esse$", "$1e"),
        ("^(.{3,})inage$", "$1in"),
        ("^(.{3,})ualisation$", "$1uel"),
        _cut(3, "isation"),
        _cut(4, "ation|ition"),
    ],
    DOUBLED,
    [_cut(3, "ie")],
    [_cut(3, "er"), _cut(4, "[re]")],
]

# Dutch (Snowball). After the first step capital Y and I count as consonants. R1
# and R2 are the parts behind the first and second vowel group with its consonant,
# R1 never before the fourth letter. A trailing "~" asks the next step to halve a
# double kk, dd, tt; "=" and "!" mark what was removed just before.
_V, _C = "[aeiouy]", "[^aeiouy]"
_R1 = f"(?:{_C}+{_V}+{_C}|{_V}{_V}+{_C}|{_V}{_C}.)"
_R2 = f"{_C}*{_V}+{_C}+{_V}+{_C}"


def _r1_ending(last: str) -> str:
    """A stem that reaches into R1 and ends with this kind of consonant."""
    return f"(?:{_C}+{_V}+{last}|{_V}{_V}+{last}|{_V}{_C}{last}|{_R1}.*{last})"


def _r2_not(letter: str) -> str:
    """A stem that reaches into R2 and does not end with this letter."""
    return f"(?:{_C}*{_V}+{_C}+{_V}+[^aeiouy{letter}]|{_R2}.*[^{letter}])"


_HALVE: Step = [("^(.*k)k~$", "$1"), ("^(.*d)d~$", "$1"), ("^(.*t)t~$", "$1"), ("^(.*)[~=]$", "$1")]
DUTCH: list[Step] = [
    ("^y", "Y"),
    (f"({_V})y", "$1Y"),
    (f"({_V})i({_V})", "$1I$2"),
    [
        (f"^({_R1}.*)heden$", "$1heid"),
        ("heden$", KEEP),
        ("gemene?$", KEEP),
        (f"^({_r1_ending(_C)})ene$", "$1~"),
        ("ene$", KEEP),
        (f"^({_r1_ending(_C)})en$", "$1~"),
        (f"^({_r1_ending('[^aeiouyj]')})se$", "$1"),
        ("se$", KEEP),
        (f"^({_r1_ending('[^aeiouyj]')})s$", "$1"),
    ],
    _HALVE,
    [(f"^({_R2}.*)bare$", "$1!"), (f"^({_r1_ending(_C)})e$", "$1~")],
    _HALVE,
    [(f"^({_r2_not('c')})heid$", "$1=")],
    [("gemen=$", KEEP), (f"^({_r1_ending(_C)})en=$", "$1~")],
    _HALVE,
    [
        (f"^({_r2_not('e')})ig(?:end|ing)$", "$1"),
        (f"^({_R2}.*)(?:end|ing)$", "$1~"),
        (f"^({_r2_not('e')})ig$", "$1"),
        (f"^({_R2}.*)lijk$", "$1="),
        (f"^({_R2}.*)baar$", "$1"),
    ],
    [(f"^({_r1_ending(_C)})e=$", "$1~")],
    _HALVE,
    ("!$", ""),
    [(f"^(.*{_C}){v}{v}([^aeiouyI])$", f"$1{v}$2") for v in "aeou"],
    ("I", "i"),
    ("Y", "y"),
]

LIGHT_STEMMERS: dict[str, list[Step]] = {
    "de": GERMAN,
    "es": SPANISH,
    "fr": FRENCH,
    "it": ITALIAN,
    "nl": DUTCH,
    "pt": PORTUGUESE,
    "ru": RUSSIAN,
    "sv": SWEDISH,
}


def _is_letter(c: str) -> bool:
    return unicodedata.category(c)[0] == "L"


def _single_letters(word: str) -> str:
    return re.sub(r"(\w)\1+", lambda m: m[1] if _is_letter(m[1]) else m[0], word)


def _compiled(rule: Rule) -> Rule:
    """The rule with its pattern, and its replacement as ``re`` writes it."""
    pattern, replacement = rule
    return re.compile(pattern), replacement and re.sub(r"\$(\d)", r"\\g<\1>", replacement)


def _last_signs(pattern: str) -> set[str] | None:
    """The signs that a word has to end with for the rule, ``None`` if that is not plain to see."""
    ends = re.fullmatch(r".*\(\?:([^()]*)\)\$|.*?([^()|?*+}]*)\$", pattern)
    if not ends:
        return None
    found = set()
    for ending in (ends[1] or ends[2] or "").split("|"):
        last = re.search(r"(?:\[([^\]^]+)\]|([^\W_]|[~=!]))$", ending)
        if not last:
            return None
        found.update(last[1] or last[2])
    return found


class _Step:
    """Rules of which the first that matches is applied, sorted by the last sign of a word."""

    def __init__(self, rules: list[Rule]) -> None:
        needed = [_last_signs(p) for p, _ in rules]
        compiled = [_compiled(r) for r in rules]
        self.any = [r for r, signs in zip(compiled, needed) if signs is None]
        signs = set().union(*(s for s in needed if s))
        self.by_last = {c: [r for r, s in zip(compiled, needed) if s is None or c in s] for c in signs}

    def __call__(self, word: str) -> str:
        for pattern, replacement in self.by_last.get(word[-1:], self.any):
            if pattern.search(word):
                return word if replacement is KEEP else pattern.sub(replacement, word)
        return word


class _Everywhere:
    """One rule for every place of a word."""

    def __init__(self, rule: Rule) -> None:
        self.pattern, self.replacement = _compiled(rule)

    def __call__(self, word: str) -> str:
        return self.pattern.sub(self.replacement, word)


def _function(step: Step) -> Callable[[str], str]:
    if step is DOUBLED:
        return lambda word: _single_letters(word) if len(word) > 4 else word
    return _Everywhere(step) if isinstance(step, tuple) else _Step(step)


def stem_tokens_light(tokens, lang: str) -> Column:
    """Stem every token of an array with the language's suffix rules."""
    steps = [_function(step) for step in LIGHT_STEMMERS[lang]]

    def stem(word: str) -> str:
        for step in steps:
            word = step(word)
        return word

    return stem_distinct(tokens, stem, ("light", lang))
