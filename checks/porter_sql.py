"""The English stemmer as SQL over the distinct words, for comparison.

Written from the published description with regular expressions on the consonant
and vowel pattern, independently of the Python rules it is compared with.
"""

from __future__ import annotations

from collections.abc import Iterable

from . import sql

# fixed values: the suffixes of the second to fourth step, with what replaces them
STEP2 = (
    "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize"
    " ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble logi>log"
)
STEP3 = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"

V, C = "[aeiouY]", "[^aeiouY]"


def marked(w: str) -> str:
    """The word with every y that is a vowel in upper case."""
    out = f"regexp_replace({w}, '([^aeiouy])y', '\\1Y', 'g')"
    for _ in range(2):
        out = f"regexp_replace({out}, '(^y|[aeiouY]y)y', '\\1Y', 'g')"
    return out


def matches(w: str, pattern: str) -> str:
    return f"regexp_matches({marked(w)}, '{pattern}')"


def m_over_0(w: str) -> str:
    return matches(w, f"^{C}*{V}+{C}")


def m_over_1(w: str) -> str:
    return matches(w, f"^{C}*{V}+{C}+{V}+{C}")


def has_vowel(w: str) -> str:
    return matches(w, V)


def short_end(w: str) -> str:
    return matches(w, f"{C}{V}[^aeiouYwxy]$")


def head(n: int, w: str = "w") -> str:
    return f"left({w}, length({w}) - {n})"


def ends(suffix: str, w: str = "w") -> str:
    return f"ends_with({w}, '{suffix}')"


def _table(table: str) -> str:
    rules = [tuple(r.split(">")) for r in table.split()]
    cases = " ".join(
        f"when {ends(s)} then case when {m_over_0(head(len(s)))} then {head(len(s))} || '{r}' else w end"
        for s, r in sorted(rules, key=lambda rule: -len(rule[0]))
    )
    return f"case {cases} else w end"


def _step4() -> str:
    cases = []
    for s in sorted(STEP4.split(), key=len, reverse=True):
        stem = head(len(s))
        extra = f" and (ends_with({stem}, 's') or ends_with({stem}, 't'))" if s == "ion" else ""
        cases.append(f"when {ends(s)} then case when {m_over_1(stem)}{extra} then {stem} else w end")
    return f"case {' '.join(cases)} else w end"


STEPS = [
    f"case when {ends('sses')} or {ends('ies')} then {head(2)}"
    f" when {ends('s')} and not {ends('ss')} then {head(1)} else w end",
    # a removed ending is marked with a blank for the next step
    f"case when {ends('eed')} then case when {m_over_0(head(3))} then {head(1)} else w end"
    f" when {ends('ed')} and {has_vowel(head(2))} then {head(2)} || ' '"
    f" when {ends('ing')} and {has_vowel(head(3))} then {head(3)} || ' ' else w end",
    "case when not ends_with(w, ' ') then w"
    " when ends_with(w, 'at ') or ends_with(w, 'bl ') or ends_with(w, 'iz ') then rtrim(w) || 'e'"
    f" when length(rtrim(w)) > 1 and right(rtrim(w), 1) = substr(rtrim(w), length(rtrim(w)) - 1, 1)"
    f" and {matches('rtrim(w)', C + '$')} and right(rtrim(w), 1) not in ('l', 's', 'z') then {head(1, 'rtrim(w)')}"
    f" when {m_over_0('rtrim(w)')} and not {m_over_1('rtrim(w)')} and {short_end('rtrim(w)')}"
    " and not (length(rtrim(w)) > 1 and right(rtrim(w), 1) = substr(rtrim(w), length(rtrim(w)) - 1, 1)"
    f" and {matches('rtrim(w)', C + '$')} and right(rtrim(w), 1) not in ('l', 's', 'z')) then rtrim(w) || 'e'"
    " else rtrim(w) end",
    f"case when {ends('y')} and {has_vowel(head(1))} then {head(1)} || 'i' else w end",
    _table(STEP2),
    _table(STEP3),
    _step4(),
    f"case when {ends('e')} and ({m_over_1(head(1))} or ({m_over_0(head(1))} and not {short_end(head(1))}))"
    f" then {head(1)} else w end",
    f"case when {ends('ll')} and {m_over_1(head(1))} then {head(1)} else w end",
]


def _stems(source: str, protected: Iterable[str]) -> str:
    """CTEs ending in ``stems(word, w)`` for the column ``word`` of ``source``."""
    keep = ", ".join(sql.quote(p) for p in protected) or "''"
    out = [
        f"s0 as (select word, word as w from (select distinct word from {source})"
        f" where length(word) >= 3 and word not in ({keep}))"
    ]
    for i, step in enumerate(STEPS):
        out.append(f"s{i + 1} as (select word, {step} as w from s{i})")
    out.append(
        f"stems as (select word, w from s{len(STEPS)} union all"
        f" select distinct word, word from {source} where word in ({keep}))"
    )
    return ", ".join(out)


def stemmed_counts(source: str, text: str, protected: Iterable[str] = ()) -> str:
    words = sql.each(sql.folded_tokens(text), sql.base("x"))
    return f"""
      with words as (select unnest({words}) as word from ({source})),
      counted as (select word, count(*) as n from words group by word),
      {_stems('counted', protected)}
      select w as term, cast(sum(n) as bigint) as n from counted join stems using (word)
      where not {sql.is_noise('w')} group by w"""


def stemmed_terms(source: str) -> str:
    """(email, term) occurrences of (email, content) rows."""
    words = sql.each(sql.folded_tokens("content"), sql.base("x"))
    return f"""
      with words as (select email, unnest({words}) as word from ({source})),
      {_stems('words', ())}
      select email, w as term from words join stems using (word) where not {sql.is_noise('w')}"""
