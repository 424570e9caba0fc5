"""Light stemmers as SQL over distinct words, from their published descriptions.

Rules are stated by suffix, least length of the word, letters to cut and letters to add, and
tested with ``ends_with``, ``length`` and ``left``; nothing is taken from the code under test.
"""

from __future__ import annotations

from . import sql


def ends(suffix: str, w: str = "w") -> str:
    return f"ends_with({w}, '{suffix}')"


def case(*rules: str) -> str:
    return f"case {' '.join(rules)} else w end"


def rule(least: int, suffixes: str, cut: int | None = None, add: str = "", also: str = "") -> str:
    """Words of at least ``least`` letters that end so: cut (the suffix, unless told) and add."""
    out = []
    for s in suffixes.split():
        n = len(s) if cut is None else cut
        out.append(f"when length(w) >= {least} and {ends(s)}{also and f' and {also}'} then left(w, length(w) - {n}) || '{add}'")
    return " ".join(out)


def letter(back: int, letters: str) -> str:
    """The letter so many places from the end is one of these."""
    return f"instr('{letters}', substr(w, length(w) - {back}, 1)) > 0"


_ST = "bdfghklmnt"
DE = [
    case(rule(6, "ern"), rule(5, "em en er es"), rule(4, "e"), rule(4, "s", also=letter(1, _ST))),
    case(rule(6, "est"), rule(5, "er en"), rule(5, "st", also=letter(2, _ST))),
]
ES = [
    case(
        rule(5, "o a e"),
        rule(5, "eses", cut=2),
        rule(5, "ces", add="z"),
        rule(5, "os as es"),
    )
]
IT = [case(rule(6, "ie he ii hi ia io"), rule(6, "e i a o"))]
PT = [
    case(
        rule(5, "res ses les zes", cut=2),
        rule(4, "ns", add="m"),
        rule(5, "eis", add="el"),
        rule(5, "ais", add="al"),
        rule(5, "is", add="il"),
        rule(7, "mente"),
        rule(4, "s"),
    ),
    case(
        rule(8, "inha iaca eira", cut=1, add="o"),
        rule(7, "osa ica ida ada iva ama", cut=1, add="o"),
        rule(7, "ona", add="ao"),
        rule(7, "ora esa", cut=1),
        rule(7, "na", cut=1, add="o"),
    ),
    case(rule(5, "e a o")),
]
SV = [
    case(rule(5, "s")),
    case(
        rule(8, "elser heten"),
        rule(7, "arne erna ande else aste orna aren"),
        rule(6, "are ast het"),
        rule(5, "ar er or en at te et"),
        rule(4, "t a e n"),
    ),
]
RU = [
    case(
        rule(7, "иями оями"),
        rule(6, "иям иях оях ями оям оьв ами его ему ери ими ого ому ыми оев"),
        rule(5, "ая яя ях юю ах ею их ия ию ие ий им ое ом ой ов ые ый ым ми"),
        rule(4, "а е и о у й ы я ь"),
    ),
    case(rule(4, "ь и"), rule(4, "нн", cut=1)),
]


def _single_letters(w: str) -> str:
    for c in "abcdefghijklmnopqrstuvwxyz":
        w = f"regexp_replace({w}, '{c}{c}+', '{c}', 'g')"
    return f"case when length(w) > 4 then {w} else w end"


FR = [
    case(rule(6, "aux", add="al", also="substr(w, length(w) - 3, 1) <> 'e'"), rule(6, "x")),
    case(rule(4, "x")),
    case(rule(4, "s")),
    case(
        rule(10, "issement", add="ir"),
        rule(9, "issant", add="ir"),
        rule(8, "ivement", add="if"),
        rule(7, "ement", add="e"),
        rule(12, "ficatrice", add="fier"),
        rule(11, "ficateur", add="fier"),
        rule(10, "catrice", add="quer"),
        rule(9, "cateur", add="quer"),
        rule(9, "atrice", add="er"),
        rule(8, "ateur", add="er"),
        rule(8, "trice teuse", add="ter"),
        rule(7, "teur", add="ter"),
        rule(7, "trice", add="teur", also="length(w) = 7"),
        rule(6, "euse", add="eu"),
        rule(8, "ive", add="if"),
        rule(5, "folle molle", cut=4, add="ou"),
        rule(10, "nnelle nnel", add="n"),
        rule(9, "ique"),
        rule(9, "esse", add="e"),
        rule(8, "inage", add="in"),
        rule(13, "ualisation", add="uel"),
        rule(10, "isation"),
        rule(9, "ation ition"),
    ),
    _single_letters("w"),
    case(rule(5, "ie")),
    case(rule(5, "er"), rule(5, "r e")),
]
STEPS = {"de": DE, "es": ES, "fr": FR, "it": IT, "pt": PT, "ru": RU, "sv": SV}

# --- Dutch: regions are numbers of letters, counted once for the word ---------------------

_VOWELS = "aeiouy"


def _is_vowel(back: int, w: str = "w") -> str:
    return f"(length({w}) > {back} and instr('{_VOWELS}', substr({w}, length({w}) - {back}, 1)) > 0)"


def _in(region: str, n: int) -> str:
    return f"length(w) - {n} >= {region}"


def _less(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _undouble(w: str) -> str:
    return f"case when right({w}, 2) in ('kk', 'dd', 'tt') then left({w}, length({w}) - 1) else {w} end"


def _en(n: int) -> str:
    """An ending of n letters goes as "en" does: in R1, behind a consonant, not behind "gem"."""
    behind = f"not {_is_vowel(0, _less(n))} and not ends_with({_less(n)}, 'gem')"
    return f"{_in('p1', n)} and {behind} and length(w) > {n}"


def _s(n: int) -> str:
    return f"{_in('p1', n)} and length(w) > {n} and not {_is_vowel(0, _less(n))} and right({_less(n)}, 1) <> 'j'"


def _step_e() -> str:
    """(word, whether an e was removed)"""
    gone = f"{ends('e')} and {_in('p1', 1)} and length(w) > 1 and not {_is_vowel(0, _less(1))}"
    return f"case when {gone} then {_undouble(_less(1))} else w end", gone


def _dutch(words: str) -> str:
    """Query of (word, w) for the column ``word`` of a query of distinct words."""
    marked = "word"
    marked = f"regexp_replace({marked}, '^y', 'Y')"
    marked = f"regexp_replace({marked}, '([{_VOWELS}])y', '\\1Y', 'g')"
    marked = f"regexp_replace({marked}, '([{_VOWELS}])i([{_VOWELS}])', '\\1I\\2', 'g')"
    group = f"[^{_VOWELS}]*[{_VOWELS}]+[^{_VOWELS}]"
    e_step, e_gone = _step_e()
    step1 = f"""case
        when {ends('heden')} then case when {_in('p1', 5)} then {_less(5)} || 'heid' else w end
        when {ends('ene')} then case when {_en(3)} then {_undouble(_less(3))} else w end
        when {ends('en')} then case when {_en(2)} then {_undouble(_less(2))} else w end
        when {ends('se')} then case when {_s(2)} then {_less(2)} else w end
        when {ends('s')} then case when {_s(1)} then {_less(1)} else w end
        else w end"""
    heid = f"{ends('heid')} and {_in('p2', 4)} and substr(w, length(w) - 4, 1) <> 'c'"
    en_too = f"case when {ends('en')} and {_en(2)} then {_undouble(_less(2))} else w end"
    def ig(w: str) -> str:
        return f"{ends('ig', w)} and length({w}) - 2 >= p2 and substr({w}, length({w}) - 2, 1) <> 'e'"

    vowels = " ".join(
        f"when length(w) > 3 and substr(w, length(w) - 2, 2) = '{v}{v}' and not {_is_vowel(3)}"
        f" and not {_is_vowel(0)} and right(w, 1) <> 'I' then left(w, length(w) - 2) || right(w, 1)"
        for v in "aeou"
    )
    return f"""
      select word, replace(replace(case {vowels} else w end, 'I', 'i'), 'Y', 'y') as w from (
      select word, case when again then {e_step} else w end as w, p1, p2 from (
      select word, p1, p2, {ends('lijk')} and {_in('p2', 4)} as again, case
          when ({ends('end')} or {ends('ing')}) then case when {_in('p2', 3)} then cut3 else w end
          when {ends('ig')} then case when {ig('w')} then {_less(2)} else w end
          when {ends('lijk')} then case when {_in('p2', 4)} then {_less(4)} else w end
          when {ends('baar')} then case when {_in('p2', 4)} then {_less(4)} else w end
          when {ends('bar')} then case when {_in('p2', 3)} and e_found then {_less(3)} else w end
          else w end as w from (
      select *, case when {ig('z')} then left(z, length(z) - 2) else {_undouble('z')} end as cut3 from (
      select *, {_less(3)} as z from (
      select word, p1, p2, e_found, case when had_heid then {en_too} else w end as w from (
      select word, p1, p2, e_found, {heid} as had_heid, case when {heid} then {_less(4)} else w end as w from (
      select word, p1, p2, {e_gone} as e_found, {e_step} as w from (
      select word, p1, p2, {step1} as w from (
      select word, w, greatest(raw1, 3) as p1, raw2 as p2 from (
      select word, w, case when raw1 = 0 then length(w) else raw1 end as raw1,
             case when raw2 = 0 then length(w) else raw2 end as raw2 from (
      select word, {marked} as w, length(regexp_extract({marked}, '^{group}')) as raw1,
             length(regexp_extract({marked}, '^{group}{group}')) as raw2 from ({words}))))))))))))"""


def stemmed_counts(items: str, lang: str) -> str:
    """(term, n) of the list of words per document that ``items`` makes of ``documents``."""
    words = f"select word, count(*) as n from (select unnest({items}) as word from documents) group by word"
    if lang == "nl":
        stems = _dutch("select word from counted")
    else:
        stems = "select word, word as w from counted"
        for step in STEPS[lang]:
            stems = f"select word, {step} as w from ({stems})"
    return f"""
      with counted as ({words})
      select w as term, cast(sum(n) as bigint) as n from counted join ({stems}) using (word)
      where not {sql.is_noise('w')} group by w"""


# fixed values: the elided articles
ARTICLES = {
    "fr": "l m t qu n s j",
    "it": "c l all dall dell nell sull coll pell gl agl dagl degl negl sugl un m t s v d",
}


def unelided(word: str, lang: str) -> str:
    """A word without the article before its first apostrophe."""
    at = f"instr(replace({word}, '’', ''''), '''')"
    listed = ", ".join(f"'{a}'" for a in ARTICLES[lang].split())
    return f"case when lower(left({word}, {at} - 1)) in ({listed}) then substr({word}, {at} + 1) else {word} end"
