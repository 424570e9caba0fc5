"""SQL fragments for the text functions, written for the comparison engine."""

from __future__ import annotations

from collections.abc import Iterable

# one letter with its marks and joined letters, or one digit likewise, or a connector
WORD = (
    r"(?:\p{L}\p{M}*(?:['’.:·]\p{L}\p{M}*)*|\p{N}\p{M}*(?:[.,;'’]\p{N}\p{M}*)*|[_\p{M}])+"
)


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tokens(text: str) -> str:
    apart = f"regexp_replace({text}, '([\\p{{Han}}\\p{{Hiragana}}])', ' \\1 ', 'g')"
    return f"regexp_extract_all({apart}, {quote(WORD)})"


def fold(text: str) -> str:
    return f"replace(strip_accents(lower({text})), 'ß', 'ss')"


def each(items: str, body: str) -> str:
    """Map a list; ``body`` speaks of ``x``."""
    return f"list_transform({items}, lambda x: {body})"


def folded_tokens(text: str) -> str:
    return f"list_filter({each(tokens(text), fold('x'))}, lambda x: x <> '')"


def base(word: str) -> str:
    return f"regexp_replace({word}, '[''’＇][sS]$', '')"


def is_noise(word: str, stopwords: Iterable[str] = ()) -> str:
    listed = "".join(f" or {word} = {quote(w)}" for w in stopwords)
    return f"(length({word}) < 3 or regexp_full_match({word}, '[\\p{{Nd}},.]+'){listed})"


def words(text: str, stopwords: Iterable[str] = ()) -> str:
    """Unstemmed words with nulls for noise."""
    return each(each(folded_tokens(text), base("x")), f"case when not {is_noise('x', stopwords)} then x end")


def ngrams(w: str, size: int) -> str:
    """Concatenated lists of 1..size-grams of column ``w``; a null word gives null."""
    lists = [w]
    for k in range(2, size + 1):
        gram = " || ' ' || ".join(f"{w}[i - {k - 1 - j}]" for j in range(k))
        lists.append(f"list_transform(range({k}, len({w}) + 1), lambda i: {gram})")
    return lists[0] if size == 1 else " || ".join(lists)


def ln1p(x: str) -> str:
    """ln(1 + x) without loss of digits for small x."""
    return f"case when abs({x}) < 0.5 then 2 * atanh(({x}) / (2 + ({x}))) else ln(1 + ({x})) end"


def _cell(k: str, deviation: str, row: str, col: str) -> str:
    x = f"{deviation} / (cast({row} as double) * cast({col} as double))"
    return f"case when {k} > 0 then cast({k} as double) * {ln1p(x)} else 0.0 end"


def g2(d: str) -> str:
    """Score from k11, the totals r, c and n, and ``d``, which is k11 * n - r * c."""
    cells = [
        _cell("(k11)", d, "r", "c"),
        _cell("(r - k11)", f"-{d}", "r", "(n - c)"),
        _cell("(c - k11)", f"-{d}", "(n - r)", "c"),
        _cell("(n - r - c + k11)", d, "(n - r)", "(n - c)"),
    ]
    return f"2.0 * ({' + '.join(cells)})"


G2 = g2("(k11 * n - r * c)")


def scores(terms: str, universe: str = "") -> str:
    """email, term, k11, score (and r, c, n) from a query of (email, term) occurrences."""
    part = f", {universe}" if universe else ""
    over = f"partition by {universe}" if universe else ""
    return f"""
      with counts as (select email, term, count(*) as k from ({terms}) group by email, term),
      totals as (
        select email, term, k, cast(k as double) as k11,
               cast(sum(k) over (partition by term) as double) as r,
               cast(sum(k) over (partition by email{part}) as double) as c,
               cast(sum(k) over ({over}) as double) as n
        from counts)
      select email, term, k, r, c, n, {G2} as score, k11 from totals"""


def top(terms: str, n: int = 20, universe: str = "") -> str:
    return f"""
      select email, term, score from (
        select email, term, score,
               row_number() over (partition by email order by score desc, term) as place
        from ({scores(terms, universe)}) where score >= 1.0) where place <= {n}"""
