"""SQL for the results of the operators that SQL can express."""

from __future__ import annotations

from .licenses import TEMPLATES, THRESHOLD
from .quality import (
    AGAINST_GOOD,
    AGAINST_OTHER,
    AGAINST_OWN,
    CLASSES,
    LEAST,
    MOST,
    MOST_GOOD,
    PRIOR_DOCUMENTS,
    PRIOR_GOOD,
    ROUNDS,
    RULES,
    WAYS,
)

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- licences -------------------------------------------------------------------------------


def _grams(text: str) -> str:
    w = rf"string_split(trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    return (
        f"list_transform([{w}], lambda w: case when len(w) > 1 then"
        " list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) else w end)[1]"
    )


_KNOWN = ", ".join(f"({_quote(name)}, {_quote(t)})" for name, texts in TEMPLATES.items() for t in texts)
LICENSES = f"""
  with known as (select name, {_grams('t')} as grams from (values {_KNOWN}) k(name, t)),
  lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as l,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as line from documents),
  cut as (select doc_id, line, regexp_matches(l, '[\\p{{L}}\\p{{N}}]') as has, {_grams('l')} as grams from lines),
  scored as (select doc_id, line, name,
                    2.0 * len(list_intersect(c.grams, k.grams)) / (len(c.grams) + len(k.grams)) as dice
             from cut c join known k on len(list_intersect(c.grams, k.grams)) > 0),
  best as (select doc_id, count(distinct line) as n_hits, min(struct_pack(l := -dice, n := name, i := line)) as b
           from scored where dice >= {THRESHOLD} group by doc_id)
  select doc_id, n_lines, coalesce(n_hits, 0) as n_hits, b.n as license, round(-b.l, 6) as dice, b.i as line
  from (select doc_id, count(*) filter (has) as n_lines from cut group by doc_id) left join best using (doc_id)"""

# --- near-duplicates: all pairs that share a shingle -------------------------------------------

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR_DUPLICATES = rf"""
  with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
  sets as (select doc_id, case when len(w) >= 3
             then list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])))
             when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
  classes as (select s, min(doc_id) as rep from sets where len(s) > 0 group by s),
  posted as (select rep, len(s) as n, unnest(s) as sh from classes),
  pairs as (select a.rep as x, b.rep as y, a.n as nx, b.n as ny, count(*) as common
            from posted a join posted b on a.sh = b.sh and a.rep < b.rep group by all),
  links as (select x, y from pairs where 100 * common >= 85 * (nx + ny - common)),
  either as (select x, y from links union all select y, x from links),
  reach as (select rep as x, rep as y from classes union select r.x, e.y from reach r join either e on e.x = r.y),
  found as (select x as rep, min(y) as component from reach group by x)
  select doc_id, len(sets.s) as n_shingles, coalesce(component, doc_id) as component_id,
         coalesce(component, doc_id) = doc_id as kept
  from sets left join classes on sets.s = classes.s left join found using (rep)"""

# --- shards -------------------------------------------------------------------------------------

_CRC_TABLE = (
    "select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)),"
    " lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c from range(256) r(i))"
)
_BYTES = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint)"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


def _winner(shards: int) -> str:
    u = f"(('0x' || left(md5(cast(doc_id as varchar) || ':' || cast(s as varchar)), 13))::bigint + 0.5) / {2.0**52!r}"
    return f"cast(list_sort(list_transform(range({shards}), lambda s: {{'u': -ln({u}), 's': s}}))[1].s as integer)"


SHARDS = f"""
  with tab as materialized ({_CRC_TABLE}),
  dealt as (select doc_id, coalesce(strlen(text), 0) + 8 as size, {_CRC} as text_crc32, {_winner(24)} as shard,
                   {_winner(25)} as grown_shard from documents, tab)
  select *, 'key' as law, row_number() over (partition by shard order by doc_id, text_crc32, size) - 1 as slot from dealt"""

# --- exact top-k -----------------------------------------------------------------------------------

TOP_PRODUCTS = """
  with v as (select vec_id, list_transform(embedding, lambda x: floor(cast(x as double) * 64)) as v from embeddings
             where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  scored as (select q.vec_id as query_id, x.vec_id, cast(list_inner_product(q.v, x.v) as bigint) as score
             from v q join v x on q.vec_id <> x.vec_id where q.vec_id % 20 = 0),
  ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
             from scored)
  select query_id, rank, vec_id, score from ranked where rank <= 20"""

# --- quality ---------------------------------------------------------------------------------------------

_COUNTS = rf"""
  texts as (select doc_id, coalesce(text, '') as text, {_WORDS} as w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
  windows as (select doc_id, unnest(range(len(w) - 7)) as i,
                     unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) as win
              from texts where len(w) >= 8),
  often as (select doc_id, i from (select *, count(*) over (partition by doc_id, win) as n from windows) where n > 1),
  covered as (select doc_id, sum(least(8, i - before)) as n from (
                select *, lag(i, 1, -8) over (partition by doc_id order by i) as before from often) group by doc_id),
  q as (select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
               len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(cast(c.n as bigint), 0) as n_repeat_words,
               len(list_distinct(w)) as n_distinct,
               len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as stutter,
               length(regexp_replace(text, '\P{{Lu}}', '', 'g')) as upper,
               length(regexp_replace(text, '[\p{{L}}\p{{N}}\x09-\x0D\x20]', '', 'g')) as signs,
               length(text) - length(replace(text, '!', '')) as shouts, len(lines) as n_lines,
               len(list_filter(lines, lambda x: regexp_matches(x, '[.!?:"»”…][\x09-\x0D\x20]*$'))) as ended
        from texts left join covered c using (doc_id))"""


def _vote(value: str, good: str, bad: str, has: str) -> str:
    return f"case when {has} and {value} {bad} then -1 when {has} and {good.replace('x', value)} then 1 else 0 end"


_HAS = {"words": "n_words > 0", "lines": "n_lines >= 3", "long": "n_words >= 50"}
_VOTES = {
    "marks": ("(n_symbols / n_words)", "x <= 0.02", "> 0.1", "words"),
    "signs": ("(signs / word_chars)", "x <= 0.1", "> 0.15", "words"),
    "capitals": ("(upper / word_chars)", "x <= 0.15", "> 0.4", "words"),
    "shouts": ("(shouts / n_words)", "x <= 0.1", "> 0.3", "words"),
    "windows": ("(n_repeat_words / n_words)", "x <= 0.1", "> 0.25", "words"),
    "lines": ("(n_dup_lines / n_lines)", "x <= 0.3", "> 0.5", "lines"),
    "variety": ("(n_distinct / n_words)", "x >= 0.4", "< 0.2", "long"),
    "stutter": ("(stutter / n_words)", "x <= 0.05", "> 0.3", "words"),
    "length": ("(word_chars / n_words)", "x >= 3.5 and x <= 8", "not between 2 and 15", "words"),
    "ends": ("(ended / n_lines)", "x >= 0.7", "< 0.1", "lines"),
}
_PATTERN = "[" + ", ".join(_vote(v, good, bad, _HAS[has]) for v, good, bad, has in (_VOTES[r] for r in RULES)) + "]"


def _believed(c: str) -> list[float]:
    own = WAYS.get(c, [])
    return [AGAINST_GOOD if c == "good" else AGAINST_OWN if r in own else AGAINST_OTHER for r in RULES]


_PRIOR = [PRIOR_GOOD if c == "good" else (1 - PRIOR_GOOD) / len(WAYS) for c in CLASSES]
_AGAINST = [_believed(c) for c in CLASSES]
_C, _R = f"range(1, {len(CLASSES) + 1})", f"range(1, {len(RULES) + 1})"
_LOGS = (
    f"list_transform({_C}, lambda c: ln(prior[c]) + list_sum(list_transform({_R}, lambda j:"
    " case r.v[j] when -1 then ln(against[c][j]) when 1 then ln(1 - against[c][j]) else 0.0 end)))"
)
_SHARES = "list_transform(r.l, lambda x: exp(x - list_max(r.l)))"
_PARTS = "list_transform(r.e, lambda x: x / list_sum(r.e))"


def _cast(v: int) -> str:
    return f"list_sum(list_transform(rows, lambda r: case when r.v[j] = {v} then r.p[c] * r.n else 0.0 end))"


_D = PRIOR_DOCUMENTS
QUALITY = f"""
  with recursive {_COUNTS},
  voted as (select *, cast({_PATTERN} as tinyint[]) as v from q),
  patterns as (select v, cast(count(*) as double) as n from voted group by v),
  listed as materialized (select list({{'v': v, 'n': n}} order by v) as rows, sum(n) as total from patterns),
  em as (
    select 0 as k, cast({_PRIOR} as double[]) as prior, cast({_AGAINST} as double[][]) as against
    union all
    select k + 1,
      list_transform({_C}, lambda c: (list_sum(list_transform(rows, lambda r: r.p[c] * r.n))
                                      + cast({_PRIOR} as double[])[c] * {_D}) / (total + {_D})),
      list_transform({_C}, lambda c: list_transform({_R}, lambda j: greatest({LEAST}, least(
        case when c = 1 then {MOST_GOOD} else {MOST} end,
        ({_cast(-1)} + cast({_AGAINST} as double[][])[c][j] * {_D}) / ({_cast(-1)} + {_cast(1)} + {_D})))))
    from (select k, total, list_transform(rows, lambda r: {{'v': r.v, 'n': r.n, 'p': {_PARTS}}}) as rows from (
          select k, total, list_transform(rows, lambda r: {{'v': r.v, 'n': r.n, 'e': {_SHARES}}}) as rows from (
          select k, total, list_transform(rows, lambda r: {{'v': r.v, 'n': r.n, 'l': {_LOGS}}}) as rows
          from em, listed where k < {ROUNDS})))),
  judged as (select r.v as v, {_PARTS.replace('r.e', f"({_SHARES.replace('r.l', f'({_LOGS})')})")}[1] as posterior
             from (select unnest(rows) as r, prior, against from listed, em where k = {ROUNDS})),
  done as (select voted.*, posterior, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
           from voted join judged using (v))
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         not base_failed and posterior >= 0.5 as kept, round(posterior, 6) as posterior from done"""

REPEATS = """
  with docs as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
  sized as (select doc_id, x, length(x) // 2 as n from docs),
  windows as (
    select doc_id, place, substr(x, 2 * place + 1, 100) as w
    from (select doc_id, x, unnest(range(0, n - 49)) as place from sized)),
  firsts as (select w, min(doc_id) as least from windows group by w),
  starts as (select doc_id, place from windows join firsts using (w) where doc_id > least),
  marked as (
    select doc_id, place, place > coalesce(lag(place) over (partition by doc_id order by place), -99) + 50 as opens from starts),
  numbered as (select doc_id, place, sum(cast(opens as int)) over (partition by doc_id order by place) as span from marked),
  spans as (select doc_id, min(place) as lo, max(place) + 50 as hi from numbered group by doc_id, span),
  gaps as (
    select doc_id, lo, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as begun, hi from spans),
  kept as (
    select doc_id, string_agg(substr(x, 2 * begun + 1, 2 * (lo - begun)), '' order by lo) as head, max(hi) as last,
           count(*) as n_spans, cast(sum(hi - lo) as bigint) as n_removed
    from gaps join sized using (doc_id) group by doc_id)
  select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
         sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) as kept_sha256
  from sized left join kept using (doc_id)"""

DIVERGENCE = r"""
  with docs as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents),
  words as (
    select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
  kept as (select lang, term, count(*) as lang_n from words group by all having count(distinct d) >= 3),
  sizes as (select lang, count(*) as v, sum(lang_n) as lang_total from kept group by lang),
  own as (select lang, source, term, count(*) as n from words group by all),
  groups as (select distinct lang, source from docs),
  cells as (
    select g.lang, g.source, k.term, coalesce(o.n, 0) as n, k.lang_n, s.v, s.lang_total,
           sum(coalesce(o.n, 0)) over (partition by g.lang, g.source) as total
    from groups g join kept k using (lang) join sizes s using (lang) left join own o using (lang, source, term)),
  priced as (
    select lang, source, term, n,
           cast(1 + (1000000000 * cast(n + 1 as hugeint)) // (total + v) as bigint) as p,
           cast(1 + (1000000000 * cast(lang_n + 1 as hugeint)) // (lang_total + v) as bigint) as q
    from cells),
  pairs as (
    select a.lang, a.source, b.source as item, sum(cast((a.p - b.p) * (a.p - b.p) // b.p as hugeint)) as value
    from priced a join priced b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
  ranked as (
    select g.lang, g.source, 'pair' as part, h.source as item, cast(coalesce(value, 0) as bigint) as value
    from groups g join groups h on g.lang = h.lang and g.source <> h.source
    left join pairs p on p.lang = g.lang and p.source = g.source and p.item = h.source
    union all
    select lang, source, 'term', term, (p - q) * (p - q) // q from priced where n > 0 and p > q)
  select lang, source, part, item, value, cast(place as integer) as rank
  from (select *, row_number() over (partition by lang, source, part order by value desc, item) as place from ranked)
  where part = 'pair' or place <= 200"""

ORACLES = {
    "op3_licenses": LICENSES,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op6_shards": SHARDS,
    "op8_top_products": TOP_PRODUCTS,
    "op10_quality": QUALITY,
    "op12_repeats": REPEATS,
    "op13_divergence": DIVERGENCE,
}
