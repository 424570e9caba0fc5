"""Every checked query: a Spark function of (spark, sf_dir) and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import analysis, clean, mail
from termloom.functions.cjk import cjk_bigrams, cjk_width
from termloom.functions.folding import fold
from termloom.functions.html import html_paragraph_text
from termloom.functions.stem_en import stem_tokens_en
from termloom.functions.tokens import (
    elision,
    filter_words,
    num_words,
    shingles,
    strip_possessive,
    tokenize,
)
from termloom.functions.parsers import register_parsers
from termloom.operators import frequency, increments, llr, oversize, parse, rank, sketches
from termloom.operators.terms import drop_stopwords, user_terms
from termloom.plans.mine_stopwords import mine_stopwords, mine_stopwords_of, term_frequencies
from termloom.plans.parse_archives import parse_archives
from termloom.plans.top_terms import top_terms as run_top_terms
from termloom.plans.top_terms import top_terms_of
from termloom.sources import emails_tsv, mbox, wordlists
from termloom.staging import new_path, stage
from termloom.streaming.mbox import stream_mbox, streamed
from termloom.streaming.oversize import stream_kept_sizes

from . import fixtures as fx
from . import porter_sql, sql, stems_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# --- shared inputs -------------------------------------------------------------

NL = fx.NL
UNESCAPED = f"replace(replace(%s, '\\n', {NL}), '\\t', {fx.TAB})"
ESCAPED = f"replace(replace(%s, {NL}, '\\n'), {fx.TAB}, '\\t')"
USER = "lower(trim(email))"
# fixed value: the quote header of the original job
QUOTE_HEADER = "regexp_replace(content, '(?m)^>* On ..., .+, .+wrote:', '', 'g')"
STOPWORDS = ["der", "die", "und", "the", "and", "que", "les"]


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.documents(spark, sf_dir)


def user_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(email, content) as the jobs get them."""
    return fx.emails(spark, sf_dir).select(clean.normalize_email("email").alias("email"), "content")


USER_DOCS = f"select {USER} as email, content from ({fx.emails_sql()})"
CLEAN_DOCS = f"select {USER} as email, {QUOTE_HEADER} as content from ({fx.emails_sql()})"


def plain_terms(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return user_terms(user_docs(spark, sf_dir), stem=False, **options)


def sql_terms(source: str, size: int = 1, stopwords=()) -> str:
    """(email, term) occurrences, unstemmed."""
    return f"""
      select email, term from (
        select email, unnest({sql.ngrams('w', size)}) as term
        from (select email, {sql.words('content', stopwords)} as w from ({source})))
      where term is not null"""


# --- lines and cleaning ----------------------------------------------------------

@query("normalize_email", f"select doc_id, {USER} as email from ({fx.emails_sql()})")
def normalize_email(spark, sf_dir):
    return fx.emails(spark, sf_dir).select("doc_id", clean.normalize_email("email").alias("email"))


@query(
    "escape_roundtrip",
    f"select doc_id, {ESCAPED % 'content'} as escaped, content as restored from ({fx.emails_sql()})",
)
def escape_roundtrip(spark, sf_dir):
    escaped = fx.emails(spark, sf_dir).select("doc_id", clean.escape_content("content").alias("escaped"))
    return escaped.withColumn("restored", clean.unescape_content("escaped"))


# fixed values: the fields of the line format, in its order
FIELDS = ["id", "author", "email", "subject", "date", "replyid", "content"]
# e-mails of a single line lack their first field
ONE_LINE = f"instr(content, {NL}) = 0"
LINE_SQL = (
    f"select doc_id, case when {ONE_LINE} then '' else id || {fx.TAB} end || "
    + f" || {fx.TAB} || ".join(ESCAPED % f for f in FIELDS[1:])
    + f" as value from ({fx.emails_sql()})"
)


def email_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    emails = fx.emails(spark, sf_dir)
    whole = emails_tsv.email_line(emails)
    cut = F.regexp_replace(whole, r"^[^\t]*\t", "")
    return emails.select("doc_id", F.when(F.expr(ONE_LINE), cut).otherwise(whole).alias("value"))


@query("email_line", LINE_SQL)
def email_line(spark, sf_dir):
    return email_lines(spark, sf_dir)


@query("parse_email_line", f"select {USER} as email, content from ({fx.emails_sql()}) where not {ONE_LINE}")
def parse_email_line(spark, sf_dir):
    return emails_tsv.parse_email_lines(email_lines(spark, sf_dir), "value", mode="permissive")


@query(
    "rejected_lines",
    f"select value, 6 as n_fields from ({LINE_SQL}) join ({fx.emails_sql()}) using (doc_id) where {ONE_LINE}",
)
def rejected_lines(spark, sf_dir):
    return emails_tsv.rejected_lines(email_lines(spark, sf_dir), "value")


@query("emails_tsv_roundtrip", USER_DOCS)
def emails_tsv_roundtrip(spark, sf_dir):
    path = new_path(spark, "emails-tsv")
    emails_tsv.write_emails_tsv(fx.emails(spark, sf_dir), path)
    return emails_tsv.read_emails_tsv(spark, path)


@query(
    "strip_quoted_text",
    f"select doc_id, regexp_replace(content, '(?m)^>+ .*', '', 'g') as content from ({fx.emails_sql()})",
)
def strip_quoted_text(spark, sf_dir):
    return fx.emails(spark, sf_dir).select("doc_id", clean.strip_quoted_text("content").alias("content"))


@query("strip_quote_header", f"select doc_id, {QUOTE_HEADER} as content from ({fx.emails_sql()})")
def strip_quote_header(spark, sf_dir):
    return fx.emails(spark, sf_dir).select("doc_id", clean.strip_quote_header("content").alias("content"))


# --- words -------------------------------------------------------------------------

@query(
    "tokenize",
    f"""select doc_id, len(w) as n_tokens, array_to_string(w, ' ') as tokens
        from (select doc_id, {sql.tokens('text')} as w from documents)""",
)
def tokenize_texts(spark, sf_dir):
    words = docs(spark, sf_dir).select("doc_id", tokenize("text").alias("w"))
    return words.select(
        "doc_id", F.size("w").cast("bigint").alias("n_tokens"), F.array_join("w", " ").alias("tokens")
    )


@query(
    "fold",
    f"""select doc_id, array_to_string(w, ' ') as tokens
        from (select doc_id, {sql.folded_tokens('text')} as w from documents)""",
)
def fold_texts(spark, sf_dir):
    return docs(spark, sf_dir).select(
        "doc_id", F.array_join(tokenize(fold(F.col("text"))), " ").alias("tokens")
    )


# all but line ends and quotes become letters: words as long as a line
LONG_WORDS = "replace(replace(replace(text, '. ', 'y'), ', ', 'z'), ' ', 'x')"


# every text followed by words of many scripts, which the word rules part
SCRIPTS = (
    "צה\"ל ג'ירפה テレビabc カタ_b 日本ひ ﾊﾞﾅﾅ ภาษาไทย ພາສາ 한국어 हिन्दी العربية a\u2018b \u2018a 1\u066c2 3\uff1a4"
    " c\u00add e\u200bf x\U0001f1e9\U0001f1eay \U0001f44d a\u203fb 1\u202f000"
)
SCRIPT_WORDS = [
    'צה"ל', "ג'ירפה", "テレビ", "abc", "カタ_b", "日", "本", "ひ", "ﾊﾞﾅﾅ", "ภาษาไทย", "ພາສາ", "한국어", "हिन्दी", "العربية",
    "a\u2018b", "a", "1\u066c2", "3", "4", "c\u00add", "e", "f", "x", "y", "a\u203fb", "1\u202f000",
]


@query(
    "tokenize_scripts",
    f"select doc_id, array_to_string({sql.tokens('text')} || [{', '.join(map(sql.quote, SCRIPT_WORDS))}], '|') as tokens"
    " from documents",
)
def tokenize_scripts(spark, sf_dir):
    text = F.concat("text", F.lit(" " + SCRIPTS))
    return docs(spark, sf_dir).select("doc_id", F.array_join(tokenize(text), "|").alias("tokens"))


@query(
    "tokenize_long_words",
    f"""select doc_id, len(w) as n_tokens, list_max({sql.each('w', 'length(x)')}) as longest
        from (select doc_id, {sql.tokens(LONG_WORDS)} as w from documents)""",
)
def tokenize_long_words(spark, sf_dir):
    words = docs(spark, sf_dir).select("doc_id", tokenize(F.expr(LONG_WORDS)).alias("w"))
    longest = F.array_max(F.transform("w", lambda x: F.length(x))).cast("bigint")
    return words.select("doc_id", F.size("w").cast("bigint").alias("n_tokens"), longest.alias("longest"))


@query(
    "strip_possessive",
    f"""select doc_id, array_to_string({sql.each(sql.tokens("replace(text, 'e ', 'e''s ')"), sql.base('x'))}, ' ')
        as tokens from documents""",
)
def strip_possessive_texts(spark, sf_dir):
    # the texts have no possessives: words ending in e get one
    owned = F.replace(F.col("text"), F.lit("e "), F.lit("e's "))
    return docs(spark, sf_dir).select("doc_id", F.array_join(strip_possessive(tokenize(owned)), " ").alias("tokens"))


@query(
    "filter_words",
    f"""select doc_id, array_to_string({sql.each('w', "coalesce(x, '-')")}, ' ') as words
        from (select doc_id, {sql.words('text', STOPWORDS)} as w from documents)""",
)
def filter_words_texts(spark, sf_dir):
    words = analysis.words_of("text", stem=False)
    return docs(spark, sf_dir).select("doc_id", F.array_join(filter_words(words, STOPWORDS), " ", "-").alias("words"))


def _shingle_query(size: int) -> None:
    grams = sql.ngrams("w", size)

    @query(
        f"shingles_{size}",
        f"""select term, count(*) as n from (
              select unnest({grams}) as term
              from (select {sql.words('text', STOPWORDS)} as w from documents)) where term is not null
            group by term""",
    )
    def shingles_of(spark, sf_dir):
        words = filter_words(analysis.words_of("text", stem=False), STOPWORDS)
        terms = docs(spark, sf_dir).select(F.explode(shingles(words, size)).alias("term"))
        return frequency.count_by(terms, "term")


for _size in (2, 3):
    _shingle_query(_size)


@query(
    "num_words",
    f"""select num_words, count(*) as n_terms from (
          select len(string_split(term, ' ')) as num_words
          from ({sql_terms(USER_DOCS, 3)}) group by term) group by num_words""",
)
def num_words_of_terms(spark, sf_dir):
    terms = plain_terms(spark, sf_dir, shingle_size=3).select("term").distinct()
    return (
        terms.select(num_words("term").cast("bigint").alias("num_words"))
        .groupBy("num_words")
        .agg(F.count(F.lit(1)).alias("n_terms"))
    )


# articles are injected before words that start with a vowel letter
ELIDED_TEXT = "regexp_replace(text, '(^| )([aeiou])', '%s', 'g')"


@query(
    "elision_fr",
    f"""select doc_id, array_to_string({sql.each(sql.tokens(ELIDED_TEXT % "\\1Qu''\\2"),
        stems_sql.unelided('x', 'fr'))}, ' ') as tokens from documents""",
)
def elision_fr(spark, sf_dir):
    text = F.regexp_replace("text", "(^| )([aeiou])", "$1Qu'$2")
    words = elision(tokenize(text), analysis.FRENCH_ARTICLES)
    return docs(spark, sf_dir).select("doc_id", F.array_join(words, " ").alias("tokens"))


@query(
    "elision_it",
    f"""select doc_id, array_to_string({sql.each(sql.tokens(ELIDED_TEXT % "\\1dell’\\2"),
        stems_sql.unelided('x', 'it'))}, ' ') as tokens from documents""",
)
def elision_it(spark, sf_dir):
    text = F.regexp_replace("text", "(^| )([aeiou])", "$1dell’$2")
    words = elision(tokenize(text), analysis.ITALIAN_ARTICLES)
    return docs(spark, sf_dir).select("doc_id", F.array_join(words, " ").alias("tokens"))


# Latin letters become ideographs, so that the Chinese chain has runs to work on
HAN = ("abcdefghijklm", "天地玄黄宇宙洪荒日月盈昃辰")
WIDE = ("nopqrstuvwxyz", "ｎｏｐｑｒｓｔｕｖｗｘｙｚ")
HAN_TEXT = f"translate(lower(text), '{HAN[0]}', '{HAN[1]}')"


@query(
    "cjk_width",
    "select doc_id, replace(replace(replace(lower(text), 'a', 'ガ'), 'e', 'パ'), 'o', 'ア') as text from documents",
)
def cjk_width_texts(spark, sf_dir):
    # half-width katakana, with voiced marks of their own, and full-width letters
    narrow = F.lower("text")
    for letter, signs in (("a", "ｶﾞ"), ("e", "ﾊﾟ"), ("o", "ｱ")):
        narrow = F.replace(narrow, F.lit(letter), F.lit(signs))
    wide = F.translate(narrow, "npqrstuvwxyz", "ｎｐｑｒｓｔｕｖｗｘｙｚ")
    return docs(spark, sf_dir).select("doc_id", cjk_width(wide).alias("text"))


@query(
    "cjk_bigrams",
    f"""select term, count(*) as n from (
          select unnest(case when length(run) < 2 then [run] else
                 list_transform(range(1, length(run)), lambda i: run[i:i+1]) end) as term
          from (select unnest(regexp_extract_all({HAN_TEXT}, '\\p{{Han}}+')) as run from documents)
          union all
          select unnest({sql.tokens(f"regexp_replace({HAN_TEXT}, '\\p{{Han}}+', ' ', 'g')")}) from documents)
        group by term""",
)
def cjk_bigrams_texts(spark, sf_dir):
    text = F.translate(F.translate(F.lower("text"), *HAN), *WIDE)
    terms = docs(spark, sf_dir).select(F.explode(cjk_bigrams(text)).alias("term"))
    return frequency.count_by(terms, "term")


def sql_zh_terms(source: str) -> str:
    """(email, term) occurrences of the Chinese chain."""
    run = f"unnest(regexp_extract_all(content, '\\p{{Han}}+'))"
    rest = sql.tokens("regexp_replace(content, '\\p{Han}+', ' ', 'g')")
    return f"""
      select email, term from (
        select email, unnest(case when length(run) < 2 then [run] else
               list_transform(range(1, length(run)), lambda i: run[i:i+1]) end) as term
        from (select email, {run} as run from ({source}))
        union all select email, unnest({rest}) from ({source}))
      where not regexp_full_match(term, '[\\p{{Nd}},.]+')"""


ZH_DOCS = f"select email, {HAN_TEXT.replace('text', 'content')} as content from ({USER_DOCS})"


def zh_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_docs(spark, sf_dir).withColumn("content", F.translate(F.lower("content"), *HAN))


@query("analyze_zh", f"select term, count(*) as n from ({sql_zh_terms(ZH_DOCS)}) group by term")
def analyze_zh(spark, sf_dir):
    terms = zh_docs(spark, sf_dir).select(F.explode(analysis.analyze("content", lang="zh-cn")).alias("term"))
    return frequency.count_by(terms, "term")


# --- analysis chains -----------------------------------------------------------------

@query("analyze_unstemmed", f"select term, count(*) as n from ({sql_terms(USER_DOCS)}) group by term")
def analyze_unstemmed(spark, sf_dir):
    terms = user_docs(spark, sf_dir).select(F.explode(analysis.analyze("content", stem=False)).alias("term"))
    return frequency.count_by(terms, "term")


@query("analyze_en", porter_sql.stemmed_counts("select text from documents", "text"))
def analyze_en(spark, sf_dir):
    terms = docs(spark, sf_dir).select(F.explode(analysis.analyze("text")).alias("term"))
    return frequency.count_by(terms, "term")


@query(
    "protect_words",
    porter_sql.stemmed_counts("select text from documents", "text", protected=["tions", "heading", "ententes"]),
)
def protect_words(spark, sf_dir):
    words = stem_tokens_en(tokenize(fold(F.col("text"))), ["tions", "heading", "ententes"])
    terms = docs(spark, sf_dir).select(F.explode(F.array_compact(filter_words(words))).alias("term"))
    return frequency.count_by(terms, "term")


CYRILLIC = ("abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстуввхыз")


def _language_query(lang: str) -> None:
    text = f"translate(lower(text), '{CYRILLIC[0]}', '{CYRILLIC[1]}')" if lang == "ru" else "text"
    words = sql.folded_tokens(text)
    if lang in stems_sql.ARTICLES:
        words = sql.each(words, stems_sql.unelided("x", lang))

    @query(f"analyze_{lang}", stems_sql.stemmed_counts(words, lang))
    def analyze_language(spark, sf_dir):
        content = F.translate(F.lower("text"), *CYRILLIC) if lang == "ru" else F.col("text")
        terms = docs(spark, sf_dir).select(F.explode(analysis.analyze(content, lang=lang)).alias("term"))
        return frequency.count_by(terms, "term")


for _lang in ("de", "es", "fr", "it", "nl", "pt", "ru", "sv"):
    _language_query(_lang)


# --- frequencies -----------------------------------------------------------------------

TERMS = sql_terms(USER_DOCS)
TOTAL = f"(select count(distinct email) from ({USER_DOCS}))"
DF = f"""select term, count(distinct email) as doc_count, {TOTAL} as total_docs,
                cast(count(distinct email) as double) / {TOTAL} as df from ({TERMS}) group by term"""


@query("explode_terms", f"select email, term, count(*) as n from ({sql_terms(USER_DOCS, 2)}) group by email, term")
def explode_user_terms(spark, sf_dir):
    return frequency.count_by(plain_terms(spark, sf_dir, shingle_size=2), "email", "term")


@query("term_counts", f"select email, term, count(*) as k11 from ({TERMS}) group by email, term")
def term_counts(spark, sf_dir):
    return llr.term_counts(plain_terms(spark, sf_dir))


@query("unique_count", f"select term, count(distinct email) as doc_count from ({TERMS}) group by term")
def unique_count(spark, sf_dir):
    return frequency.unique_count(plain_terms(spark, sf_dir, once=True))


@query("unique_users", f"select distinct email from ({USER_DOCS})")
def unique_users(spark, sf_dir):
    return frequency.unique_users(user_docs(spark, sf_dir))


@query("count_by", f"select email, count(*) as n from ({USER_DOCS}) group by email")
def count_by(spark, sf_dir):
    return frequency.count_by(user_docs(spark, sf_dir), "email")


@query("total_docs", f"select {TOTAL} as total_docs")
def total_docs(spark, sf_dir):
    return frequency.total_docs(user_docs(spark, sf_dir))


@query("document_frequency", f"select term, df, doc_count, total_docs from ({DF})")
def document_frequency(spark, sf_dir):
    counts = frequency.unique_count(plain_terms(spark, sf_dir, once=True))
    return frequency.document_frequency(counts, frequency.total_docs(user_docs(spark, sf_dir)))


@query("document_frequency_one_pass", f"select term, df, doc_count, total_docs from ({DF})")
def document_frequency_one_pass(spark, sf_dir):
    return term_frequencies(user_docs(spark, sf_dir), stem=False)


@query("df_top2000", f"select term, df from ({DF}) order by df desc, term limit 2000")
def df_top2000(spark, sf_dir):
    return mine_stopwords_of(user_docs(spark, sf_dir), stem=False)


@query("df_bad_words", f"select term, df from ({DF}) where df > 0.2")
def df_bad_words(spark, sf_dir):
    return mine_stopwords_of(user_docs(spark, sf_dir), max_df=0.2, stem=False)


@query(
    "df_bad_words_float32",
    f"""select term, cast(cast(cast(doc_count as float) / cast(total_docs as float) as float) as double) as df
        from ({DF}) where cast(cast(doc_count as float) / cast(total_docs as float) as float) > cast(0.2 as double)""",
)
def df_bad_words_float32(spark, sf_dir):
    out = mine_stopwords_of(user_docs(spark, sf_dir), max_df=0.2, stem=False, float32=True)
    return out.withColumn("df", F.col("df").cast("double"))


@query(
    "stopword_exclusion",
    f"""select term, count(*) as n from ({TERMS}) where term not in (
          select term from ({DF}) order by df desc, term limit 2000) group by term""",
)
def stopword_exclusion(spark, sf_dir):
    listed = mine_stopwords_of(user_docs(spark, sf_dir), stem=False)
    # read twice: without a table of its own, every text is taken apart twice
    return drop_stopwords(stage(frequency.count_by(plain_terms(spark, sf_dir), "term"), "counts"), listed)


@query(
    "own_analyzer_stopwords",
    f"""select term, count(*) as n from (select unnest(string_split(lower(content), ' ')) as term from ({USER_DOCS}))
        where term not in ({', '.join(map(sql.quote, STOPWORDS))}) group by term""",
)
def own_analyzer_stopwords(spark, sf_dir):
    terms = user_terms(
        user_docs(spark, sf_dir), stopwords=STOPWORDS, analyzer=lambda text: F.split(F.lower(text), " ")
    )
    return frequency.count_by(terms, "term")


# --- log-likelihood ratio -----------------------------------------------------------------

def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


def rounded_sql(inner: str, *names: str) -> str:
    return f"select {', '.join(names)}, round(score, 6) as score from ({inner})"


CLEAN_TERMS = sql_terms(CLEAN_DOCS)


@query("llr_scores", rounded_sql(sql.scores(TERMS), "email", "term", "k as k11"))
def llr_scores(spark, sf_dir):
    return rounded(llr.llr_scores(llr.term_counts(plain_terms(spark, sf_dir))))


@query("llr_hot_keys", rounded_sql(sql.scores(TERMS), "email", "term", "k as k11"))
def llr_hot_keys(spark, sf_dir):
    # keys of more than 50 rows, or a fiftieth of all, are cut into pieces
    return rounded(llr.llr_scores(llr.term_counts(plain_terms(spark, sf_dir)), share=50, piece_rows=50))


# totals as if the corpus were a million times larger, where the plain formula loses its digits
SCALE = 1_000_000
SCALED = f"""
  with t as (select email, term, cast(k as hugeint) as k11, cast(r as hugeint) * {SCALE} as r,
                    cast(c as hugeint) * {SCALE} as c, cast(n as hugeint) * {SCALE} * {SCALE} as n
             from ({sql.scores(TERMS)})),
  u as (select *, cast(k11 * n - r * c as double) as d from t)
  select email, term, round({sql.g2('d')}, 6) as score from u"""


@query("llr_scaled", SCALED)
def llr_scaled(spark, sf_dir):
    counts = stage(llr.term_counts(plain_terms(spark, sf_dir)), "counts")
    by_term = llr.key_totals(counts, ["term"], "r").drop("n_rows")
    by_user = llr.key_totals(counts, ["email"], "c").drop("n_rows")
    total = by_user.agg(F.sum("c").alias("n"))
    rows = counts.join(by_term, "term").join(by_user, "email").crossJoin(F.broadcast(total))
    # beyond 64 bits from ten million words on
    r, c, n = (F.col(x).cast("decimal(38,0)") for x in ("r", "c", "n"))
    score = llr.g2(F.col("k11"), r * SCALE, c * SCALE, n * SCALE * SCALE)
    return rows.select("email", "term", F.round(score, 6).alias("score"))


@query("llr_over", rounded_sql(f"select * from ({sql.scores(TERMS)}) where k11 * n > r * c", "email", "term", "k as k11"))
def llr_over(spark, sf_dir):
    return rounded(llr.llr_scores(llr.term_counts(plain_terms(spark, sf_dir)), direction="over"))


@query(
    "top_terms_per_length",
    rounded_sql(sql.top(sql_terms(USER_DOCS, 2), universe="len(string_split(term, ' '))"), "email", "term"),
)
def top_terms_per_length(spark, sf_dir):
    counts = llr.term_counts(plain_terms(spark, sf_dir, shingle_size=2))
    return rounded(llr.top_terms_by_llr(counts, per_length=True))


@query("top_terms", rounded_sql(sql.top(CLEAN_TERMS), "email", "term"))
def top_terms(spark, sf_dir):
    return rounded(top_terms_of(user_docs(spark, sf_dir), stem=False))


@query("top_terms_pruned", rounded_sql(sql.top(CLEAN_TERMS), "email", "term"))
def top_terms_pruned(spark, sf_dir):
    return rounded(top_terms_of(user_docs(spark, sf_dir), stem=False, prune=True))


# pairs that cannot reach a score whoever their user is: G2 at both extremes of the users' totals
PRUNE_AT = 12.0


def _at_end(end: str) -> str:
    return f"(select {sql.G2} from (select e.k11 as k11, e.r as r, cast({end} as double) as c, e.n as n))"


PRUNED_SHARE = f"""
  with e as (select s.*, min(c) over () as least, max(c) over () as most from ({sql.scores(TERMS)}) s),
  bounds as (select score, greatest({_at_end("greatest(e.k11, e.least)")},
                                    {_at_end("greatest(greatest(e.k11, e.least), least(e.most, e.n - e.r + e.k11))")}) as bound
             from e)
  select count(*) as n_pairs, count(*) filter (bound * (1 + 1e-6) + 1e-6 < {PRUNE_AT}) as n_pruned,
         count(*) filter (score >= {PRUNE_AT}) as n_reach from bounds"""


@query("llr_pruned_share", PRUNED_SHARE)
def llr_pruned_share(spark, sf_dir):
    """How many pairs never meet their users' totals if only scores from 12 on are asked for."""
    counts = stage(llr.term_counts(plain_terms(spark, sf_dir)), "counts")
    kept = llr.llr_scores(counts, staged=True, prune_below=PRUNE_AT)
    found = kept.agg(F.count("*").alias("n"), F.count_if(F.col("score") >= PRUNE_AT).alias("n_reach"))
    pairs = counts.agg(F.count("*").alias("n_pairs"))
    return pairs.crossJoin(found).select("n_pairs", (F.col("n_pairs") - F.col("n")).alias("n_pruned"), "n_reach")


@query("top_terms_bucketed", rounded_sql(sql.top(CLEAN_TERMS), "email", "term"))
def top_terms_bucketed(spark, sf_dir):
    """Counts in buckets by term, which their totals meet without moving again."""
    return rounded(top_terms_of(user_docs(spark, sf_dir), stem=False, buckets=16))


@query("top_terms_bigrams", rounded_sql(sql.top(sql_terms(CLEAN_DOCS, 2)), "email", "term"))
def top_terms_bigrams(spark, sf_dir):
    return rounded(top_terms_of(user_docs(spark, sf_dir), shingle_size=2, stem=False))


@query("top_terms_stopwords", rounded_sql(sql.top(sql_terms(CLEAN_DOCS, 3, STOPWORDS)), "email", "term"))
def top_terms_stopwords(spark, sf_dir):
    return rounded(top_terms_of(user_docs(spark, sf_dir), shingle_size=3, stopwords=STOPWORDS, stem=False))


# every short word of the corpus: more than fit in a literal set
SHORT_WORDS = f"select distinct term from ({TERMS}) where length(term) <= 6"


@query(
    "top_terms_bigrams_stopword_table",
    rounded_sql(
        sql.top(
            f"""select email, term from (select *, string_split(term, ' ') as w from ({sql_terms(CLEAN_DOCS, 2)}))
                where w[1] not in ({SHORT_WORDS}) and coalesce(w[2], '') not in ({SHORT_WORDS})"""
        ),
        "email",
        "term",
    ),
)
def top_terms_bigrams_stopword_table(spark, sf_dir):
    words = plain_terms(spark, sf_dir).select("term").distinct().filter(F.length("term") <= 6)
    return rounded(top_terms_of(user_docs(spark, sf_dir), shingle_size=2, stopwords=words, stem=False))


@query("top_terms_zh", rounded_sql(sql.top(sql_zh_terms(ZH_DOCS)), "email", "term"))
def top_terms_zh(spark, sf_dir):
    return rounded(top_terms_of(zh_docs(spark, sf_dir), lang="zh-cn"))


@query("top_terms_two_rounds", rounded_sql(sql.top(CLEAN_TERMS), "email", "term"))
def top_terms_two_rounds(spark, sf_dir):
    return rounded(top_terms_of(user_docs(spark, sf_dir), stem=False, limit_in_tasks=5))


@query("top_terms_stemmed", rounded_sql(sql.top(porter_sql.stemmed_terms(CLEAN_DOCS)), "email", "term"))
def top_terms_stemmed(spark, sf_dir):
    return rounded(top_terms_of(user_docs(spark, sf_dir)))


@query(
    "top_terms_conversations",
    rounded_sql(
        sql.top(sql_terms("select 'conv' || cast(conv_id as varchar) as email, text as content from conversations"), 5),
        "email",
        "term",
    ),
)
def top_terms_conversations(spark, sf_dir):
    talks = fx.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("email"), F.col("text").alias("content")
    )
    return rounded(top_terms_of(talks, max_terms=5, stem=False))


@query(
    "top_terms_nested",
    f"""select email, array_to_string(list(term order by score desc, term), ' ') as terms,
               round(list_sum(list(score order by score desc, term)), 4) as total_score
        from ({sql.top(CLEAN_TERMS)}) group by email""",
)
def top_terms_nested(spark, sf_dir):
    nested = rank.nest_terms(top_terms_of(user_docs(spark, sf_dir), stem=False))
    total = F.aggregate("scores", F.lit(0.0), lambda a, b: a + b)
    return nested.select("email", F.array_join("terms", " ").alias("terms"), F.round(total, 4).alias("total_score"))


@query("flatten_terms", rounded_sql(sql.top(CLEAN_TERMS), "email", "term"))
def flatten_terms(spark, sf_dir):
    nested = rank.nest_terms(top_terms_of(user_docs(spark, sf_dir), stem=False))
    return rounded(rank.flatten_terms(nested))


@query("top_terms_filtered", rounded_sql(
    f"""select * from (select email, term, score, row_number() over (partition by email order by score desc, term) as p
        from ({sql.scores(CLEAN_TERMS)}) where score >= 3.0 and length(term) > 5) where p <= 10""", "email", "term"))
def top_terms_filtered(spark, sf_dir):
    only_long = F.length("term") > 5
    return rounded(
        top_terms_of(user_docs(spark, sf_dir), max_terms=10, min_score=3.0, predicate=only_long, stem=False)
    )


# --- archives -------------------------------------------------------------------------------

def archive(spark: SparkSession, sf_dir: str) -> str:
    """The messages as mbox files."""
    path = new_path(spark, "mbox")
    mbox.write_mbox(fx.messages(spark, sf_dir), path)
    return path


MESSAGE_SQL = f"rtrim({fx.MESSAGE}, {NL}) || {NL}"


@query("scan_mbox", f"select {MESSAGE_SQL} as message from documents")
def scan_mbox(spark, sf_dir):
    return mbox.scan_mbox(spark, archive(spark, sf_dir)).select("message")


@query("scan_mbox_list", f"select count(*) as n, cast(sum(length({MESSAGE_SQL})) as bigint) as chars from documents")
def scan_mbox_list(spark, sf_dir):
    # a list with the one folder the messages are in
    listing = new_path(spark, "mbox-list")
    spark.createDataFrame([(archive(spark, sf_dir),)], "value string").write.text(listing)
    found = mbox.scan_mbox_list(spark, listing)
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("message")).alias("chars"))


@query(
    "split_mbox",
    f"""select source, doc_id, 1 as seq, {MESSAGE_SQL} as message from documents
        union all select source, doc_id, 0 as seq, 'Subject: head' || {NL} || {NL} || 'body' || {NL} from documents""",
)
def split_mbox(spark, sf_dir):
    # an archive per row: a message that does not start with a divider, then one that does
    text = fx.messages(spark, sf_dir).select("doc_id", "path", "message").withColumnRenamed("path", "source")
    doubled = text.select("source", "doc_id", F.concat(F.lit("Subject: head\n\nbody\n"), F.col("message")).alias("archive"))
    return mbox.split_mbox(doubled, "archive")


def archive_by_source(spark: SparkSession, rows: DataFrame, line_end: str = "\n") -> str:
    """One file per source, its (source, nth, value) rows in order."""
    path = new_path(spark, "mbox")
    ordered = rows.repartition("source").sortWithinPartitions("source", "nth")
    ordered.select("source", "value").write.partitionBy("source").option("lineSep", line_end).text(path)
    return path


def scanned_by_source(spark: SparkSession, path: str, **options) -> DataFrame:
    found = mbox.scan_mbox(spark, path, **options)
    return found.select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), "message")


def message_rows(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    return docs(spark, sf_dir).selectExpr("source", "doc_id as nth", f"{value} as value")


HEAD = f"'hello ' || source || {NL} || 'second line'"


@query(
    "scan_mbox_head",
    f"""select source, {MESSAGE_SQL} as message from documents
        union all select distinct source, {HEAD} || {NL} as message from documents""",
)
def scan_mbox_head(spark, sf_dir):
    """Text before the first divider of a file is a message of its own, all of it."""
    heads = docs(spark, sf_dir).select("source").distinct().selectExpr("source", "-1L as nth", f"{HEAD} as value")
    rows = message_rows(spark, sf_dir, fx.MESSAGE).unionByName(heads)
    return scanned_by_source(spark, archive_by_source(spark, rows))


LIKE_HEADER = f"{fx.DIVIDER} || {fx.HEADERS} || {NL} || 'before' || {NL}"
FROM_LINE = f"'From Subject: x' || {NL} || {fx.STUFFED}"


@query(
    "scan_mbox_header_like_body",
    f"""select source, {LIKE_HEADER} as message from documents
        union all select source, rtrim({FROM_LINE}, {NL}) || {NL} as message from documents""",
)
def scan_mbox_header_like_body(spark, sf_dir):
    """A line that begins with the divider begins a message, whatever follows in it."""
    rows = message_rows(spark, sf_dir, f"{LIKE_HEADER} || {FROM_LINE}")
    return scanned_by_source(spark, archive_by_source(spark, rows))


IN_BODY = f"{fx.DIVIDER} || {fx.HEADERS} || {NL} || 'line' || {NL} || 'From the start' || {NL} || {fx.STUFFED}"


@query("scan_mbox_strict_crlf", f"select source, rtrim({IN_BODY}, {NL}) || {NL} as message from documents")
def scan_mbox_strict_crlf(spark, sf_dir):
    """With strict dividers a body line that begins like one stays, also between CRLF line ends."""
    rows = message_rows(spark, sf_dir, f"replace(trim(trailing {NL} from {IN_BODY}) || {NL}, {NL}, chr(13) || {NL})")
    return scanned_by_source(spark, archive_by_source(spark, rows, "\r\n"), strict=True)


def parsed_messages(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return parse.parse_messages(fx.messages(spark, sf_dir).drop("path"), **options)


@query("header_fields", f"select doc_id, {fx.parsed_sql('id', 'subject', 'replyid')} from documents")
def header_fields(spark, sf_dir):
    return parsed_messages(spark, sf_dir).select("doc_id", "id", "subject", "replyid")


@query("split_address", f"select doc_id, {fx.parsed_sql('author', 'email')} from documents")
def split_address(spark, sf_dir):
    return parsed_messages(spark, sf_dir).select("doc_id", "author", "email")


@query(
    "from_fallback",
    "select doc_id, case when doc_id % 2 = 0 then source || ' at example.com' else 'group: ' || source end as creator"
    " from documents",
)
def from_fallback(spark, sf_dir):
    header = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<"), "source", F.lit(" at example.com>")))
    header = header.otherwise(F.concat(F.lit("group: "), "source"))
    return docs(spark, sf_dir).select("doc_id", mail.from_display(header).alias("creator"))


@query(
    "recipients",
    "select doc_id, unnest(['B, C <b' || cast(doc_id as varchar) || '@x.org>', 'd@x.org']) as recipient from documents",
)
def recipients(spark, sf_dir):
    return parsed_messages(spark, sf_dir).select("doc_id", F.explode("to").alias("recipient"))


# To headers by the grammar: groups, comments in comments, quoted pairs, routes, encoded words,
# and what is no list. SQL states what each row's header names, not how it is read.
RECIPIENTS_GRAMMAR = """
  select doc_id, unnest(case doc_id % 7
    when 0 then ['team: ' || source || '@x.org, d@e.f;', 'z@z.z']
    when 1 then ['A " , ' || source || ' <a@b.c>']
    when 2 then ['Ann <' || source || '@b.c>', 'b@c.d']
    when 3 then [source || '@b.c', '"a, >b"@c.d']
    when 4 then ['(' || source, 'a@b.c']
    when 5 then ['Doe, ' || source || ' <j@x.org>', 'k@x.org']
    else ['friends: a@b.c', source || '@e.f'] end) as recipient from documents"""


@query("recipients_grammar", RECIPIENTS_GRAMMAR)
def recipients_grammar(spark, sf_dir):
    header = F.expr("""case doc_id % 7
        when 0 then 'team: Ann (the (real), one) <' || source || '@x.org>, d@e.f;, z@z.z (x;y:z)'
        when 1 then '"A \\\\" , ' || source || '" <a@b.c>'
        when 2 then 'Ann (a "quoted) (com(ment)) <@h.i,@j.k:' || source || '@b.c> , b@c.d'
        when 3 then '<' || source || '@b.c> (don"t),, <"a, >b"@c.d>'
        when 4 then '(' || source || ', a@b.c'
        when 5 then '=?utf-8?q?Doe=2C_' || source || '?= <j@x.org>, k@x.org'
        else 'friends: a@b.c, ' || source || '@e.f' end""")
    message = F.concat(F.lit("From x\nTo: "), header, F.lit("\n\nbody\n"))
    parsed = parse.parse_messages(docs(spark, sf_dir).select("doc_id", message.alias("message")))
    return parsed.select("doc_id", F.explode("to").alias("recipient"))


@query("mail_date", f"select doc_id, {fx.parsed_sql('epoch')} from documents")
def mail_date(spark, sf_dir):
    return parsed_messages(spark, sf_dir).select("doc_id", F.unix_timestamp("date").alias("epoch"))


@query("mail_body", f"select doc_id, {fx.STUFFED} as content from documents")
def mail_body(spark, sf_dir):
    return parsed_messages(spark, sf_dir).select("doc_id", "content")


def mime_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-part messages: the text in base64 and a short HTML part; subjects as encoded words."""
    return docs(spark, sf_dir).select(
        "doc_id",
        F.concat(
            F.lit("From x\nSubject: =?UTF-8?B?"),
            F.base64(F.encode(F.concat(F.lit("é "), "source"), "UTF-8")),
            F.lit('?=\nMIME-Version: 1.0\nContent-Type: multipart/alternative; boundary="b1"\n\n--b1\n'),
            F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"),
            F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "(.{76})", "$1\n"),
            F.lit("\n--b1\nContent-Type: text/html; charset=utf-8\nSubject: inner\n\n<h1>no</h1><p>"),
            F.col("source"),
            F.lit("<br>&amp; more</p>\n--b1--\n"),
        ).alias("message"),
    )


@query(
    "mime_body",
    f"""select doc_id, 'é ' || source as subject,
               text || {NL} || 'no ' || {NL} || source || {NL} || '& more ' || {NL} as content from documents""",
)
def mime_body(spark, sf_dir):
    return parse.parse_messages(mime_messages(spark, sf_dir)).select("doc_id", "subject", "content")


# Paragraphs of HTML by the events of its tags: texts are cut at every "<", and what holds at a
# piece is what the last tag before it that matters has said.
P_ENDS = [
    "p", "div", "article", "section", "main", "aside", "header", "footer", "nav", "form", "fieldset", "blockquote",
    "figure", "center", "ul", "ol", "li", "dl", "dd", "dt", "table", "tbody", "thead", "tfoot", "tr", "td", "th",
    "body", "html",
]
REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "copy": "\u00a9", "middot": "\u00b7", "amp": "&"}
DECODED = "string_agg(t, '' order by i)"
for _name, _sign in REFERENCES.items():
    DECODED = f"replace({DECODED}, '&{_name};', {sql.quote(_sign)})"


PARAGRAPHS = f"""
    with cut as (select page_id, unnest(string_split(html, '<')) as piece,
                        generate_subscripts(string_split(html, '<'), 1) as i from pages),
    tagged as (
      select page_id, i, substr(piece, instr(piece, '>') + 1) as t,
             lower(string_split(string_split(string_split(piece, '>')[1], ' ')[1], chr(10))[1]) as tag
      from cut where i > 1),
    hidden as (
      select *, coalesce(last_value(case when tag in ('script', 'style') then true
                                         when tag in ('/script', '/style') then false end ignore nulls)
                         over (partition by page_id order by i rows unbounded preceding), false) as hid
      from tagged),
    events as (
      select *, case when tag = 'p' then true
                     when tag in ({', '.join(f"'/{t}'" for t in P_ENDS)}) then false end as opens
      from hidden where not hid),
    states as (
      select page_id, i, case when tag = 'br' then chr(10) || t else t end as t,
             coalesce(last_value(opens ignore nulls) over w, false) as inside,
             count(*) filter (tag = 'p') over w as p
      from events window w as (partition by page_id order by i rows unbounded preceding)),
    paragraphs as (select page_id, p, {DECODED} || ' ' || chr(10) as t from states where inside group by page_id, p)
    select page_id, coalesce(string_agg(t, '' order by p), '') as text
    from pages left join paragraphs using (page_id) group by page_id"""


@query("html_paragraphs", PARAGRAPHS)
def html_paragraphs(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", html_paragraph_text("html").alias("text"))


# Every page with markup that only a tokenizer reads rightly: ">" and tags in values, "<" as text,
# comments that hold tags, raw text up to its own end tag and to the end. SQL reads pages that
# say the same plainly.
HARD_START = """<p data-x="1 > 0" title='</p><script>' class=it's>"""
HARD_END = " 1 < 2 <3 a<- b<!-- > </p> <q> --> c<script>'<p>no</p>' < 3</scripts></SCRIPT ></p >"
PLAIN_END = " 1 &lt; 2 &lt;3 a&lt;- b c</p>"
HARD_TAIL = "<p>last &lt;p&gt;<style>q > p</style> one</p><script>if (a<b) '<p>never</p>'"
PLAIN_TAIL = "<p>last &lt;p&gt; one</p>"


@query(
    "html_paragraphs_hard",
    PARAGRAPHS.replace("from pages)", f"""from (
      select page_id, replace(html, '</p>', {sql.quote(PLAIN_END)}) || {sql.quote(PLAIN_TAIL)} as html from pages))""", 1),
)
def html_paragraphs_hard(spark, sf_dir):
    markup = F.replace(F.replace(F.col("html"), F.lit("<p>"), F.lit(HARD_START)), F.lit("</p>"), F.lit(HARD_END))
    # the attribute that has just been written holds an end tag, too
    markup = F.replace(markup, F.lit(HARD_START.replace("</p>", HARD_END)), F.lit(HARD_START))
    pages = fx.table(spark, sf_dir, "pages").select("page_id", F.concat(markup, F.lit(HARD_TAIL)).alias("html"))
    return pages.select("page_id", html_paragraph_text("html").alias("text"))


# the limit is lowered to what some of the lines pass
LINE_CAP = 400


@query(
    "parse_rejects",
    f"""select {fx.PARSED['id']} as id, 'line too long' as parse_error from documents
        where list_max({sql.each(f"string_split({fx.MESSAGE}, {NL})", 'length(x)')}) > {LINE_CAP}""",
)
def parse_rejects(spark, sf_dir):
    return parse.rejected(parsed_messages(spark, sf_dir, max_line_len=LINE_CAP)).drop("path", "block_start", "seq")


ISO_DATE = "strftime(to_timestamp(epoch) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ')"
PARSED_DOCS = f"select doc_id, {fx.parsed_sql(*fx.PARSED)} from documents"


TSV_LINE = f"""id || {fx.TAB} || author || {fx.TAB} || email || {fx.TAB} || subject || {fx.TAB} || {ISO_DATE}
               || {fx.TAB} || replyid || {fx.TAB} || {ESCAPED % 'content'}"""


@query(
    "parse_archives",
    f"select {TSV_LINE} as value from ({PARSED_DOCS})",
)
def parse_archive_files(spark, sf_dir):
    out = new_path(spark, "emails")
    parse_archives(spark, out, paths=archive(spark, sf_dir))
    return spark.read.text(out)


# lines of files are measured in bytes; the length rule counts all messages, but only the length of those that
# could be parsed
JUDGED = f"""select m.*, too_wide, not too_wide and (select count(*) from documents) > 100 and length(content) >
               (select (4 * sum(case when too_wide then 0 else length(content) end)) // count(*) from judged_base)
               as oversized
             from judged_base m"""
JUDGED_BASE = f"""judged_base as (select p.*, w.too_wide from ({PARSED_DOCS}) p join (
                    select doc_id, list_max({sql.each(f"string_split({fx.MESSAGE}, {NL})", 'strlen(x)')}) > {LINE_CAP}
                           as too_wide from documents) w using (doc_id))"""


@query(
    "parse_archives_oversize",
    f"""with {JUDGED_BASE}, j as ({JUDGED.replace('m.*, too_wide', 'm.*')})
        select '' as parse_error, {TSV_LINE} as value from j where not too_wide and not oversized
        union all
        select case when oversized then 'longer than four times the mean' else 'line too long' end, id from j
        where too_wide or oversized""",
)
def parse_archives_oversize(spark, sf_dir):
    """What is in the output, and what is not and why."""
    out, rejects = new_path(spark, "emails"), new_path(spark, "rejects")
    parse_archives(
        spark, out, paths=archive(spark, sf_dir), oversize="global", max_line_len=LINE_CAP, rejects_dir=rejects
    )
    kept = spark.read.text(out).select(F.lit("").alias("parse_error"), "value")
    return kept.union(spark.read.parquet(rejects).select("parse_error", "id"))


@query(
    "parse_metrics",
    f"""with {JUDGED_BASE}, j as ({JUDGED.replace('m.*, too_wide', 'm.*')})
        select count(*) as n_messages, count(*) filter (too_wide) as n_rejected,
               count(*) filter (oversized) as n_skipped from j""",
)
def parse_metrics(spark, sf_dir):
    counts = parse_archives(
        spark, new_path(spark, "emails"), paths=archive(spark, sf_dir), oversize="global", max_line_len=LINE_CAP
    )
    names = ["n_messages", "n_rejected", "n_skipped"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


# every fiftieth message is one line of many times its text
LONG_LINE = f"case when doc_id % 50 = 0 then repeat(replace(text, {NL}, ' ') || ' ', 50) else {fx.STUFFED} end"


@query("parse_long_lines", f"select doc_id, length({LONG_LINE}) as n, '' as parse_error from documents")
def parse_long_lines(spark, sf_dir):
    raw = docs(spark, sf_dir).selectExpr("doc_id", f"{fx.DIVIDER} || {fx.HEADERS} || {NL} || {LONG_LINE} as message")
    found = parse.parse_messages(raw)
    return found.select(
        "doc_id", F.length("content").cast("bigint").alias("n"), F.coalesce("parse_error", F.lit("")).alias("parse_error")
    )


# texts that a charset of one byte cannot hold stay in UTF-8
NARROW = "regexp_matches(text, '^[\\x00-\\x7F\\x{A0}-\\x{FF}]*$')"


@query(
    "mime_charsets",
    f"select doc_id, text || case when {NARROW} and doc_id % 3 = 1 then '€' else '' end as content from documents",
)
def mime_charsets(spark, sf_dir):
    """Texts in three charsets and three transfer encodings come back as they were."""
    d = docs(spark, sf_dir).withColumn("narrow", F.rlike("text", F.lit(r"(?s)^[\x00-\x7F\xA0-\xFF]*$")))
    kind = F.when(~F.col("narrow") | (F.col("doc_id") % 3 == 2), 2).otherwise((F.col("doc_id") % 3).cast("int"))
    d = d.withColumn("kind", kind)
    names = F.lit(["ISO-8859-1", '"windows-1252"', "utf-8"])
    one_byte = F.encode(F.when(F.col("kind") < 2, F.col("text")), "ISO-8859-1")
    euro = F.when(F.col("kind") == 1, F.unhex(F.lit("80"))).otherwise(F.unhex(F.lit("")))
    d = d.withColumn(
        "bytes", F.when(F.col("kind") < 2, F.concat(one_byte, euro)).otherwise(F.encode("text", "UTF-8"))
    )
    coding = F.floor(F.col("doc_id") / 3) % 3
    body = (
        F.when(coding == 0, F.col("bytes"))
        .when(coding == 1, F.regexp_replace(F.hex("bytes"), "(..)", "=$1").cast("binary"))
        .otherwise(F.base64("bytes").cast("binary"))
    )
    codings = F.lit(["8bit", "quoted-printable", "base64"])
    head = F.concat(
        F.lit("From x\nContent-Type: text/plain; charset="),
        F.get(names, F.col("kind")),
        F.lit("\nContent-Transfer-Encoding: "),
        F.get(codings, coding.cast("int")),
        F.lit("\n\n"),
    )
    return parse.parse_messages(d.select("doc_id", F.concat(head.cast("binary"), body).alias("message"))).select(
        "doc_id", "content"
    )


@query(
    "skip_oversized_global",
    """select doc_id, length(text) as n from documents where not (
         (select count(*) from documents) > 100 and
         length(text) > (select (4 * sum(length(text))) // count(*) from documents))""",
)
def skip_oversized_global(spark, sf_dir):
    kept = oversize.skip_oversized_global(fx.table(spark, sf_dir, "documents"), F.length("text"))
    return kept.select("doc_id", F.length("text").cast("bigint").alias("n"))


RUNNING = """select doc_id, lang, length(text) as len,
                    count(*) over w as seen, sum(length(text)) over w as chars
             from documents window w as (partition by lang order by doc_id)"""


@query("running_sizes", f"select doc_id, seen, cast(chars as bigint) as chars from ({RUNNING})")
def running_sizes(spark, sf_dir):
    # the length is taken before anything moves
    chunked = fx.table(spark, sf_dir, "documents").withColumn("chunk", F.floor(F.col("doc_id") / 64))
    sizes = oversize.running_sizes(chunked, F.length("text"), ["lang"], ["chunk"], ["doc_id"])
    return sizes.select("doc_id", F.col("_count").alias("seen"), F.col("_total").alias("chars"))


@query(
    "skip_oversized_running",
    f"select doc_id, len as n from ({RUNNING}) where not (seen > 100 and len > (4 * chars) // seen)",
)
def skip_oversized_running(spark, sf_dir):
    # the length is taken before anything moves
    chunked = fx.table(spark, sf_dir, "documents").withColumn("chunk", F.floor(F.col("doc_id") / 64))
    kept = oversize.skip_oversized_running(chunked, F.length("text"), ["lang"], ["chunk"], ["doc_id"])
    return kept.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(
    "skip_oversized_stream",
    f"select doc_id, len as n from ({RUNNING}) where not (seen > 100 and len > (4 * chars) // seen)",
)
def skip_oversized_stream(spark, sf_dir):
    """The running rule with the number and length of messages as state, over a stream in several batches."""
    folder, out = new_path(spark, "arriving"), new_path(spark, "kept")
    sized = fx.table(spark, sf_dir, "documents").select("lang", "doc_id", F.length("text").alias("n"))
    last = sized.agg(F.max("doc_id")).first()[0] or 0
    # files arrive in the order of their messages
    for n in range(4):
        here = F.floor(F.col("doc_id") * 4 / (last + 1)) == n
        sized.filter(here).repartition(1).write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(sized.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    kept = stream_kept_sizes(arriving, "lang", "doc_id", "n")
    checkpoint = new_path(spark, "stream-state")
    run = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(F.col("place").alias("doc_id"), F.col("length").alias("n"))


# --- mail that keeps arriving -----------------------------------------------------------------


@query("scan_mbox_stream", f"select source, rtrim({IN_BODY}, {NL}) || {NL} as message from documents")
def scan_mbox_stream(spark, sf_dir):
    """Archives as a stream in batches of a few files, with strict dividers."""
    rows = message_rows(spark, sf_dir, f"trim(trailing {NL} from {IN_BODY}) || {NL}")
    folder, out = archive_by_source(spark, rows), new_path(spark, "streamed")
    stream_mbox(
        spark, f"{folder}/*", out, new_path(spark, "stream-state"), strict=True, files_per_batch=7, availableNow=True
    ).awaitTermination()
    source = F.regexp_extract("path", "source=([^/]*)/", 1).alias("source")
    return streamed(spark, out).select(source, "message")


@query("term_counts_incremental", f"select email, term, count(*) as k11 from ({TERMS}) group by email, term")
def term_counts_incremental(spark, sf_dir):
    """Three slices, one of which is added again, from a store of counts."""
    store = new_path(spark, "store")
    emails = fx.emails(spark, sf_dir)
    for n in (0, 1, 2, 1):
        of_slice = emails.filter(F.col("doc_id") % 3 == n).select(clean.normalize_email("email").alias("email"), "content")
        increments.add_slice(spark, store, f"slice-{n}", user_terms(of_slice, stem=False))
    return increments.merged_counts(spark, store)


@query(
    "unique_count_sketched",
    f"""select term, count(distinct doc_id) as n_docs, true as within
        from (select doc_id, unnest({sql.tokens('text')}) as term from documents) group by term""",
)
def unique_count_sketched(spark, sf_dir):
    """Documents of every term from sketches of eight slices, next to the exact count."""
    # each text is taken apart once, and has a word once
    of_text = F.explode(F.array_distinct(tokenize("text"))).alias("term")
    words = stage(docs(spark, sf_dir).select("doc_id", (F.col("doc_id") % 8).alias("slice"), of_text), "words")
    by_slice = stage(sketches.user_sketches(words, ["slice"], user="doc_id"), "sketches")
    estimate = sketches.estimated_users(sketches.merge_sketches(by_slice))
    exact = words.groupBy("term").agg(F.count_distinct("doc_id").alias("n_docs"))
    within = sketches.within_bound(F.col("doc_count"), F.col("n_docs"))
    return exact.join(estimate, "term", "left").select("term", "n_docs", F.coalesce(within, F.lit(False)).alias("within"))


class Spelled:
    """A parser with state: words of one kind of letters, which it compiles once a task."""

    def __init__(self, least: int = 3) -> None:
        import re

        self.word = re.compile(rf"[a-z]{{{least},}}")

    @staticmethod
    def columns(least: int = 3):
        from pyspark.sql.types import StringType, StructType

        return StructType().add("term", StringType())

    def parse(self, text: str):
        return ((w,) for w in self.word.findall(text.lower()))


SPELLED = "regexp_extract_all(lower(content), '[a-z]{4,}')"


@query(
    "top_terms_udtf",
    rounded_sql(sql.top(f"select email, unnest({SPELLED}) as term from ({CLEAN_DOCS})"), "email", "term"),
)
def top_terms_udtf(spark, sf_dir):
    """Terms by an own parser as a table function of SQL."""
    register_parsers(spark, "terms_of", {"spelled": Spelled})
    cleaned = user_docs(spark, sf_dir).select("email", clean.strip_quote_header("content").alias("content"))
    cleaned.createOrReplaceTempView("cleaned_docs")
    terms = spark.sql("""select email, t.term from cleaned_docs, lateral terms_of(content, 'spelled', '{"least": 4}') t""")
    return rounded(llr.top_terms_by_llr(llr.term_counts(terms)))


# --- whole jobs, from file to file ------------------------------------------------------------


def email_files(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "emails")
    emails_tsv.write_emails_tsv(fx.emails(spark, sf_dir), path)
    return path


@query("top_terms_job", rounded_sql(sql.top(sql_terms(CLEAN_DOCS, stopwords=STOPWORDS)), "email", "term"))
def top_terms_job(spark, sf_dir):
    words = new_path(spark, "stop")
    spark.createDataFrame([(w,) for w in STOPWORDS], "value string").write.text(words)
    out = run_top_terms(spark, email_files(spark, sf_dir), new_path(spark, "work"), words, stem=False)
    return rounded(spark.read.parquet(out))


@query("mine_stopwords_job", f"select term, df from ({DF}) where df > 0.2")
def mine_stopwords_job(spark, sf_dir):
    out = mine_stopwords(spark, email_files(spark, sf_dir), new_path(spark, "work"), max_df=0.2, stem=False)
    return spark.read.parquet(out)


# bodies keep their quote headers, which the job removes
ARCHIVE_DOCS = f"select lower(trim(email)) as email, {QUOTE_HEADER} as content from ({PARSED_DOCS})"


@query("archive_to_top_terms", rounded_sql(sql.top(porter_sql.stemmed_terms(ARCHIVE_DOCS)), "email", "term"))
def archive_to_top_terms(spark, sf_dir):
    emails = new_path(spark, "emails")
    parse_archives(spark, emails, paths=archive(spark, sf_dir), oversize=None)
    return rounded(spark.read.parquet(run_top_terms(spark, emails, new_path(spark, "work"))))


# --- word lists ---------------------------------------------------------------------------------

@query("read_stopwords", f"select term, df from ({DF}) where df > 0.2")
def read_stopwords(spark, sf_dir):
    """Mined words written as a stop-word file, read back and joined with their df."""
    mined = mine_stopwords_of(user_docs(spark, sf_dir), max_df=0.2, stem=False)
    path = wordlists.write_terms(mined.select("term"), new_path(spark, "words"), fmt="tsv")
    return wordlists.read_stopwords(spark, path).join(mined, "term").select("term", "df")


@query("read_wordlist", "select distinct source as term from documents")
def read_wordlist(spark, sf_dir):
    path = new_path(spark, "wordlist")
    padded = docs(spark, sf_dir).select(
        F.explode(F.array(F.lit("# comment"), F.lit(""), F.concat(F.lit(" "), "source", F.lit("  ")))).alias("value")
    )
    padded.write.text(path)
    return wordlists.read_wordlist(spark, path)
