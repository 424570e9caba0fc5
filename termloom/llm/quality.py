"""Quality of documents by weak supervision, in DataFrame functions.

Rules vote for (1), against (-1) or abstain (0). Documents are good, or bad in one of the
ways that a group of rules looks for. How often a rule that doesn't abstain votes against
the documents of each class is estimated by expectation maximisation over the counts of
vote patterns, of which there are at most 3 to the number of rules, whatever the number of
documents. To abstain says nothing about a document. A document is kept if its posterior
probability of being good is one half or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.let import let
from ..staging import stage

WINDOW = 8  # a power of two
ROUNDS = 40
#: what the model believes before it has seen any document: the share of good documents,
#: and how often a rule votes against good ones, ones that are bad in its way, other bad ones
PRIOR_GOOD = 0.9
AGAINST_GOOD, AGAINST_OWN, AGAINST_OTHER = 0.01, 0.8, 0.05
#: documents of a class that this belief weighs as much as
PRIOR_DOCUMENTS = 20.0
#: bounds of the estimated shares; a rule may be wrong about few good documents only, or a
#: way of being bad that one rule sees could as well pass for good
LEAST, MOST, MOST_GOOD = 0.001, 0.999, 0.02

_BLANKS = " \t\n\u000b\f\r"
_GAP, _NOT_GAP = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"


def _words(text: Column) -> Column:
    return let(
        F.btrim(text, F.lit(_BLANKS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, _GAP)),
    )


def _windows(words: Column) -> Column:
    """A hash of every run of WINDOW words, from those of runs half as long."""

    def doubled(runs: Column, length: int) -> Column:
        return let(runs, lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + length))))

    runs, length = F.transform(words, lambda w: F.xxhash64(w)), 1
    while length < WINDOW:
        runs, length = doubled(runs, length), 2 * length
    # the last runs lack words
    return F.slice(runs, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: the union of their places.

    Equal windows stand side by side once sorted; their places, sorted again, each add
    the words that the one before does not cover.
    """
    by_value = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = let(
        by_value,
        lambda s: F.filter(
            s,
            lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)),
        ),
    )
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate(
        F.sort_array(F.transform(repeated, lambda e: e["i"])),
        start,
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"]).cast("long")).alias("n")
        ),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(union)


_OWN = ["_q_text", "_q_words", "_q_lines", "_q_windows"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """All columns and a struct ``_q`` of counts over the whole text; null counts as empty."""
    df = docs.withColumn("_q_text", F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("_q_words", _words(F.col("_q_text"))).withColumn(
        "_q_lines", F.filter(F.split("_q_text", "\n"), lambda x: F.rlike(x, F.lit(_NOT_GAP)))
    )
    df = df.withColumn("_q_windows", _windows(F.col("_q_words")))
    long = {
        "n_words": F.size("_q_words"),
        "word_chars": F.length(F.array_join("_q_words", "")),
        "n_symbols": F.length(F.regexp_replace("_q_text", "[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("_q_lines") - F.size(F.array_distinct("_q_lines")),
        "n_repeat_words": _covered(F.col("_q_windows")),
        "_q_distinct": F.size(F.array_distinct("_q_words")),
        "_q_stutter": F.size(
            F.filter("_q_words", lambda w, i: F.coalesce(w == F.get(F.col("_q_words"), i - 1), F.lit(False)))
        ),
        # what is left when long runs of all else are taken out
        "_q_upper": F.length(F.regexp_replace("_q_text", r"\P{Lu}+", "")),
        "_q_signs": F.length(F.regexp_replace("_q_text", r"[\p{L}\p{N}\s]+", "")),
        "_q_shouts": F.length("_q_text") - F.length(F.replace(F.col("_q_text"), F.lit("!"), F.lit(""))),
        "_q_n_lines": F.size("_q_lines"),
        "_q_ended": F.size(F.filter("_q_lines", lambda x: F.rlike(x, F.lit(r'[.!?:"»”…]\s*$')))),
    }
    counts = F.struct(*[c.cast("long").alias(name) for name, c in long.items()])
    return df.withColumn("_q", counts).drop(*_OWN)


def _vote(value: Column, good: Column, bad: Column, has: Column) -> Column:
    return F.when(has & bad, -1).when(has & good, 1).otherwise(0).cast("tinyint")


def votes(q: Column) -> Column:
    """One vote of each rule, as an array. A rule that has nothing to look at abstains."""

    def share(a: str, b: str) -> Column:
        return q[a] / F.when(q[b] > 0, q[b])

    words, lines = q["n_words"] > 0, q["_q_n_lines"] >= 3
    rules = {
        "marks": (share("n_symbols", "n_words"), lambda x: x <= 0.02, lambda x: x > 0.1, words),
        "signs": (share("_q_signs", "word_chars"), lambda x: x <= 0.1, lambda x: x > 0.15, words),
        "capitals": (share("_q_upper", "word_chars"), lambda x: x <= 0.15, lambda x: x > 0.4, words),
        "shouts": (share("_q_shouts", "n_words"), lambda x: x <= 0.1, lambda x: x > 0.3, words),
        "windows": (share("n_repeat_words", "n_words"), lambda x: x <= 0.1, lambda x: x > 0.25, words),
        "lines": (share("n_dup_lines", "_q_n_lines"), lambda x: x <= 0.3, lambda x: x > 0.5, lines),
        "variety": (share("_q_distinct", "n_words"), lambda x: x >= 0.4, lambda x: x < 0.2, q["n_words"] >= 50),
        "stutter": (share("_q_stutter", "n_words"), lambda x: x <= 0.05, lambda x: x > 0.3, words),
        "length": (
            share("word_chars", "n_words"),
            lambda x: (x >= 3.5) & (x <= 8),
            lambda x: (x < 2) | (x > 15),
            words,
        ),
        "ends": (share("_q_ended", "_q_n_lines"), lambda x: x >= 0.7, lambda x: x < 0.1, lines),
    }
    return F.array(*[_vote(x, good(x), bad(x), has) for x, good, bad, has in (rules[r] for r in RULES)])


#: rules by the way of being bad that they look for; the first class is the good one
WAYS = {
    "marks": ["marks", "signs"],
    "shouting": ["capitals", "shouts"],
    "repetition": ["windows", "lines", "variety", "stutter"],
    "shape": ["length", "ends"],
}
RULES = [r for rules in WAYS.values() for r in rules]
CLASSES = ["good", *WAYS]


def _start() -> Column:
    def against(c: str) -> list[float]:
        own = WAYS.get(c, [])
        return [AGAINST_GOOD if c == "good" else AGAINST_OWN if r in own else AGAINST_OTHER for r in RULES]

    bad = (1 - PRIOR_GOOD) / len(WAYS)
    return F.struct(
        F.array(*[F.lit(PRIOR_GOOD if c == "good" else bad) for c in CLASSES]).alias("prior"),
        F.array(*[F.array(*map(F.lit, against(c))) for c in CLASSES]).alias("against"),
    )


def _posteriors(model: Column, pattern: Column) -> Column:
    """Probability of each class for a pattern of votes; an abstention counts for nothing."""

    def log_joint(prior: Column, against: Column) -> Column:
        each = F.zip_with(
            pattern, against, lambda v, p: F.when(v == -1, F.ln(p)).when(v == 1, F.ln(1 - p)).otherwise(0.0)
        )
        return F.aggregate(each, F.ln(prior), lambda a, x: a + x)

    def normal(logs: Column) -> Column:
        return let(F.transform(logs, lambda x: F.exp(x - F.array_max(logs))), divided)

    def divided(parts: Column) -> Column:
        return F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda a, y: a + y))

    return let(F.zip_with(model["prior"], model["against"], log_joint), normal)


def fit(patterns: DataFrame) -> DataFrame:
    """(votes, n) of the patterns -> (votes, posterior).

    All patterns fit in one row, at most 3 to the number of rules, and the rounds of
    expectation and maximisation are array functions over it. The shares start from, and
    are smoothed towards, the prior belief, so a class keeps its meaning.
    """
    start = _start()

    def total(rows: Column, of) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda a, r: a + of(r))

    def maximise(rows: Column) -> Column:
        """rows: (votes, n, documents of each class among them)"""
        n = total(rows, lambda r: r["n"])
        prior = F.transform(
            start["prior"],
            lambda p, c: (total(rows, lambda r: F.get(r["of"], c)) + p * PRIOR_DOCUMENTS) / (n + PRIOR_DOCUMENTS),
        )

        def share(c: Column, j: Column, believed: Column) -> Column:
            def cast(v: int) -> Column:
                return total(rows, lambda r: F.when(F.get(r["votes"], j) == v, F.get(r["of"], c)).otherwise(0.0))

            return let(
                cast(-1),
                lambda x: F.greatest(
                    F.lit(LEAST),
                    F.least(
                        F.when(c == 0, MOST_GOOD).otherwise(MOST),
                        (x + believed * PRIOR_DOCUMENTS) / (x + cast(1) + PRIOR_DOCUMENTS),
                    ),
                ),
            )

        against = F.transform(
            start["against"], lambda of_class, c: F.transform(of_class, lambda believed, j: share(c, j, believed))
        )
        return F.struct(prior.alias("prior"), against.alias("against"))

    def step(model: Column, rows: Column) -> Column:
        def expected(r: Column) -> Column:
            of = F.transform(_posteriors(model, r["votes"]), lambda p: p * r["n"])
            return F.struct(r["votes"].alias("votes"), r["n"].alias("n"), of.alias("of"))

        return let(F.transform(rows, expected), maximise)

    one_row = patterns.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("rows")
    )
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    fitted = one_row.select("rows", F.aggregate(rounds, start, lambda m, _: step(m, F.col("rows"))).alias("model"))
    return fitted.select("model", F.explode("rows").alias("r")).select(
        F.col("r.votes").alias("votes"),
        F.get(_posteriors(F.col("model"), F.col("r.votes")), F.lit(0)).alias("posterior"),
    )


def _base_failed(q: Column) -> Column:
    return (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])


def _verdicts(counted: DataFrame) -> DataFrame:
    """Adds ``_q_posterior``; the small table of patterns is bounded and so may be broadcast."""
    voted = counted.withColumn("_q_votes", votes(F.col("_q")))
    patterns = voted.groupBy(F.col("_q_votes").alias("votes")).agg(F.count("*").alias("n"))
    scored = stage(fit(patterns), "votes").withColumnRenamed("votes", "_q_key")
    return voted.join(
        F.broadcast(scored.withColumnRenamed("posterior", "_q_posterior")), F.col("_q_votes") == F.col("_q_key"), "left"
    )


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, five counts, base_failed, kept, posterior) for every row of ``docs``.

    A null or empty text has no words and fails the base rules, as do all texts under 20
    words and texts of which over 30 % of the words repeat. Equal texts get equal results;
    a repeated or null id changes nothing. An empty table gives an empty table; other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = stage(with_counts(rows, "text").select("id", "_q"), "counts")
    q = F.col("_q")
    failed = _base_failed(q)
    return _verdicts(counted).select(
        F.col("id").alias(id_col),
        *[q[c].alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        (~failed & (F.col("_q_posterior") >= 0.5)).alias("kept"),
        F.col("_q_posterior").alias("posterior"),
    )


def drop_low_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns; each row by its own text.

    Counts are made twice, once for the patterns and once for the rows, so that no text is shuffled.
    """
    judged = _verdicts(with_counts(docs, text_col))
    # one condition over both sides of the join: a part of its own would be pushed below it, and count once more
    kept = F.when(_base_failed(F.col("_q")), F.lit(False)).otherwise(F.col("_q_posterior") >= 0.5)
    return judged.filter(kept).select(*docs.columns)
