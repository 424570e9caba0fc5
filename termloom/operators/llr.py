"""Log-likelihood ratio of terms per user (Dunning 1993).

Assumptions where the literature leaves a choice:

* the universe is all terms of all lengths together (``per_length=True`` scores
  words, pairs, ... among themselves);
* the score is the plain two-sided G2 (``direction="over"`` keeps only terms the
  user has more often than expected);
* ties are broken by the term, ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import num_words
from ..staging import stage, stage_bucketed
from .rank import top_n_per_group

MIN_SCORE = 1.0
MAX_TERMS = 20

# A key is cut into pieces if it has more than 1/SHARE of all rows and enough rows
# to keep one task busy.
SHARE = 500
PIECE_ROWS = 1_000_000

# terms that a user has this often are few, and most users' best terms are among them. A user
# with fewer of them has not many rows to sort
FREQUENT = 8
MANY_FREQUENT = 2_000


def term_counts(terms: DataFrame) -> DataFrame:
    """Occurrences ``k11`` per (user, term)."""
    return terms.groupBy("email", "term").agg(F.count(F.lit(1)).alias("k11"))


def key_totals(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Sum of ``k11`` per key as ``name`` and the number of rows ``n_rows`` with it."""
    return counts.groupBy(*keys).agg(F.sum("k11").alias(name), F.count(F.lit(1)).alias("n_rows"))


def attach_totals(
    counts: DataFrame,
    totals: DataFrame,
    keys: list[str],
    name: str,
    spread_by: str,
    share: int = SHARE,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Join a per-key total to every row without gathering a hot key in one task.

    ``totals`` is a stored table, so its largest key can be looked up now. Usually
    no key is hot and this is a plain join without any hint: Spark broadcasts the
    totals if they turn out to be small, and shuffles otherwise.

    A key is hot if it has more than ``1/share`` of all rows. There are fewer than
    ``share`` such keys, so the list of them that is broadcast is bounded however
    large the data. Keys of up to ``piece_rows`` rows are never cut. Rows of a hot key get
    a piece number from a hash of
    ``spread_by`` and the key's total is repeated once per piece; all other keys
    are one piece.
    """
    all_rows, largest = totals.agg(F.sum("n_rows"), F.max("n_rows")).first()
    piece_rows = max(piece_rows, -(-(all_rows or 0) // share))
    if (largest or 0) <= piece_rows:
        return counts.join(totals.drop("n_rows"), keys)
    sized = totals.withColumn("_pieces", F.ceil(F.col("n_rows") / F.lit(piece_rows)).cast("int"))
    hot = sized.filter(F.col("n_rows") > piece_rows).select(*keys, "_pieces")
    in_pieces = counts.join(F.broadcast(hot), keys, "left").withColumn(
        "_piece", F.coalesce(F.pmod(F.hash(spread_by), F.col("_pieces")), F.lit(0))
    )
    repeated = sized.select(
        *keys, name, F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_piece")
    )
    return in_pieces.join(repeated, [*keys, "_piece"]).drop("_piece", "_pieces")


# for g2: products below this are whole numbers of 64 bits, with room for the rounding of a double
MOST_IN_LONGS = 9e18


def g2(k11: Column, term_total: Column, user_total: Column, grand_total: Column) -> Column:
    """G2 of the 2x2 table of one term and one user; operands are whole numbers whose products have 38 digits at most.

    Each cell's ``k * ln(k * n / (row * column))`` is ``k * log1p(+-d / (row * column))`` with
    the same ``d = k11 * n - row * column``, which is made exactly. The plain form subtracts
    numbers that agree in most digits once the table is large.
    """
    totals = k11, term_total, user_total, grand_total

    def deviation_as(kind: str) -> Column:
        k, r, c, n = (x.cast(kind) for x in totals)
        return (k * n - r * c).cast("double")

    k11, row, col, n = (c.cast("double") for c in totals)
    # decimals cost many times as much as longs, which hold most products
    in_longs = F.greatest(k11 * n, row * col) < MOST_IN_LONGS
    d = F.when(in_longs, deviation_as("long")).otherwise(deviation_as("decimal(38,0)"))

    def part(k: Column, deviation: Column, row_sum: Column, col_sum: Column) -> Column:
        # an empty cell adds nothing, and may have no sums to divide by. Without a condition
        # around it the deviation is made once for all four cells
        return F.coalesce(k * F.log1p(F.try_divide(deviation, row_sum * col_sum)), F.lit(0.0))

    return F.lit(2.0) * (
        part(k11, d, row, col)
        + part(row - k11, -d, row, n - col)
        + part(col - k11, -d, n - row, col)
        + part(n - row - col + k11, d, n - row, n - col)
    )


def g2_bound(k11: Column, term_total: Column, least: Column, most: Column, grand_total: Column) -> Column:
    """The largest G2 that a user of ``least`` to ``most`` terms can have with this count and term.

    With the count and both other totals fixed, G2 falls while the user's total rises to
    where the term is as frequent as with all users, and rises from there on. So it is largest
    at one of the ends; what the table allows cuts them off.
    """
    fewest = F.greatest(k11, least)
    ends = fewest, F.greatest(fewest, F.least(most, grand_total - term_total + k11))
    return F.greatest(*(g2(k11, term_total, end, grand_total) for end in ends))


# for rounding: bounds that come this close to a score are taken to reach it
SLACK = 1e-6


def can_reach(score: float | Column, bound: Column) -> Column:
    return bound * (1 + SLACK) + SLACK >= score


def llr_scores(
    counts: DataFrame,
    per_length: bool = False,
    direction: str = "both",
    staged: bool = False,
    share: int = SHARE,
    piece_rows: int = PIECE_ROWS,
    buckets: int | None = None,
    prune_below: float | None = None,
) -> DataFrame:
    """Score of every (user, term): columns email, term, k11, score.

    ``counts`` is read several times; unless the caller says that it is a stored
    table already (``staged=True``) it is written to the shared folder first. If it has the
    ``term_total`` of every row, no totals of terms are made and joined.
    ``share`` and ``piece_rows`` say which keys are cut; see :func:`attach_totals`.

    ``buckets`` writes the counts in that many buckets by term: they meet their term totals
    where they lie, and only move for the totals of the users. ``prune_below`` leaves out rows
    that cannot reach this score whoever their user is, before they move.
    """
    if direction not in ("both", "over"):
        raise ValueError(f"unknown direction {direction!r}")
    if buckets:
        counts = stage_bucketed(counts, "term-counts", ["term"], buckets)
    elif not staged:
        counts = stage(counts, "term-counts")
    universe = []
    if per_length:
        counts = counts.withColumn("n_words", num_words("term"))
        universe = ["n_words"]
    user_totals = stage(key_totals(counts, ["email", *universe], "user_total"), "user-totals")
    if "term_total" in counts.columns:
        rows = counts
    else:
        term_totals = key_totals(counts, ["term"], "term_total")
        if not buckets:
            term_totals = stage(term_totals, "term-totals")
        rows = attach_totals(counts, term_totals, ["term"], "term_total", "email", share, piece_rows)
    of_users = F.sum("user_total").alias("grand_total"), F.min("user_total").alias("least"), F.max("user_total").alias("most")
    if universe:
        # broadcast: one row per term length
        grand = user_totals.groupBy(*universe).agg(*of_users)
        rows = rows.join(F.broadcast(grand), universe)
    else:
        # one row of a stored table: as constants it needs no join, and no condition of one
        whole = user_totals.agg(*of_users).first()
        rows = rows.select("*", *(F.lit(whole[c] or 0).cast("long").alias(c) for c in ("grand_total", "least", "most")))
    if prune_below is not None:
        bound = g2_bound(*(F.col(c) for c in ("k11", "term_total", "least", "most", "grand_total")))
        rows = rows.filter(can_reach(prune_below, bound))
    rows = attach_totals(rows, user_totals, ["email", *universe], "user_total", "term", share, piece_rows)
    if direction == "over":
        expected = F.col("term_total").cast("double") * F.col("user_total").cast("double")
        rows = rows.filter(F.col("k11").cast("double") * F.col("grand_total").cast("double") > expected)
    score = g2(F.col("k11"), F.col("term_total"), F.col("user_total"), F.col("grand_total"))
    return rows.select("email", "term", "k11", score.alias("score"))


def reaching_bars(
    scores: DataFrame,
    counts: DataFrame,
    best_first: list[Column],
    n: int,
    limit_in_tasks: int | None = None,
    many: int = MANY_FREQUENT,
) -> DataFrame:
    """Scores without those that ``n`` of the same user's frequent terms surpass: they need not be sorted.

    For ``counts`` that need no shuffle to be scored, as they are scored twice, the first time only
    the few that are frequent. Only users with ``many`` of these get a bar, so the list of
    bars is short and can be broadcast: a user with very many rows is not gathered in one task.
    """
    is_frequent = F.col("k11") >= FREQUENT
    of_users = counts.filter(is_frequent).groupBy("email").agg(F.count(F.lit(1)).alias("_n"))
    frequent = scores.filter(is_frequent).select("email", "term", "score")
    best = top_n_per_group(frequent, ["email"], best_first, n, "term", limit_in_tasks)
    bars = best.groupBy("email").agg(F.count(F.lit(1)).alias("_best"), F.min("score").alias("_bar"))
    bars = bars.join(of_users.filter(F.col("_n") >= many), "email").filter(F.col("_best") >= n)
    bars = stage(bars.select("email", "_bar"), "bars")
    reach = F.col("_bar").isNull() | can_reach(F.col("_bar"), F.col("score"))
    return scores.join(F.broadcast(bars), "email", "left").filter(reach).drop("_bar")


def top_terms_by_llr(
    counts: DataFrame,
    max_terms: int = MAX_TERMS,
    min_score: float = MIN_SCORE,
    predicate: Column | None = None,
    limit_in_tasks: int | None = None,
    prune: bool = False,
    **options,
) -> DataFrame:
    """The best terms of every user: email, term, score.

    ``predicate`` is an extra condition on ``term`` and ``score``. ``limit_in_tasks`` is for
    long lists; see :func:`top_n_per_group`. ``prune`` drops rows that cannot reach
    ``min_score`` before they are joined with their users; it pays for high scores.
    """
    with_bars = "term_total" in counts.columns and not options.get("buckets")
    if with_bars and not options.get("staged"):
        counts, options = stage(counts, "term-counts"), {**options, "staged": True}
    scores = llr_scores(counts, prune_below=min_score if prune else None, **options)
    if predicate is not None:
        scores = scores.filter(predicate)
    best_first = [F.desc("score"), F.asc("term")]
    if with_bars:
        scores = reaching_bars(scores, counts, best_first, max_terms, limit_in_tasks)
    scores = scores.select("email", "term", "score")
    # the limit comes first: the best are the same, and a condition on the score would be pushed
    # below its projection and compute it twice
    best = top_n_per_group(scores, ["email"], best_first, max_terms, "term", limit_in_tasks)
    return best.filter(F.col("score") >= min_score)
