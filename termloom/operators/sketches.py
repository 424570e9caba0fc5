"""Document frequency of archives that grow: distinct users per term as mergeable sketches.

A slice of the input (a day, a batch of files) leaves one sketch per term. Sketches of many
slices merge without reading the texts again, and a user who is in several slices counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**LG_K registers in a sketch
LG_K = 12
#: an estimate is off by more than so many standard errors once in a billion
ERRORS = 6.0


def relative_error(lg_k: int = LG_K) -> float:
    """The standard error of an estimate that was merged from sketches, as a share of the count."""
    return 1.04 / 2 ** (lg_k / 2)


def user_sketches(terms: DataFrame, slices: list[str], lg_k: int = LG_K, user: str = "email") -> DataFrame:
    """(term, slices, sketch): the users of every term in every slice.

    Spark keeps one sketch per term, slice and task before it shuffles, so a term that everybody
    uses costs one row a task. A null user is none.
    """
    return terms.groupBy("term", *slices).agg(F.hll_sketch_agg(F.col(user).cast("string"), lg_k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of several slices as one per term (and ``by``). Merging twice changes nothing."""
    return sketches.groupBy(*(["term"] if by is None else by)).agg(F.hll_union_agg("sketch", True).alias("sketch"))


def estimated_users(sketches: DataFrame) -> DataFrame:
    """(term, doc_count) of merged sketches."""
    return sketches.select("term", F.hll_sketch_estimate("sketch").alias("doc_count"))


def within_bound(estimate: Column, exact: Column, lg_k: int = LG_K, errors: float = ERRORS) -> Column:
    """Whether an estimate is as close as sketches of this size promise; small counts are off by less than one."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(errors * relative_error(lg_k)) * exact, F.lit(1.0))
