"""Terms of several words, counted in columns: the same counts, totals and best terms as row by row."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termloom.operators import counting, llr
from termloom.operators.counting import counted_terms
from termloom.operators.terms import PIECE_WORDS, user_terms
from termloom.plans.top_terms import top_terms_of

PIECES = "email string, context int, words array<string>"
WORDS = ["tree", "house", "é", "", "a b", "ゃ" * 9, None]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_pieces(n, seed):
    rng = random.Random(seed)
    return [
        (rng.choice(["u", "v", None, "ü"]), rng.choice([0, 0, 2]), rng.choices(WORDS, k=rng.randrange(12)))
        for _ in range(n)
    ]


def by_hand(pieces, size):
    found = Counter()
    for email, context, words in pieces:
        for end in range(context, len(words)):
            for k in range(1, size + 1):
                gram = words[end - k + 1 : end + 1] if end >= k - 1 else [None]
                if None not in gram:
                    found[email, " ".join(gram)] += 1
    totals = Counter()
    for (_, term), n in found.items():
        totals[term] += n
    return {(email, term, n, totals[term]) for (email, term), n in found.items()}


@pytest.mark.parametrize("size", [2, 3, 5])
def test_counts_in_columns(spark, monkeypatch, size):
    # many chunks, groups and batches
    monkeypatch.setattr(counting, "CHUNK_WORDS", 100)
    monkeypatch.setattr(counting, "PIECES", 3)
    monkeypatch.setattr(counting, "GROUP_ROWS", 20)
    monkeypatch.setattr(counting, "BATCH_ROWS", 7)
    pieces = random_pieces(300, size) + [("u", 0, None), ("w", 0, [])]
    df = spark.createDataFrame(pieces, PIECES).repartition(3)
    found = [tuple(r) for r in counted_terms(df, size).collect()]
    want = by_hand([p for p in pieces if p[2] is not None], size)
    assert len(found) == len(want) and set(found) == want


def test_terms_of_very_many_users(spark, monkeypatch):
    monkeypatch.setattr(counting, "BUCKETS", 64)
    pieces = [(f"u{i}", 0, ["common", f"w{i % 50}", "common"]) for i in range(400)]
    df = spark.createDataFrame(pieces, PIECES)
    found = counted_terms(df, 2, share=50, piece_rows=40)
    assert "Join" in plan(found)
    assert sorted(tuple(r) for r in found.collect()) == sorted(by_hand(pieces, 2))


def test_no_words_at_all(spark):
    assert counted_terms(spark.createDataFrame([], PIECES), 3).count() == 0
    assert counted_terms(spark.createDataFrame([("u", 0, [None, None])], PIECES), 3).count() == 0


def test_numbers_of_grams_are_made_dense(monkeypatch):
    pieces = pa.RecordBatch.from_pylist(
        [dict(zip(("email", "context", "words"), p, strict=True)) for p in random_pieces(200, 9)],
        pa.schema([("email", pa.string()), ("context", pa.int32()), ("words", pa.list_(pa.string()))]),
    )

    def counts():
        parts = list(counting._count_parts([pieces], 5))
        return Counter(tuple(r.values()) for b in counting._sum_parts(parts) for r in b.to_pylist())

    plain = counts()
    monkeypatch.setattr(counting, "MOST_IDS", 1)
    assert counts() == plain and len(plain) > 500


def test_buckets_follow_from_the_string():
    words = pa.array(["ab", "", "c", "ab c", "c "], pa.large_binary())
    codes = [[0, 2], [3], [0], [4, 1], [4], [2, 1, 1]]
    values = [counting._buckets([counting.np.array([c]) for c in code], *counting._hashes(words))[0] for code in codes]
    # "ab c" and "c  " are spelled twice each
    assert values[0] == values[1] and values[3] == values[5]
    assert len({values[0], values[2], values[3], values[4]}) == 4


def texts(spark):
    rng = random.Random(11)
    some = [f"word{i}" for i in range(30)] + ["the", "of"]
    rows = [(f"u{i % 5}", " ".join(rng.choices(some, k=rng.choice([0, 5, 300, PIECE_WORDS + 2])))) for i in range(60)]
    return spark.createDataFrame(rows, "email string, content string")


def test_long_terms_meet_no_joined_totals(spark):
    # fails for counts as rows: their totals are joined by term, after a shuffle of all pairs
    docs = texts(spark)
    top = top_terms_of(docs, shingle_size=3, stopwords=["the"], stem=False)
    assert "SortMergeJoin [term" not in plan(top) and "hashpartitioning(term" not in plan(top)
    terms = user_terms(docs, shingle_size=3, stopwords=["the"], stem=False)
    rows = llr.top_terms_by_llr(llr.term_counts(terms)).collect()
    assert sorted((r.email, r.term, r.score) for r in rows) == sorted((r.email, r.term, r.score) for r in top.collect())


def test_bars_keep_all_of_the_best(spark):
    # ties at the bar, a user with few frequent terms, and rare terms that surpass the frequent ones
    rows = [("a", f"t{i:02}", 8 + i % 3, float(i // 4)) for i in range(40)] + [("a", "rare", 1, 9.0), ("b", "x", 9, 1.0)]
    rows += [("b", f"r{i}", 1, 0.5) for i in range(9)] + [("c", "y", 1, math.pi)]
    scores = spark.createDataFrame(rows, "email string, term string, k11 long, score double")
    best_first = [F.desc("score"), F.asc("term")]
    kept = llr.reaching_bars(scores, scores, best_first, 6, many=2).select("email", "term", "score")
    best, plain = (llr.top_n_per_group(s.select("email", "term", "score"), ["email"], best_first, 6, "term") for s in (kept, scores))
    assert sorted(best.collect()) == sorted(plain.collect())
    assert kept.filter("email = 'a'").count() < 20 and "BroadcastHashJoin [email" in plan(kept)
    assert llr.reaching_bars(scores, scores, best_first, 6).count() == len(rows)


def test_pieces_are_for_long_terms_only(spark):
    docs = texts(spark)
    for options in ({}, {"shingle_size": 2, "once": True}, {"shingle_size": 2, "mark_docs": True}):
        with pytest.raises(ValueError):
            user_terms(docs, in_pieces=True, **options)
