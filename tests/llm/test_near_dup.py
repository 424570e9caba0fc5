import re
from fractions import Fraction

import numpy as np
import pytest

from termloom.llm.graph import components
from termloom.llm.hashing import SLICE, WordHasher, shingles
from termloom.llm.near_dup import drop_near_duplicates, match_threshold, near_duplicates


def sets_of(texts, n):
    out = {}
    for k, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out[k] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] * bool(w))
    return out


def brute(texts, n, num, den):
    """Smallest reachable id of each document, over all pairs."""
    sets = sets_of(texts, n)
    ids = sorted(sets)
    comp = {k: k for k in ids}

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {k: (len(sets[k]), find(k)) for k in ids}


@pytest.mark.parametrize(("n", "similarity"), [(3, Fraction(85, 100)), (5, Fraction(4, 5))])
def test_same_groups_as_all_pairs(documents, texts, n, similarity):
    want = brute(texts, n, similarity.numerator, similarity.denominator)
    # small blocks, so that lists and families are cut
    got = near_duplicates(documents, shingle_words=n, similarity=similarity, block_rows=3, block_shingles=500).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_family_of_small_edits(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    texts = {}
    for k in range(150):
        own = list(words)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            own[at] = f"x{k}_{at}"
        texts[k] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = near_duplicates(df, shingle_words=3, similarity=Fraction(85, 100), block_rows=40, block_shingles=2_000)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(texts, 3, 85, 100)


def test_odd_rows(odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {(r.doc_id, r.n_shingles): r for r in rows}
    for k in (1, 2, 3):
        assert by[k, 0].kept and by[k, 0].component_id == k
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert {r.component_id for r in rows if r.doc_id in (7, 8) and r.n_shingles < 20 and r.n_shingles > 9} == {7}
    alone = next(r for r in rows if r.doc_id is None)
    assert alone.component_id is None and alone.kept
    assert near_duplicates(none).collect() == []


def test_one_of_each_group_stays(odd, none):
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.filter("doc_id in (5, 6)").count() == 1
    assert sorted(r.doc_id or 0 for r in kept.filter("doc_id is null or doc_id < 5").collect()) == [0, 1, 2, 3, 4]
    assert drop_near_duplicates(none).columns == odd.columns


A, B = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau " * 3, " ".join(f"w{i}" for i in range(99)))


def test_repeated_and_missing_ids_lose_no_text(spark):
    c, d = " ".join(f"c{i}" for i in range(99)), " ".join(f"d{i}" for i in range(99))
    rows = [(7, A), (8, A + "tail"), (8, B), (9, B + " more"), (None, c), (None, c + " end"), (None, d), (3, d + " and"), (3, "x y"), (3, "X  y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    want = [(7, 7, True), (8, 7, False), (8, 8, True), (9, 8, False)]
    want += [(None, None, True)] * 2 + [(None, 3, False), (3, 3, True), (3, 3, True), (3, 3, True)]
    assert got == sorted(want, key=str)
    kept = [(r.doc_id, r.text) for r in drop_near_duplicates(df).collect()]
    assert sorted(k for k in kept if k[0] in (7, 8, 9)) == [(7, A), (8, B)]
    # the rows without an id: one of the near copies stays, the copy of a row with an id goes
    assert [t for i, t in kept if i is None and t.startswith("d")] == [] and (3, d + " and") in kept
    assert len([t for i, t in kept if i is None]) == 1
    assert len([t for i, t in kept if i == 3]) == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (5, 5), (None, 3)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_of_long_texts():
    hasher = WordHasher()
    long = "Ab cé " * (SLICE // 3)
    found = dict(hasher.of_texts(["Ab cé", None, long, "", "cé ab"]))
    assert len(found[1]) == len(found[3]) == 0
    assert len(found[2]) == 2 * (SLICE // 3) and set(found[2]) == set(found[0])
    assert (found[4] == found[0][::-1]).all()
    assert len(shingles(found[0], 5)) == 1 and len(shingles(found[1], 5)) == 0


def test_match_threshold_bounds_the_misses():
    assert 1 <= match_threshold(48, Fraction(4, 5), 1e-6) < match_threshold(48, Fraction(85, 100), 1e-6) < 48
    assert match_threshold(48, Fraction(1), 1e-6) == 48
