import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm.divergence import COLUMNS, ROWS, Tree, build, divergence, smoothed, walk


def brute(rows, top=200, least=3):
    """The audit over a dense matrix; rows are (lang, source, text)."""
    words = [(g or "", s or "", re.findall(rb"[a-z\x80-\xff]+", (t or "").encode().lower())) for g, s, t in rows]
    out = set()
    for lang in {g for g, _, _ in words}:
        docs, total = Counter(), Counter()
        for g, _, w in words:
            if g == lang:
                docs.update(set(w))
                total.update(w)
        kept = sorted(t for t in docs if docs[t] >= least)
        counts = {s: Counter() for g, s, _ in words if g == lang}
        for g, s, w in words:
            if g == lang:
                counts[s].update(x for x in w if x in set(kept))

        def shares(c):
            n = sum(c[t] for t in kept) + len(kept)
            return [1 + 1_000_000_000 * (c[t] + 1) // n for t in kept]

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(total)
        for s in counts:
            pairs = [(-sum((x - y) ** 2 // y for x, y in zip(p[s], p[o])), o.encode()) for o in counts if o != s]
            out |= {(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(sorted(pairs))}
            terms = sorted(
                (-((x - y) ** 2 // y), t) for t, x, y in zip(kept, p[s], q) if counts[s][t] and x > y
            )[:top]
            out |= {(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(terms)}
    return out


def rows_of(df):
    got = [(r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("columns", [COLUMNS, 50])
def test_same_as_a_dense_matrix(spark, columns):
    rng = np.random.default_rng(3)
    vocabulary = ["Wort", "été", "x", "中文", *[f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]]
    # more groups than a tile has rows, one of them with a third of the rows
    rows = []
    for _ in range(900):
        lang = ["en", "de", "xx"][int(rng.choice(3, p=[0.8, 0.19, 0.01]))]
        source = f"s{int(rng.integers(0, ROWS + 9))}" if rng.random() < 0.66 else "hot"
        rows.append((lang, source, " ".join(vocabulary[int(v)] for v in rng.zipf(1.5, 12) % len(vocabulary)) + " ÀB-c1d"))
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    assert rows_of(divergence(df, columns=columns)) == brute(rows)


def test_odd_rows(spark, odd, none):
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert rows_of(divergence(odd)) == brute(rows)
    wanted = [(None, None, "a b c"), (None, "s", None), ("", "s", "a b"), ("", "t", "A"), ("q", "s", "only"), ("q", "t", "")]
    df = spark.createDataFrame(wanted, "lang string, source string, text string").withColumn("rank", F.lit("odd"))
    got = rows_of(divergence(df))
    assert got == brute(wanted)
    # a language without kept terms still has its pairs, of value 0
    assert ("q", "s", "pair", "t", 0, 1) in got
    assert divergence(none).count() == 0


def test_tree_holds_its_cells():
    rng = np.random.default_rng(1)
    dense = rng.poisson(0.02, (ROWS, 700))
    r, c = np.nonzero(dense)
    tree = Tree(*build(r, c, dense[r, c]))
    assert sorted(zip(tree.rows, tree.counts)) == sorted(zip(r, dense[r, c]))
    totals = dense.sum(1) + 700
    forth, back, cells = walk(tree, None, totals, totals[:3], False)
    p = smoothed(dense.ravel(), np.repeat(totals, 700)).reshape(dense.shape)
    q = smoothed(np.zeros(3, np.int64), totals[:3])
    for i, j in [(0, 0), (5, 2), (63, 1)]:
        at = dense[i] > 0
        assert cells[i, j] == at.sum()
        assert forth[i, j] == ((p[i][at] - q[j]) ** 2 // q[j]).sum()
        assert back[i, j] == ((p[i][at] - q[j]) ** 2 // p[i][at]).sum()


def test_long_division_is_exact():
    counts, totals = np.array([0, 6, 10**15, 2**53 - 2]), np.array([7, 7, 2**53 - 1, 2**53 - 1])
    assert smoothed(counts, totals).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(counts.tolist(), totals.tolist())]
