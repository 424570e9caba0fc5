"""Sharding, quality and licences: DataFrame functions against plain Python."""

import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter

from pyspark.sql import functions as F

from termloom.llm.licenses import TEMPLATES, scan_licenses, whole_texts
from termloom.llm.quality import COUNTS, drop_low_quality, quality
from termloom.llm.sharding import shard_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return not re.search("Python|Pandas|Arrow(?!Eval)", plan)


def winner(key, weights):
    def bid(s, w):
        u = (int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / w

    return min((bid(s, w), s) for s, w in enumerate(weights) if w > 0)[1]


def test_shards(documents, texts):
    weights = [1.0, 2.0, 0.0, 1.0]
    df = shard_rows(documents, weights, rows_per_piece=5)
    rows = df.collect()
    assert no_python(df)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == winner(r.doc_id, weights)
        assert r.grown_shard == winner(r.doc_id, [*weights, 1.0])
        assert r.grown_shard in (r.shard, 4)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_shards_of_odd_rows(odd, none):
    rows = shard_rows(odd, [1.0] * 3, rows_per_piece=1).collect()
    assert len(rows) == odd.count()
    assert next(r for r in rows if r.doc_id == 1)[1:3] == (8, 0)
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 8}) == 1
    assert shard_rows(none, [1.0]).collect() == []


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_labels(spark, documents, texts):
    df = quality(documents)
    rows = {r.doc_id: r for r in df.collect()}
    assert no_python(df)
    for k, t in texts.items():
        n = counts(t)
        assert tuple(rows[k][c] for c in COUNTS) == n
        assert rows[k].base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (rows[k].base_failed and rows[k].kept)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    judged = judged.filter("not base_failed").groupBy().agg(F.avg(((F.col("quality") == 1) == F.col("kept")).cast("int")))
    assert judged.first()[0] > 0.97


def test_quality_of_odd_rows(odd, none):
    rows = quality(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert tuple(r[c] for c in COUNTS) == (0, 0, 0, 0, 0)
        if r.doc_id == 7:
            assert r.n_repeat_words == r.n_words and not r.kept
    assert drop_low_quality(odd).columns == odd.columns and drop_low_quality(odd).count() == 0
    assert quality(none).collect() == [] and drop_low_quality(none).collect() == []


def test_repeats_at_both_ends(spark):
    a, b = " ".join(f"a{i}" for i in range(8)), " ".join(f"b{i}" for i in range(12))
    texts = {1: f"{a} {b} {a}", 2: f"{a} {a}", 3: " ".join(["x"] * 9), 4: " ".join(["x"] * 8), 5: f"{a}\n{a}\n\n{a}"}
    rows = quality(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in rows} == {k: counts(t) for k, t in texts.items()}


def best_license(text, threshold=0.8):
    def grams(t):
        w = re.sub(r"[\W_]+", " ", t.lower()).strip().split(" ")
        return set(zip(w, w[1:], strict=False)) if len(w) > 1 else {(w[0],)}

    known = [(name, grams(t)) for name, ts in TEMPLATES.items() for t in ts]
    hits = []
    for i, line in enumerate((text or "").split("\n")):
        g = grams(line)
        best = min((-2 * len(g & t) / (len(g) + len(t)), name) for name, t in known)
        if best[0] <= -threshold:
            hits.append((*best, i))
    return (len(hits), *((min(hits)[1], round(-min(hits)[0], 6), min(hits)[2]) if hits else (None, None, None)))


def test_licenses(spark, texts):
    extra = {
        10_001: "RELEASED under -- the MIT license!\nreleased under the MIT License",
        10_002: "Licensed under the Apache License, Version 2.1.",
        10_003: TEMPLATES["ISC"][0] + "\nx",
        10_004: "This work is licensed under the GNU General Public License, version 3. It is.",
    }
    rows = {**texts, **extra}
    df = scan_licenses(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    assert no_python(df)
    got = {r.doc_id: (r.n_hits, r.license, r.dice, r.line) for r in df.collect()}
    assert got == {k: best_license(t) for k, t in rows.items()}
    assert got[10_001][:2] == (2, "MIT")


def test_licenses_of_odd_rows(odd, none):
    rows = scan_licenses(odd).collect()
    assert len(rows) == odd.count() and all(r.n_hits == 0 and r.license is None for r in rows)
    assert {r.n_lines for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert scan_licenses(none).collect() == []
    assert all(r.n_hits == 0 for r in scan_licenses(odd, templates={}).collect())


def test_wrapped_and_whole_licenses(spark):
    whole = whole_texts()
    prose = "Some words of a readme, of the usual kind, that say nothing of the terms under which it may be used.\n" * 3
    one_line = lambda t: " ".join(t.split())
    wrapped = lambda t, n=72, **k: "\n".join(textwrap.wrap(one_line(t), n, **k))
    apache_header = next(t for t in whole["Apache-2.0"] if len(t) < 1000)
    dual = prose + wrapped(whole["MIT"][0]) + "\n\n" + prose + wrapped(apache_header) + "\n" + prose
    texts = {
        1: (wrapped(whole["MIT"][0]), "MIT", 1),
        2: (prose + wrapped(apache_header, initial_indent=" * ", subsequent_indent=" * ") + "\n" + prose, "Apache-2.0", 1),
        3: (max(whole["GPL-3.0"], key=len), "GPL-3.0", 1),
        4: (prose + max(whole["GPL-2.0"], key=len) + prose, "GPL-2.0", 1),
        5: (wrapped(whole["BSD-3-Clause"][0], 60), "BSD-3-Clause", 1),
        6: (one_line(whole["BSD-3-Clause"][0]), "BSD-3-Clause", 1),
        7: ("\n".join(map(one_line, whole["BSD-3-Clause"][0].split("\n\n"))), "BSD-3-Clause", 1),
        8: (whole["BSD-2-Clause"][0], "BSD-2-Clause", 1),
        9: (wrapped(TEMPLATES["GPL-2.0"][1]), "GPL-2.0", 1),
        10: (wrapped(TEMPLATES["CC-BY-4.0"][1], 40), "CC-BY-4.0", 1),
        11: (dual, "Apache-2.0", 2),
        12: (prose, None, 0),
        13: (wrapped(whole["ISC"][0].replace("THE AUTHOR", "SOME PEOPLE WHO WROTE IT")), "ISC", 1),
        14: ((prose + wrapped(whole["MIT"][0]) + "\n") * 2, "MIT", 2),
    }
    df = scan_licenses(spark.createDataFrame([(k, t[0]) for k, t in texts.items()], "doc_id long, text string"))
    assert no_python(df)
    rows = {r.doc_id: r for r in df.collect()}
    assert {k: (r.license, r.n_hits) for k, r in rows.items()} == {k: t[1:] for k, t in texts.items()}
    assert rows[2].line == 3 and rows[1].dice == rows[3].dice == rows[5].dice == 1.0 > rows[13].dice


def test_licenses_that_follow_each_other(spark):
    whole = whole_texts()
    mit, isc, bsd = (whole[name][0] for name in ("MIT", "ISC", "BSD-3-Clause"))
    apache = max(whole["Apache-2.0"], key=len)
    texts = [mit + "\n" + mit, mit + "\n\n" + apache, apache + "\n" + mit, isc + "\n" + bsd + "\n" + isc, mit.replace("\n", " ") * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [h.license for h in r.hits] for r in scan_licenses(df, all_hits=True).collect()}
    assert got == {
        0: ["MIT", "MIT"],
        1: ["MIT", "Apache-2.0"],
        2: ["Apache-2.0", "MIT"],
        3: ["ISC", "BSD-3-Clause", "ISC"],
        4: ["MIT"] * 3,
    }


def test_all_licenses_of_a_text(spark):
    text = "x\nReleased under the MIT License.\ny\n" + whole_texts()["ISC"][0]
    row = scan_licenses(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string"), all_hits=True).collect()
    assert [tuple(h) for h in row[0].hits] == [("MIT", 1.0, 1), ("ISC", 1.0, 3)] and row[1].hits == []
