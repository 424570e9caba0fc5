import hashlib

import numpy as np
import pyarrow as pa
import pytest

from termloom.llm.repeats import (
    GRAM,
    LEAST,
    PIECE,
    SLICE,
    WIDTHS,
    Anchors,
    _in_parts,
    _packed,
    _unpacked,
    drop_repeats,
    intervals,
    repeat_groups,
    repeats,
)


def brute(rows):
    """(id, bytes, removed, spans, digest) by a table of all windows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for at in range(len(t) - LEAST + 1) if i is not None else ():
            w = t[at : at + LEAST]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for at in range(len(t) - LEAST + 1) if i is not None else ():
            if first[t[at : at + LEAST]] < i:
                gone[at + 1 : at + 1 + LEAST] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def some_texts():
    """Copies, cut copies, one common passage in different surroundings, runs of one sign, texts over few signs."""
    rng = np.random.default_rng(11)

    def noise(n, signs="abcdefgh ij\né中"):
        return "".join(signs[k] for k in rng.integers(0, len(signs), n))

    passage, line = noise(90), noise(50)
    rows = [(i, noise(30) + passage + noise(30)) for i in range(0, 60)]
    rows += [(i, noise(int(rng.integers(0, 9))) + line + "\n" + line[:49] + noise(60)) for i in range(60, 90)]
    base = noise(800)
    rows += [(i, base) for i in range(90, 100)]
    for i in range(100, 130):
        lo, hi = sorted(rng.integers(0, 800, 2).tolist())
        rows.append((i, noise(5) + base[lo:hi] + noise(5) + base[hi - 20 : hi + 200]))
    rows += [(i, "-" * int(rng.integers(40, 300))) for i in range(130, 138)]
    rows += [(i, "ab" * int(rng.integers(20, 100)) + noise(9, "ab")) for i in range(138, 146)]
    rows += [(i, noise(int(rng.integers(40, 300)), "a\x00")) for i in range(146, 200)]
    rows += [(i, "x" * 60 + "\x00" * k + "y") for i, k in enumerate(range(0, 12), 200)]
    return [rows[k] for k in rng.permutation(len(rows))]


@pytest.mark.parametrize("bucket", [10_000, 3])
def test_same_as_all_windows(spark, bucket):
    rows = some_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert digests(drop_repeats(df, bucket=bucket)) == brute(rows)


def test_kept_texts_are_what_is_left(spark):
    rows = [(1, "q" * 10 + "w" * 50), (2, "start " + "w" * 50 + " end"), (3, "w" * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in drop_repeats(df, with_text=True).collect()}
    assert got == {1: rows[0][1].encode(), 2: b"start  end", 3: b"w" * 49}


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = drop_repeats(odd)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert digests(got) == brute(rows)
    assert drop_repeats(none).count() == 0
    assert repeat_groups(none).count() == 0


def test_very_long_text(spark):
    rng = np.random.default_rng(2)
    body = "".join(map(chr, rng.integers(97, 123, SLICE + 300_000)))
    rows = [(1, body), (2, "zz" + body[SLICE - 500 : SLICE + 700]), (3, body[:200] + body[-200:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in drop_repeats(df).collect()}
    assert got == {1: (0, 0), 2: (1200, 1), 3: (400, 1)}


def test_repeat_groups_have_all_occurrences(spark):
    rows = some_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {i: t.encode() for i, t in rows}
    found = {}
    for r in repeat_groups(df).collect():
        string = bytes(r.string)
        assert LEAST <= r.length == len(string) <= PIECE
        assert texts[r.doc_id][r.start : r.start + r.length] == string
        found.setdefault(string, set()).add((r.doc_id, r.start))
    assert all(len({i for i, _ in places}) > 1 for places in found.values())
    # any window that two documents share lies in a repeat of both
    covered = {(i, at) for s, places in found.items() for i, start in places for at in range(start, start + len(s) - LEAST + 1)}
    where = {}
    for i, t in texts.items():
        for at in range(len(t) - LEAST + 1):
            where.setdefault(t[at : at + LEAST], []).append((i, at))
    shared = {p for places in where.values() if len({i for i, _ in places}) > 1 for p in places}
    assert shared <= covered


def test_interval_tree_lists_maximal_repeats():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pieces = sorted({bytes(rng.integers(97, 99, int(rng.integers(5, 14))).astype(np.uint8)) for _ in range(12)})
        got = {}
        for length, which, offset in repeats(pieces, np.zeros(len(pieces), int), least=5):
            string = pieces[which[0]][offset[0] : offset[0] + length]
            got[string] = set(zip(which.tolist(), offset.tolist()))
        want = {}
        for k, p in enumerate(pieces):
            for lo in range(len(p)):
                for hi in range(lo + 5, len(p) + 1):
                    want.setdefault(p[lo:hi], set()).add((k, lo))

        def extended(places, string):
            after = {pieces[k][at + len(string) : at + len(string) + 1] for k, at in places}
            before = {pieces[k][at - 1 : at] if at else b"" for k, at in places}
            return len(after) > 1 or after == {b""}, len(before) > 1 or before == {b""} or b"" in before

        maximal = {s: p for s, p in want.items() if len(p) > 1 and all(extended(p, s))}
        assert got == maximal


def test_intervals_by_stack():
    lcp = np.array([0, 3, 5, 5, 3, 0, 4])
    assert sorted(intervals(lcp, 3)) == [(3, 1, 5), (4, 6, 7), (5, 2, 4)]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(9)
    anchors = Anchors()
    shared = bytes(rng.integers(0, 256, LEAST).astype(np.uint8))
    found = set()
    for pad in range(0, 120, 7):
        text = bytes(rng.integers(0, 256, pad).astype(np.uint8)) + shared + bytes(rng.integers(0, 256, 30).astype(np.uint8))
        for _, start, n, key in anchors.pieces([text]):
            at = np.flatnonzero((start <= pad) & (pad < start + n))
            found.add(int(key[at[0]]))
    assert len(found) == 1 and GRAM < LEAST


def test_windows_of_crowded_groups_are_all_found(spark):
    rows = some_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {i: t.encode() for i, t in rows}
    where, covered = {}, set()
    for i, t in texts.items():
        for at in range(len(t) - LEAST + 1):
            where.setdefault(t[at : at + LEAST], []).append((i, at))
    shared = {p for places in where.values() if len({i for i, _ in places}) > 1 for p in places}
    for r in repeat_groups(df, bucket=3).collect():
        assert texts[r.doc_id][r.start : r.start + r.length] == bytes(r.string)
        covered |= {(r.doc_id, at) for at in range(r.start, r.start + r.length - LEAST + 1)}
    assert covered == shared


def test_crowded_pieces_have_two_parts_at_most():
    rng = np.random.default_rng(5)
    gram = bytes(rng.integers(0, 256, GRAM).astype(np.uint8))
    noise = lambda n: bytes(rng.integers(97, 99, n).astype(np.uint8))
    texts = [noise(30) + gram + noise(30) for _ in range(300)]
    anchors, pieces = Anchors(), []
    for text, start, n, _ in anchors.pieces(texts):
        pieces += [texts[i][s : s + k + LEAST - 1] for i, s, k in zip(text.tolist(), start.tolist(), n.tolist(), strict=True)]
    numbers = pa.array(range(len(pieces)), pa.int64())
    batch = pa.RecordBatch.from_arrays([numbers, numbers, numbers, pa.array(pieces, pa.binary())], ["a", "pid", "least", "piece"])
    for width in WIDTHS:
        met, windows = {}, [0] * len(pieces)
        for out in _in_parts(width)(iter([batch])):
            for r in out.to_pylist():
                assert r["piece"] == pieces[r["owner"]][r["at"] : r["at"] + r["n"] + LEAST - 1]
                windows[r["owner"]] += r["n"]
                for k in range(r["n"]):
                    met.setdefault(r["piece"][k : k + LEAST], set()).add(r["a"])
            if width == WIDTHS[0]:
                assert out.num_rows <= 2 * len(pieces)
        assert windows == [len(p) - LEAST + 1 for p in pieces]  # every window is in one part
        assert all(len(keys) == 1 for keys in met.values())  # and equal windows are in parts that meet


def test_posts_are_packed_whole():
    rng = np.random.default_rng(6)
    tables = [[rng.integers(-(2**63), 2**63 - 1, n) for _ in range(3)] for n in (1, 7, 300)]
    for got, want in zip(_unpacked([_packed(t) for t in tables], 3), zip(*tables, strict=True), strict=True):
        assert np.array_equal(got, np.concatenate(want))
