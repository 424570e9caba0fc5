"""How far the sources of a language diverge in their terms, from a K-squared tree of counts.

The matrix of a language has a row for each group (language, source) and a column for each
term that is kept; most of its cells are zero. It is cut into tiles of 64 rows and some
thousand columns, and each tile is a K-squared tree with K = 4: a node says by 16 bits which of
its 4 x 4 quadrants hold anything, down to single cells, whose counts are the leaves.

Two rows are compared by walking their trees together over the same columns. Where the
quadrants of both rows are uniform zeros, the walk stops: all cells there have one and the
same term of the sum, which is multiplied by their number. Where one is zero, its smallest
probability stands against the other's leaves. Only cells in which one of both rows has a
count are ever visited. All arithmetic is in whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.llr import attach_totals
from ..staging import stage
from .batches import small_batches
from .grouping import sorted_groups

K = 4
LEVELS = 3
ROWS = K**LEVELS
SCALE = 1_000_000_000
#: columns that are aimed at for a tile; hashing deals them, so tiles differ a little
COLUMNS = 8_192
#: terms of a language beyond which its rows are dealt over several tasks
PIECE_ROWS = 20_000
TOP_TERMS = 200
LEAST_DOCUMENTS = 3
#: counted terms that a task holds before it passes them on
HELD = 300_000
LONG_TEXT = 1 << 22
#: pairs of nodes that are walked together
AT_ONCE = 1 << 16

_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), summed up over many documents; an empty term marks a group."""
    names = ["lang", "source", "term", "n", "docs"]
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(terms) + 1)),
                    pa.array([source] * (len(terms) + 1)),
                    pa.array([b"", *terms], pa.binary()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs[t] for t in terms)], pa.int64()),
                ],
                names,
            )
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            text = text.lower()  # of bytes: A-Z alone
            if len(text) < LONG_TEXT:
                words = _TERM.findall(text)
                n.update(words)
                docs.update(set(words))
            else:
                own = Counter(m.group() for m in _TERM.finditer(text))
                n.update(own)
                docs.update(own.keys())
            size += len(n) - before
            if size > HELD:
                yield from out()
                size = 0
    yield from out()


def group_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs) of every group and term, with an empty term for every group."""
    small_batches(docs.sparkSession)
    lang, source, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col))
    rows = docs.select(lang.alias("lang"), source.alias("source"), text.cast("binary").alias("text"))
    found = rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# -- the tree -------------------------------------------------------------------------------


def build(rows: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(which strips of 64 columns hold anything, masks of the nodes level by level, counts of the leaves)."""
    code = columns >> (2 * LEVELS)
    for shift in range(2 * (LEVELS - 1), -1, -2):
        code = code << 4 | (rows >> shift & 3) << 2 | (columns >> shift & 3)
    order = np.argsort(code)
    code = code[order]
    strips = np.zeros(int(code[-1] >> 4 * LEVELS) + 1, bool)
    strips[code >> 4 * LEVELS] = True
    masks = []
    for level in range(1, LEVELS + 1):
        nodes = np.unique(code >> 4 * (LEVELS - level))
        first = np.flatnonzero(np.concatenate([[True], (nodes >> 4)[1:] != (nodes >> 4)[:-1]]))
        masks.append(np.bitwise_or.reduceat(1 << (nodes & 15), first))
    return np.packbits(strips).tobytes(), np.concatenate(masks).astype("<u2").tobytes(), counts[order].astype("<i8").tobytes()


class Tree:
    """A tile, unpacked: for every level the places of a node's quadrants in the next one, -1 for zeros."""

    def __init__(self, strips: bytes, masks: bytes, counts: bytes) -> None:
        bits = np.unpackbits(np.frombuffer(strips, np.uint8)).astype(bool)
        self.strips = np.where(bits, np.cumsum(bits) - 1, -1)
        all_masks, self.counts = np.frombuffer(masks, "<u2"), np.frombuffer(counts, "<i8")
        self.children, at, n = [], 0, int(bits.sum())
        rows = np.zeros(n, np.int64)
        for _ in range(LEVELS):
            held = (all_masks[at : at + n, None] >> np.arange(16, dtype=np.uint16) & 1).astype(bool)
            at += n
            node, child = np.nonzero(held)
            places = np.full(held.shape, -1, np.int64)
            places[node, child] = np.arange(len(node))
            self.children.append(places.reshape(-1, K, K))
            rows, n = rows[node] * K + (child >> 2), len(node)
        self.rows = rows


def smoothed(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), by long division in steps of 1000; totals below 2**53."""
    out, rest = np.zeros(len(counts), np.int64), counts + 1
    whole, rest = rest // total, rest % total
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return 1 + whole * SCALE + out


def _children(places: np.ndarray, node: np.ndarray) -> np.ndarray:
    if not len(places):
        return np.full((len(node), K, K), -1, np.int64)
    return np.where((node >= 0)[:, None, None], places[node], -1)


def walk(a: Tree | None, b: Tree | None, totals_a: np.ndarray, totals_b: np.ndarray, same: bool) -> tuple[np.ndarray, ...]:
    """Sums over the visited cells for every pair of a row of a and a row of b.

    Three matrices: the divergence of a's row from b's, that of b's from a's, and the number
    of cells. No tree: all zero. ``same``: only pairs of a row and a later one.
    """
    empty = Tree(b"", b"", b"")
    a, b = a or empty, b or empty
    na, nb = len(totals_a), len(totals_b)
    p_a, p_b = smoothed(a.counts, totals_a[a.rows]), smoothed(b.counts, totals_b[b.rows])
    zero_a, zero_b = smoothed(np.zeros(na, np.int64), totals_a), smoothed(np.zeros(nb, np.int64), totals_b)
    forth, back, cells = (np.zeros(na * nb, np.int64) for _ in range(3))
    width = max(len(a.strips), len(b.strips))
    roots = [np.concatenate([t.strips, np.full(width - len(t.strips), -1)]) for t in (a, b)]
    held = np.flatnonzero((roots[0] >= 0) | (roots[1] >= 0))
    open_pairs = [(0, roots[0][held], roots[1][held], np.zeros(len(held), np.int64), np.zeros(len(held), np.int64))]
    while open_pairs:
        level, ia, ib, ra, rb = open_pairs.pop()
        if len(ia) > AT_ONCE >> 4 and level < LEVELS:
            mid = len(ia) // 2
            open_pairs += [(level, *(x[cut] for x in (ia, ib, ra, rb))) for cut in (slice(mid), slice(mid, None))]
            continue
        if level == LEVELS:
            p = np.where(ia >= 0, p_a[ia] if len(p_a) else 0, zero_a[ra])
            q = np.where(ib >= 0, p_b[ib] if len(p_b) else 0, zero_b[rb])
            square, pair = (p - q) * (p - q), ra * nb + rb
            np.add.at(forth, pair, square // q)
            np.add.at(back, pair, square // p)
            np.add.at(cells, pair, 1)
            continue
        ca, cb = _children(a.children[level], ia), _children(b.children[level], ib)
        # quadrants of the same columns: (pair, row of a, row of b, column)
        shape = (len(ia), K, K, K)
        ca, cb = np.broadcast_to(ca[:, :, None, :], shape), np.broadcast_to(cb[:, None, :, :], shape)
        step = np.arange(K)
        next_a = np.broadcast_to((ra[:, None] * K + step)[:, :, None, None], shape)
        next_b = np.broadcast_to((rb[:, None] * K + step)[:, None, :, None], shape)
        below = K ** (LEVELS - 1 - level)
        keep = ((ca >= 0) | (cb >= 0)) & (next_a * below < na) & (next_b * below < nb)
        if same:
            # some row of b has to come after some row of a; single cells: itself
            keep &= next_b > next_a if below == 1 else next_b >= next_a
        open_pairs.append((level + 1, ca[keep], cb[keep], next_a[keep], next_b[keep]))
    return tuple(x.reshape(na, nb) for x in (forth, back, cells))


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in sorted_groups(batches, ["lang", "i", "block"]):
        r, c, n = (table.column(k).to_numpy() for k in ("r", "c", "n"))
        found = [build(r[lo:hi], c[lo:hi], n[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        heads = [table.column(k).take(pa.array(bounds[:-1])).combine_chunks() for k in ("lang", "i", "block")]
        yield pa.RecordBatch.from_arrays(
            [*heads, *(pa.array(x, pa.binary()) for x in zip(*found, strict=True))],
            ["lang", "i", "block", "strips", "masks", "counts"],
        )


_SUMS = "lang string, lo long, hi long, ra long, rb long, forth long, back long, cells long"


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _SUMS.split(", ")]
    for table, bounds in sorted_groups(batches, ["lang", "block", "lo", "hi"]):
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            rows = table.slice(lo, hi - lo).to_pylist()
            trees = {r["i"]: Tree(r["strips"], r["masks"], r["counts"]) for r in rows}
            head = rows[0]
            totals = [np.array(head[k], np.int64) for k in ("totals_lo", "totals_hi")]
            same = head["lo"] == head["hi"]
            sums = walk(trees.get(head["lo"]), trees.get(head["hi"]), *totals, same)
            ra, rb = np.nonzero(sums[2])
            n = len(ra)
            columns = [[head["lang"]] * n, [head["lo"]] * n, [head["hi"]] * n, ra, rb, *(x[ra, rb] for x in sums)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string() if k == "lang" else pa.int64()) for k, x in zip(names, columns, strict=True)], names
            )


# -- the audit ------------------------------------------------------------------------------


def _probability(count: Column, total: Column) -> Column:
    """The same as ``smoothed``, in decimals."""
    over = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, total.cast("decimal(19,0)")) + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    top_terms: int = TOP_TERMS,
    least_documents: int = LEAST_DOCUMENTS,
    columns: int = COLUMNS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (language, source).

    Part ``pair`` ranks the other sources of the language by the group's divergence from
    them, part ``term`` the terms that the group has oftener than the language. A term is
    kept in a language if at least ``least_documents`` of its documents have it.

    A null text, language or source is empty; a group without terms is compared like any
    other; a language without kept terms has pairs of value 0. Repeated rows count each
    time. Ties are ranked by the item. An empty table gives an empty table; other columns
    are not read. The pairs of sources of a language are the result, so it grows with the
    square of their number.
    """
    counts = stage(group_counts(docs, lang_col, source_col, text_col), "group-terms")
    per_lang = counts.filter("term <> X''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d"))
    kept = stage(per_lang.filter(F.col("d") >= least_documents).select("lang", "term", "lang_n"), "kept-terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    sizes = stage(sizes.withColumn("n_rows", F.col("v")), "languages")
    entries = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-counts")

    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_order = Window.partitionBy("lang").orderBy("source")
    groups = (
        counts.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes.drop("n_rows"), "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("v", F.lit(0)).alias("v"),
            # no kept terms: nothing is divided by it
            F.greatest(F.coalesce("total", F.lit(0)) + F.coalesce("v", F.lit(0)), F.lit(1)).alias("total"),
            F.greatest(F.coalesce("lang_total", F.lit(0)) + F.coalesce("v", F.lit(0)), F.lit(1)).alias("lang_total"),
            (F.row_number().over(in_order) - 1).cast("long").alias("row"),
        )
        .select("*", F.floor(F.col("row") / ROWS).alias("i"), (F.col("row") % ROWS).alias("r"))
    )
    groups = stage(groups, "groups")
    pairs = _pairs(entries, kept, sizes, groups, columns)
    p = _probability(F.col("n"), F.col("total"))
    q = _probability(F.col("lang_n"), F.col("lang_total"))
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("term"))
    terms = (
        entries.filter("n > 0")
        .join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
        .select("lang", "source", "term", p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select("lang", "source", "term", _divergence(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= top_terms)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    )
    return pairs.union(terms)


def _pairs(entries: DataFrame, kept: DataFrame, sizes: DataFrame, groups: DataFrame, columns: int) -> DataFrame:
    block = F.pmod(F.xxhash64("term"), F.greatest(F.ceil(F.col("v") / columns), F.lit(1)).cast("long"))
    in_block = Window.partitionBy("lang", "block").orderBy("term")
    # the largest language may hold most terms
    sized = attach_totals(kept, sizes.select("lang", "v", "n_rows"), ["lang"], "v", "term", piece_rows=PIECE_ROWS)
    places = sized.select("lang", "term", block.alias("block")).repartition("lang", "block").withColumn("c", (F.row_number().over(in_block) - 1).cast("long"))
    cells = (
        entries.filter("n > 0")
        .join(places, ["lang", "term"])
        .join(groups.select("lang", "source", "i", "r"), ["lang", "source"])
        .select("lang", "i", "block", "r", "c", "n")
    )
    tile = ["lang", "i", "block"]
    trees = stage(
        cells.repartition(*tile)
        .sortWithinPartitions(*tile)
        .mapInArrow(_trees, "lang string, i long, block long, strips binary, masks binary, counts binary"),
        "trees",
    )
    # at most ROWS totals in a list
    bands = groups.groupBy("lang", "i").agg(F.sort_array(F.collect_list(F.struct("r", "total")))["total"].alias("totals"))
    last = groups.groupBy("lang").agg(F.max("i").alias("last"))
    meeting = trees.join(last, "lang").select(
        *trees.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("j")
    )
    meeting = meeting.select(
        "lang", "block", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "strips", "masks", "counts"
    )
    for side in ("lo", "hi"):
        meeting = meeting.join(bands.select("lang", F.col("i").alias(side), F.col("totals").alias(f"totals_{side}")), ["lang", side])
    key = ["lang", "block", "lo", "hi"]
    sums = meeting.repartition(*key).sortWithinPartitions(*key).mapInArrow(_walks, _SUMS)
    sums = sums.select(
        "lang",
        (F.col("lo") * ROWS + F.col("ra")).alias("a"),
        (F.col("hi") * ROWS + F.col("rb")).alias("b"),
        "forth",
        "back",
        "cells",
    )
    sums = stage(sums.groupBy("lang", "a", "b").agg(*(F.sum(c).alias(c) for c in ("forth", "back", "cells"))), "pair-sums")
    directed = sums.select("lang", "a", "b", F.col("forth").alias("visited"), "cells").union(
        sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("back").alias("visited"), "cells")
    )
    own = groups.select("lang", "source", "v", F.col("row").alias("a"), F.col("total").alias("total_a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("row").alias("b"), F.col("total").alias("total_b"))
    nothing = _divergence(
        _probability(F.lit(0), F.col("total_a")), _probability(F.lit(0), F.col("total_b"))
    )
    value = F.coalesce("visited", F.lit(0)) + F.when(
        F.col("v") > 0, (F.col("v") - F.coalesce("cells", F.lit(0))) * nothing
    ).otherwise(F.lit(0))
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (
        own.join(other, "lang")
        .filter("a <> b")
        .join(directed, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
        .withColumn("rank", F.row_number().over(best_first))
    )
