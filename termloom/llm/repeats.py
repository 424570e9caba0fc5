"""Passages that documents share, by interval trees of enhanced suffix arrays.

1. Every window of ``least`` bytes has an anchor: of the grams of ``GRAM`` bytes in it, the
   leftmost with the smallest hash. Equal windows have equal anchors, so windows are only
   compared within the bucket of their anchor. Neighbouring windows with one anchor are one
   piece, a string of ``least`` to ``PIECE`` bytes.
2. Anchors that only one document has are dropped before any text moves: pieces meet by their
   anchors' hashes. What a task has itself met often and in several documents is known to be
   shared, needs no meeting and leaves a single witness for the others. So frequent anchors cost
   one row a task.
3. Equal pieces of a bucket are counted together, with the smallest id that has them. The
   pieces that are left in a bucket are joined to one text, whose suffixes, from those places
   where a window begins, are sorted: with their common prefixes an enhanced suffix array. One
   scan with a stack lists its intervals, the nodes of the tree of common prefixes. An interval
   whose suffixes all follow the same byte is a part of the one for the string that begins a byte
   earlier; all others are repeats that no byte extends on either side within their pieces,
   with all their occurrences. A repeat longer than a piece comes out piece by piece.
4. Buckets with very many different pieces (what surrounds a very common passage differs) are
   dealt once more: windows are told by how many bytes they have before their anchor, first
   roughly, so that a piece falls into two parts at most, and parts meet by the bytes that all their
   windows must have. Buckets that are still too large are told more finely, down to whole windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.llr import attach_totals
from ..staging import discard, new_path, stage
from .batches import small_batches
from .grouping import large_groups, sorted_groups
from .hashing import mix, powers

LEAST = 50
GRAM = 24
#: grams in a window, and bytes of the longest piece
GRAMS = LEAST - GRAM + 1
PIECE = GRAMS + LEAST - 1
#: windows that are hashed together; their places fit in the low bits of a hash
SLICE_BITS = 16
SLICE = 1 << SLICE_BITS
#: pieces that a task looks through for shared anchors before it posts them
HELD = 1_000_000
#: bits of a hash that say where a post is dealt to
DEAL_BITS = 13
#: different pieces of an anchor beyond which it is dealt once more
BUCKET = 16_000
#: bytes before the anchor by which windows are then told, from rough to exact
WIDTHS = (16, 8, 4, 2, 1)
#: occurrences in a task from which an anchor is looked at for being shared there
OFTEN = 16

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(1_847).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDINARY, _KNOWN, _WITNESS = 0, 1, 2


class Anchors:
    """Pieces of byte strings; keeps its tables of powers."""

    def __init__(self) -> None:
        self.up = powers(_BASE, SLICE + LEAST)
        self.down = powers(pow(_BASE, -1, 1 << 64), SLICE + LEAST)

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window of the bytes the place of its anchor, and the hashes of all grams."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], dtype=np.uint64, out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * self.down[: len(data) - GRAM + 1])
        # the smallest by hash, then by place
        low = np.uint64(SLICE - 1)
        best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= GRAMS:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        rest = GRAMS - width
        best = np.minimum(best[: len(best) - rest], best[rest:])
        return (best & low).astype(np.int64), grams

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, start, windows, hash of the anchor) of the pieces, some texts at a time."""
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            # long texts in slices that overlap by what a window needs
            for at in range(0, max(0, len(text) - LEAST + 1), SLICE // 2):
                part = text[at : at + SLICE // 2 + LEAST - 1]
                if size + len(part) > SLICE:
                    yield self._together(held)
                    held, size = [], 0
                held.append((i, at, part))
                size += len(part)
        if held:
            yield self._together(held)

    def before(self, pieces: list[bytes]) -> list[int]:
        """How many bytes each piece has before its anchor, which is that of its first window."""
        out = []
        for lo in range(0, len(pieces), SLICE // LEAST):
            windows = [p[:LEAST] for p in pieces[lo : lo + SLICE // LEAST]]
            first, _ = self.of(np.frombuffer(b"".join(windows), np.uint8))
            out += (first[::LEAST] - np.arange(len(windows)) * LEAST).tolist()
        return out

    def _together(self, held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        lengths = np.array([len(p) for _, _, p in held])
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        anchor, grams = self.of(np.frombuffer(b"".join(p for _, _, p in held), np.uint8))
        # windows that begin in the last bytes of a text run into the next one
        n = lengths - LEAST + 1
        own = np.repeat(begins - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        text = np.repeat(np.arange(len(held)), n)
        at = anchor[own]
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
        windows = np.diff(np.concatenate([first, [len(own)]]))
        which = text[first]
        place = np.array([p for _, p, _ in held])[which] + own[first] - begins[which]
        return np.array([i for i, _, _ in held])[which], place, windows, grams[at[first]].view(np.int64)


def _salt(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    return mix(mix(ids.view(np.uint64)) + places.view(np.uint64)).view(np.int64)


_POSTS = "deal long, posts binary"


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers; bytes of one rank stand together, which compresses well."""
    return np.ascontiguousarray(np.stack(columns).view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)).tobytes()


def _unpacked(packed: list[bytes], n_columns: int) -> list[np.ndarray]:
    tables = [np.frombuffer(p, np.uint8).reshape(n_columns, 8, -1).transpose(0, 2, 1) for p in packed]
    joined = np.ascontiguousarray(np.concatenate(tables, axis=1)).reshape(n_columns, -1)
    return list(joined.view(np.int64))


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Posts (key, id, place) for the meeting of anchors, packed by the first bits of their keys.

    A place holds the start of a piece, its windows and the kind of post.
    """
    anchors = Anchors()
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def out() -> pa.RecordBatch:
        ids, start, n, key = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(key, kind="stable")
        sorted_keys, sorted_ids = key[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(key)]]))
        often = (sizes >= OFTEN) & (np.minimum.reduceat(sorted_ids, first) != np.maximum.reduceat(sorted_ids, first))
        known = np.empty(len(key), bool)
        known[order] = np.repeat(often, sizes)
        place = start << 8 | n << 2 | np.where(known, _KNOWN, _ORDINARY)
        # posts stay in the order of documents, which packs well; what needs no meeting is dealt evenly
        columns = [
            np.concatenate([np.where(known, key ^ _salt(ids, start), key), sorted_keys[first[often]]]),
            np.concatenate([ids, sorted_ids[first[often]]]),
            np.concatenate([place, np.full(int(often.sum()), _WITNESS)]),
        ]
        deal = (columns[0].view(np.uint64) >> np.uint64(64 - DEAL_BITS)).astype(np.uint16)
        by_deal = np.argsort(deal, kind="stable")
        columns = [c[by_deal] for c in columns]
        deals, begins = np.unique(deal[by_deal], return_index=True)
        ends = [*begins[1:].tolist(), len(deal)]
        posts = [_packed([c[lo:hi] for c in columns]) for lo, hi in zip(begins.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(deals, pa.int64()), pa.array(posts, pa.binary())], ["deal", "posts"])

    for batch in batches:
        ids = np.asarray(batch.column(0))
        for text, start, n, key in anchors.pieces(batch.column(1).to_pylist()):
            held.append((ids[text], start, n, key))
            size += len(key)
            if size > HELD:
                yield out()
                held.clear()
                size = 0
    if held:
        yield out()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, place) of the pieces whose anchors several documents have; place without the kind."""
    for table, _ in sorted_groups(batches, ["deal"]):
        key, ids, place = _unpacked(table.column("posts").to_pylist(), 3)
        order = np.argsort(key)
        key, ids, place = key[order], ids[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(key)]]))
        kind = place & 3
        meets = kind != _KNOWN
        least = np.minimum.reduceat(np.where(meets, ids, np.iinfo(np.int64).max), first)
        most = np.maximum.reduceat(np.where(meets, ids, np.iinfo(np.int64).min), first)
        several = (least < most) | np.logical_or.reduceat(kind == _WITNESS, first)
        keep = (kind == _KNOWN) | ((kind == _ORDINARY) & np.repeat(several, sizes))
        yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(place[keep] >> 2)], ["id", "place"])


#: bits of a place: the start of a piece, in bytes, and its windows
_PLACE_BITS = 48
_PIECES = "a long, id long, h long, start long, n long, piece binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each text at the places of its id; other texts of that id only give more of their own."""
    names = [f.split()[0] for f in _PIECES.split(", ")]
    anchors = Anchors()
    for batch in batches:
        same = [np.asarray(batch.column(k)) for k in (0, 1)]
        texts = batch.column(2).to_pylist()
        places = batch.column(3)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
        wanted = np.sort(owner << _PLACE_BITS | np.asarray(places.flatten()))
        for text, start, n, a in anchors.pieces(texts):
            key = text << _PLACE_BITS | start << 6 | n
            at = np.searchsorted(wanted, key)
            keep = (at < len(wanted)) & (wanted[np.minimum(at, len(wanted) - 1)] == key)
            text, start, n, a = (x[keep] for x in (text, start, n, a))
            ends = (start + n + LEAST - 1).tolist()
            pieces = [texts[i][s:e] for i, s, e in zip(text.tolist(), start.tolist(), ends, strict=True)]
            columns = [a, *(v[text] for v in same), start, n]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(pieces, pa.binary())], names)


# -- the enhanced suffix array -----------------------------------------------------------------


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of all intervals whose common prefix has ``least`` bytes or more.

    ``lcp[i]`` is the common prefix of the sorted suffixes i and i + 1. Inner intervals come first.
    """
    deep = np.flatnonzero(lcp >= least)
    if not len(deep):
        return
    runs = np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1)
    for run in runs:
        open_intervals: list[tuple[int, int]] = []
        for i, depth in zip(run.tolist(), lcp[run].tolist(), strict=True):
            begin = i
            while open_intervals and depth < open_intervals[-1][0]:
                inner, begin = open_intervals.pop()
                yield inner, begin, i
            if not open_intervals or depth > open_intervals[-1][0]:
                open_intervals.append((depth, begin))
        last = int(run[-1]) + 1
        while open_intervals:
            inner, begin = open_intervals.pop()
            yield inner, begin, last


def repeats(pieces: list[bytes], group: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, pieces, offsets) of the repeats among the pieces of each group.

    Pieces are different within a group, of ``least`` bytes at least; groups are numbered
    upwards. Left out are strings that always follow the same byte within their pieces.
    """
    lengths = np.array([len(p) for p in pieces])
    width = int(lengths.max())
    n = lengths - least + 1
    which = np.repeat(np.arange(len(pieces)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begins = (np.cumsum(lengths) - lengths)[which] + offset
    data = np.frombuffer(b"".join(pieces) + bytes(width), np.uint8)
    left = (lengths[which] - offset).astype(np.int64)
    suffix = np.lib.stride_tricks.sliding_window_view(data, width)[begins]
    suffix[np.arange(width) >= left[:, None]] = 0
    # by group, then bytes, shorter ones first
    heads = group[which].astype(">u4").view(np.uint8).reshape(-1, 4)
    keys = np.ascontiguousarray(np.concatenate([heads, suffix, left.astype(">u4").view(np.uint8).reshape(-1, 4)], 1))
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
    which, offset, begins, left, suffix = (c[order] for c in (which, offset, begins, left, suffix))
    differ = suffix[1:] != suffix[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), width)
    lcp = np.minimum(lcp, np.minimum(left[1:], left[:-1]))
    lcp[group[which][1:] != group[which][:-1]] = 0
    # the byte before each suffix; at the start of a piece there is none, which no other equals
    before = np.where(offset > 0, data[begins - 1].astype(np.int64), -1)
    changes = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0))])
    for depth, lo, hi in intervals(lcp, least):
        if changes[hi] > changes[lo] or before[lo] < 0:
            yield depth, which[lo : hi + 1], offset[lo : hi + 1]


_GROUPS = "a long, pid long, at long, length long, least long, string binary"
_VERDICTS = "a long, own long, n_rows long, mask long, piece binary"


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, list[bytes]]]:
    """Pieces of some anchors, each anchor's together, with the anchor's number for each, and their bytes."""
    for table, bounds in large_groups(batches, ["a"], 2_000):
        sizes = np.diff(bounds)
        yield table, np.repeat(np.arange(len(sizes)), sizes), table.column("piece").to_pylist()


def _several(group: np.ndarray) -> np.ndarray:
    """Places of what is not alone in its group."""
    return np.flatnonzero(np.bincount(group)[group] > 1)


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeats within each anchor's pieces, one row for each piece and offset."""
    names = [f.split()[0] for f in _GROUPS.split(", ")]
    for table, group, pieces in _meeting(batches):
        rows = _several(group)
        if not len(rows):
            continue
        a, pid, least = (table.column(k).to_numpy()[rows] for k in ("a", "pid", "least"))
        own = [pieces[k] for k in rows]
        found: list[list] = [[] for _ in names]
        for length, which, offset in repeats(own, group[rows]):
            n, string = len(which), own[which[0]][offset[0] : offset[0] + length]
            smallest = int(least[which].min())
            for column, values in zip(
                found, (a[which], pid[which], offset, [length] * n, [smallest] * n, [string] * n), strict=True
            ):
                column.extend(values)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in found[:5]), pa.array(found[5], pa.binary())], names
        )


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece the windows that start in a document with a smaller id than any that has the piece."""
    names = [f.split()[0] for f in _VERDICTS.split(", ")]
    for table, group, pieces in _meeting(batches):
        least = table.column("least").to_numpy()
        mask = np.zeros(len(least), np.int64)
        rows = _several(group)
        if len(rows):
            for length, which, offset in repeats([pieces[k] for k in rows], group[rows]):
                places = rows[which]
                later = least[places] > least[places].min()
                places, offset = places[later], offset[later]
                np.bitwise_or.at(mask, places, ((1 << (length - LEAST + 1)) - 1) << offset)
        n_rows = table.column("n_rows").to_numpy()
        keep = (mask != 0) | (n_rows > 1)
        columns = [table.column("a").to_numpy(), least, n_rows, mask]
        kept = table.column("piece").filter(pa.array(keep)).combine_chunks()
        yield pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in columns), kept], names)


# -- on tables ---------------------------------------------------------------------------------


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): rows of one id are told apart by a hash of their texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))


def _pieces(rows: DataFrame, path: str) -> DataFrame:
    """(a, id, h, start, n, piece, pid) of all pieces whose anchors several documents have; a table at the path."""
    spark = rows.sparkSession
    rows = rows.filter(F.col("id").isNotNull() & (F.length("text") >= LEAST))
    posts = rows.select("id", "text").mapInArrow(_posted, _POSTS)
    places = posts.repartition("deal").sortWithinPartitions("deal").mapInArrow(_shared, "id long, place long")
    met = new_path(spark, "places")
    by_id = stage(places, "places", met).groupBy("id").agg(F.collect_list("place").alias("places"))
    cut = rows.join(by_id, "id").select("id", "h", "text", "places").mapInArrow(_cut, _PIECES)
    found = stage(cut, "pieces", path).withColumn("pid", F.xxhash64("piece"))
    discard(spark, met)
    return found


def _different(pieces: DataFrame, path: str | None = None) -> DataFrame:
    """(a, piece, least, n_rows, pid): different pieces of each anchor; a table, at the path if one is given."""
    found = pieces.groupBy("a", "piece").agg(F.min("id").alias("least"), F.count("*").alias("n_rows"))
    return stage(found, "different-pieces", path).withColumn("pid", F.xxhash64("piece"))


def _by_anchor(different: DataFrame) -> DataFrame:
    """Each anchor's pieces together."""
    return different.repartition("a").sortWithinPartitions("a")


def _by_crowd(different: DataFrame, bucket: int) -> tuple[DataFrame, DataFrame | None]:
    """The pieces of anchors that have at most ``bucket`` of them, and those of all others, if any, as a table.

    The list of crowded anchors that is broadcast has at most one for every ``bucket`` pieces.
    """
    sizes = different.groupBy("a").count()
    crowded = stage(sizes.filter(F.col("count") > bucket).select("a"), "crowded-anchors")
    if crowded.isEmpty():
        return different, None
    crowded = F.broadcast(crowded)
    return different.join(crowded, "a", "left_anti"), stage(different.join(crowded, "a", "left_semi"), "crowded-pieces")


_PARTS = "owner long, owner_pid long, id long, a long, at long, n long, piece binary"


def _in_parts(width: int):
    """Parts of pieces: neighbouring windows with as many bytes before the anchor, in units of ``width``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, anchors = [f.split()[0] for f in _PARTS.split(", ")], Anchors()
        for batch in batches:
            out = []
            pieces = batch.column(3).to_pylist()
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), pieces, anchors.before(pieces), strict=True)
            for owner, pid, least, piece, most in rows:
                n = len(piece) - LEAST + 1
                for unit in range((most - n + 1) // width, most // width + 1):
                    lo, hi = unit * width, min(unit * width + width, GRAMS) - 1
                    at, end = max(0, most - hi), min(n, most - lo + 1)
                    # what all windows of the unit have, wherever they are
                    common = piece[most - lo : most - hi + LEAST]
                    key = hashlib.blake2b(common + bytes([unit]), digest_size=8).digest()
                    part = piece[at : end + LEAST - 1]
                    out.append((owner, pid, least, int.from_bytes(key, "little", signed=True), at, end - at, part))
            kinds = [pa.int64()] * 6 + [pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _parts(crowd: DataFrame, width: int) -> DataFrame:
    """The parts of crowded anchors' pieces, with keys for anchors: a table that is read like one of pieces."""
    parts = crowd.select("a", "pid", "least", "piece").mapInArrow(_in_parts(width), _PARTS)
    return stage(parts, "parts").withColumn("pid", F.xxhash64("piece"))


def _with_repeats(rows: DataFrame, groups: DataFrame, different: DataFrame, spread_by: str) -> DataFrame:
    """Rows of pieces with (at, length, string, least) of the repeats in them; rows without any are left out."""
    groups = stage(groups, "repeats")
    by_piece = groups.groupBy("a", "pid").agg(
        F.collect_set(F.struct("at", "length", "string", "least")).alias("repeats"), F.count("*").alias("n_groups")
    )
    by_piece = stage(by_piece.join(different.select("a", "pid", "n_rows"), ["a", "pid"]), "repeats-by-piece")
    return attach_totals(rows, by_piece, ["a", "pid"], "repeats", spread_by)


def _groups(different: DataFrame, bucket: int, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(a, pid, at, length, least, string) of the repeats among the different pieces of each anchor, and of repeated pieces."""
    calm, crowd = _by_crowd(different, bucket) if widths else (different, None)
    whole = different.filter("n_rows > 1").select(
        "a", "pid", F.lit(0).cast("long").alias("at"), F.length("piece").cast("long").alias("length"), "least", "piece"
    )
    found = _by_anchor(calm.select("a", "piece", "least", "n_rows", "pid")).mapInArrow(_intervals, _GROUPS).union(whole)
    if crowd is None:
        return found
    parts = _parts(crowd, widths[0])
    kinds = _different(parts)
    placed = _with_repeats(parts.drop("id", "piece", "n"), _groups(kinds, bucket, widths[1:]), kinds, "owner_pid")
    placed = placed.select("owner", "owner_pid", F.col("at").alias("before"), F.inline("repeats"))
    return found.union(placed.select("owner", "owner_pid", F.col("before") + F.col("at"), "length", "least", "string"))


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(string, length, id_col, start): every repeat of ``LEAST`` bytes or more with all its occurrences.

    ``string`` is the bytes of the repeat, ``start`` counts bytes. Repeats are maximal within the
    pieces that they lie in (see the module), or within parts of them if more than ``bucket`` pieces
    have one anchor; strings of one document alone are no repeats.
    Texts without an id, null or short texts have none. No documents: an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = _pieces(_rows(docs, id_col, text_col), new_path(spark, "pieces"))
    different = _different(pieces)
    found = _with_repeats(pieces.select("a", "pid", "id", "start"), _groups(different, bucket), different, "start")
    found = found.select("id", "start", F.inline("repeats"))
    found = found.select("string", "length", F.col("id").alias(id_col), (F.col("start") + F.col("at")).alias("start")).distinct()
    several = found.groupBy("string").agg((F.min(id_col) < F.max(id_col)).alias("several"))
    return found.join(several.filter("several").select("string"), "string", "left_semi")


def _bits(at: Column, windows: Column) -> Column:
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", F.call_function("shiftleft", one, windows.cast("int")) - 1, at.cast("int"))


def _judged(pieces: DataFrame, verdicts: DataFrame, spread_by: str) -> DataFrame:
    """Rows of pieces with ``bits`` for their windows that start in a document with a smaller id."""
    judged = attach_totals(pieces, verdicts, ["a", "pid"], "v", spread_by)
    bits = F.when(F.col("id") > F.col("v.own"), _bits(F.lit(0), F.col("n"))).otherwise(F.col("v.mask"))
    return judged.withColumn("bits", bits).filter("bits <> 0")


def _verdicts(different: DataFrame, bucket: int, path: str | None = None, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(a, pid, v, n_rows) of pieces that lose windows in some document: a table, at the path if one is given."""
    calm, crowd = _by_crowd(different, bucket) if widths else (different, None)
    # a hash of the piece is made again on the other side: it does not move
    found = _by_anchor(calm.select("a", "piece", "least", "n_rows")).mapInArrow(_masks, _VERDICTS)
    found = found.select("a", F.xxhash64("piece").alias("pid"), "own", "n_rows", "mask")
    if crowd is not None:
        parts = _parts(crowd, widths[0])
        judged = _judged(parts.drop("piece"), _verdicts(_different(parts), bucket, widths=widths[1:]), "owner_pid")
        mask = F.bit_or(F.call_function("shiftleft", F.col("bits"), F.col("at").cast("int"))).alias("mask")
        masks = judged.groupBy(F.col("owner").alias("a"), F.col("owner_pid").alias("pid")).agg(mask)
        own = crowd.select("a", "pid", F.col("least").alias("own"), "n_rows").join(masks, ["a", "pid"], "left")
        own = own.withColumn("mask", F.coalesce("mask", F.lit(0).cast("long")))
        found = found.union(own.filter("n_rows > 1 or mask <> 0"))
    return stage(found.select("a", "pid", F.struct("own", "mask").alias("v"), "n_rows"), "verdicts", path)


_DIGEST = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _DIGEST.split(", ")]
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                doc, text, spans = (batch.column(k)[row] for k in range(3))
                kept = text = text.as_py()
                n_removed = n_spans = 0
                if spans.is_valid:
                    start, bits = (np.asarray(spans.values.field(k)).astype(np.int64) for k in ("start", "bits"))
                    piece, window = np.nonzero(bits[:, None] >> np.arange(GRAMS) & 1)
                    first = np.bincount(start[piece] + window, minlength=len(text) + 1)
                    last = np.zeros(len(text) + 1, np.int64)
                    last[LEAST:] = first[: len(text) + 1 - LEAST]
                    covered = np.cumsum(first - last)[:-1] > 0
                    n_removed = int(covered.sum())
                    n_spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                out.append((doc.as_py(), len(text), n_removed, n_spans, digest, kept if with_text else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET, with_text: bool = False
) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row.

    Texts are bytes in UTF-8. Removed is every byte that lies in a string of ``LEAST`` bytes
    which also starts in a document with a smaller id, in the texts as they are given. A null
    text is empty. Rows of one id take nothing from each other; rows without an id lose
    nothing and take nothing. An empty table gives an empty table; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = _rows(docs, id_col, text_col)
    paths = [new_path(spark, name) for name in ("pieces", "different-pieces", "verdicts")]
    pieces = _pieces(rows, paths[0])
    verdicts = _verdicts(_different(pieces, paths[1]), bucket, paths[2])
    judged = _judged(pieces.select("a", "pid", "id", "h", "start", "n"), verdicts, "start")
    spans = judged.groupBy("id", "h").agg(F.collect_set(F.struct("start", "bits")).alias("spans"))
    spans = stage(spans, "spans")
    for path in paths:
        discard(spark, path)
    found = rows.join(spans, ["id", "h"], "left").select("id", "text", "spans").mapInArrow(_removed(with_text), _DIGEST)
    found = found.withColumnRenamed("id", id_col)
    return found if with_text else found.drop("kept")
