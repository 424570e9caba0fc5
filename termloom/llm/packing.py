"""Documents into training sequences of one length, by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole sequences from its start; the rest, shorter than a
sequence, is packed with the rests of other documents. Documents are dealt into groups by a
hash. In each group the rests are spread over k windows by differencing: two partial
partitions with the largest imbalances merge, the fullest windows of one with the emptiest of
the other, until one partition is left, whose windows are nearly equal. k begins at the least
that the total allows and rises until no window exceeds the capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .batches import small_batches
from .encoders import Pieces, kept_encoder
from .grouping import sorted_groups
from .offsets import shifts

CAPACITY = 4096
#: documents that are packed together; a group that repeated ids make larger is taken in parts
GROUP_ROWS = 2_000


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each size, sums of the windows) for k windows; at least one size."""
    nodes = []  # (sums, largest first; left part; right part; which window of the merger goes where)
    heap = []
    for i, s in enumerate(sizes.tolist()):
        sums = np.zeros(k, np.int64)
        sums[0] = s
        nodes.append((sums, None, None, None))
        heap.append((-s, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        merged = nodes[a][0] + nodes[b][0][::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        heapq.heappush(heap, (-int(merged[0] - merged[-1]), len(nodes)))
        nodes.append((merged, a, b, order))
    root = heap[0][1]
    out = np.empty(len(sizes), np.int64)
    open_nodes = [(root, np.arange(k))]
    while open_nodes:
        node, places = open_nodes.pop()
        _, a, b, order = nodes[node]
        if order is None:
            out[node] = places[0]
        else:
            before = np.empty(k, np.int64)
            before[order] = places
            open_nodes += [(a, before), (b, before[::-1])]
    return out, nodes[root][0]


def windows(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(window of each size, number of windows); no size is above the capacity."""
    if not len(sizes):
        return np.zeros(0, np.int64), 0
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found, sums = differencing(sizes, k)
        if sums[0] <= capacity:
            used, dense = np.unique(found, return_inverse=True)
            return dense, len(used)
        k += max(1, k // 200)


def _pieces(path: str, pieces: Pieces, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept_encoder(path, pieces), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([encoder.ids(text), end], dtype="<u4")
                for at in range(0, len(ids), capacity):
                    part = ids[at : at + capacity]
                    rows.append((doc, at, len(part), zlib.crc32(part), len(ids)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return run


def _pack(capacity: int, group_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, ["part"]):
            lengths = table.column("length").to_numpy()
            window, offset = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                own = np.arange(lo, hi)
                used = 0
                rests = own[lengths[lo:hi] < capacity]
                for at in range(0, len(rests), group_rows):
                    some = rests[at : at + group_rows]
                    found, n = windows(lengths[some], capacity)
                    window[some] = found + used
                    used += n
                    order = np.argsort(found, kind="stable")
                    ends = np.cumsum(lengths[some][order])
                    first = np.concatenate([[True], found[order][1:] != found[order][:-1]])
                    before = ends - lengths[some][order]
                    offset[some[order]] = before - np.maximum.accumulate(np.where(first, before, 0))
                whole = own[lengths[lo:hi] == capacity]
                window[whole] = used + np.arange(len(whole))
            yield pa.RecordBatch.from_arrays(
                [*table.combine_chunks().to_batches()[0].columns, pa.array(window), pa.array(offset)],
                [*table.column_names, "window", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    pieces: Pieces,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every document, with ``end_id`` behind its ids, lies in its pieces, each id in one.
    Sequences are numbered from 0 without gaps and hold at most ``capacity`` ids.

    A null or empty text is its end id alone. Rows that repeat an id are documents of their
    own, as are rows without an id. An empty table gives an empty table; other columns are
    not read. Equal lengths are told apart by id and start, so results don't change.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    found = stage(
        rows.mapInArrow(
            _pieces(tokenizer_path, pieces, end_id, capacity),
            "id long, start long, length long, ids_crc32 long, doc_tokens long",
        ),
        "pieces",
    )
    parts = max(1, -(-found.filter(F.col("start") + F.col("length") == F.col("doc_tokens")).count() // group_rows))
    # by the piece's checksum, too: ids may be missing or repeat, and whole sequences are packed by themselves
    part = F.pmod(F.xxhash64("id", "doc_tokens", "ids_crc32"), F.lit(parts))
    order = ["part", "id", "start", "ids_crc32"]
    grouped = found.withColumn("part", part).repartition("part").sortWithinPartitions(*order)
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, part long, window long, offset long"
    packed = stage(grouped.mapInArrow(_pack(capacity, group_rows), schema), "packed")
    used = packed.groupBy("part").agg((F.max("window") + 1).alias("n"))
    earlier = shifts(used, "part", "n")
    return packed.join(earlier, "part").select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("shift") + F.col("window")).alias("sequence_id"),
        "offset",
    )
