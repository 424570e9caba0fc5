"""Token ids of documents as files of independently coded, checksummed blocks.

A file format on top of Parquet, so that any store Spark writes to will do. One row is one
block: ``segment`` and ``block`` tell its place in the order of ids, ``n_ids`` and ``crc32``
(of the ids as little-endian unsigned 32-bit integers) what must come out of ``payload``, the
range coder's code. Four arrays name the documents that the block holds ids of: ``doc_id``,
``nth`` in the segment, ``start`` (ids of the segment before the document) and ``length``
(ids in this block).
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import discard, new_path, shuffles_removed, stage
from . import range_coder
from .batches import small_batches
from .cache import kept
from .encoders import TEXTS, Pieces, kept_encoder
from .offsets import shifts

BLOCK_IDS = 2_048
#: blocks coded together at most: the more, the less a numpy call costs; a block's code does not depend on it
LANES = 4_096

FORMAT = (
    "segment long, block long, n_ids long, crc32 long, payload binary, "
    "doc_id array<long>, nth array<long>, start array<long>, length array<long>"
)
_ARROW = pa.schema(
    [
        *[pa.field(n, pa.int64()) for n in ("segment", "block", "n_ids", "crc32")],
        pa.field("payload", pa.binary()),
        *[pa.field(n, pa.list_(pa.int64())) for n in ("doc_id", "nth", "start", "length")],
    ]
)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``TEXTS`` bytes: the more texts, the more chunks they share."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= TEXTS:
            rows = pa.concat_batches(held)
            held.clear()
            yield rows
            del rows
    if held:
        yield pa.concat_batches(held)


def _encoded(path: str, pieces: Pieces, end_id: int):
    """(id, h, ids): ids in little-endian 16 bits, with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept_encoder(path, pieces), np.array([end_id], "<u2").tobytes()
        for batch in _joined(batches):
            columns, ids = batch.columns[:2], [x + end for x in encoder.ids_of_all(batch.column(2))]
            del batch
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], ["id", "h", "ids"])

    return run


def _coded(block_ids: int, lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId()
        # ids not yet in a block; (id, nth, start, length) of their documents; blocks not yet coded
        held, docs, entries = bytearray(), deque(), []
        block = nth = total = 0

        def cut(n: int) -> tuple[int, np.ndarray, list]:
            """Checksum of the first n ids of those held, the ids, and their documents."""
            ids, own, left = np.frombuffer(bytes(held[: 2 * n]), "<u2"), [], n
            del held[: 2 * n]
            while left:
                doc, k, start, length = docs[0]
                own.append((doc, k, start, min(left, length)))
                if length <= left:
                    docs.popleft()
                else:
                    docs[0] = (doc, k, start, length - left)
                left -= own[-1][3]
            return zlib.crc32(ids.astype("<u4")), ids, own

        def out() -> pa.RecordBatch:
            nonlocal block
            names = [list(zip(*own, strict=True)) for _, _, own in entries]
            columns = [
                [segment] * len(entries),
                list(range(block, block + len(entries))),
                [len(ids) for _, ids, _ in entries],
                [crc for crc, _, _ in entries],
                range_coder.encode([ids for _, ids, _ in entries]),
                *[[list(n[k]) for n in names] for k in range(4)],
            ]
            block += len(entries)
            entries.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
            )

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids.as_buffer()
                held += ids
                docs.append((doc, nth, total, len(ids) // 2))
                nth, total = nth + 1, total + len(ids) // 2
                while len(held) >= 2 * block_ids:
                    entries.append(cut(block_ids))
                    if len(entries) == lanes:
                        yield out()
        if held:
            entries.append(cut(len(held) // 2))
        if entries:
            yield out()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    pieces: Pieces,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
    lanes: int = LANES,
) -> None:
    """Writes the ids of every document with ``end_id`` behind them, in ascending order of ids.

    Null ids come first, and rows of one id in the order of a hash of their texts; a null text is
    empty. An empty table makes a folder without blocks. Ids have 16 bits: a tokenizer that has
    larger ones is refused. Texts are encoded where they are read; only their ids move.
    """
    from tokenizers import Tokenizer

    if max(end_id, *Tokenizer.from_file(tokenizer_path).get_vocab().values()) >= 1 << 16:
        raise ValueError("token files hold ids below 65,536")
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
    at = new_path(spark, "token-ids")
    encoded = stage(rows.mapInArrow(_encoded(tokenizer_path, pieces, end_id), "id long, h long, ids binary"), "token-ids", at)
    ordered = encoded.repartitionByRange("id").sortWithinPartitions("id", "h", "ids").select("id", "ids")
    with shuffles_removed(spark):
        ordered.mapInArrow(_coded(block_ids, lanes), FORMAT).write.parquet(path)
    discard(spark, at)


def _in_lanes(batches: Iterator[pa.RecordBatch], lanes: int) -> Iterator[pa.Table]:
    """The rows in tables of ``lanes`` rows, the last one smaller."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= lanes:
            table = pa.Table.from_batches(held)
            yield table.slice(0, lanes)
            held = table.slice(lanes).to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _decoded(lanes: int):
    kinds = [pa.int64()] * 6 + [pa.binary()]
    columns = ["segment", "block", "doc_id", "nth", "start", "length", "ids"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        values = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_lanes(batches, lanes):
            stored = {c: table.column(c).to_pylist() for c in table.column_names}
            rows = []
            for i, ids in enumerate(range_coder.decode(stored["payload"], stored["n_ids"])):
                raw = ids.astype("<u4").tobytes()
                segment, block = stored["segment"][i], stored["block"][i]
                if zlib.crc32(raw) != stored["crc32"][i]:
                    raise ValueError(f"block {block} of segment {segment} is damaged")
                at = 0
                names = [stored[c][i] for c in ("doc_id", "nth", "start", "length")]
                for doc, nth, start, length in zip(*names, strict=True):
                    rows.append((segment, block, doc, nth, start, length, raw[4 * at : 4 * (at + length)]))
                    at += length
                if len(rows) >= 1_000:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)

    return run


def read_token_files(spark: SparkSession, path: str, lanes: int = LANES) -> DataFrame:
    """(segment, block, doc_id, nth, start, length, ids): the part of a document in a block.

    ``ids`` are little-endian unsigned 32-bit integers. A block that does not have its
    checksum ends the job with an error.
    """
    schema = "segment long, block long, doc_id long, nth long, start long, length long, ids binary"
    return spark.read.schema(FORMAT).parquet(path).mapInArrow(_decoded(lanes), schema)


# crc32 as polynomials over two elements: a checksum of joined parts from those of the parts
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    out, bit = 0, 1 << 31
    while a:
        if a & bit:
            out ^= b
            a ^= bit
        bit >>= 1
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc32(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two joined parts from theirs and the length of the second."""
    shift, power = 1 << 31, 1 << 23  # x to the powers 0 and 8
    while second_bytes:
        if second_bytes & 1:
            shift = _times(power, shift)
        power = _times(power, power)
        second_bytes >>= 1
    return _times(shift, first) ^ second


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [zlib.crc32(x.as_buffer()) for x in batch.column(6)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:6], pa.array(crc, pa.int64())], ["segment", "block", "doc_id", "nth", "start", "length", "crc"]
        )


def _shift_tables() -> list[np.ndarray]:
    """For k from 0: what each value of each of a checksum's four bytes becomes before 2**k more bytes."""
    tables, power = [], 1 << 23
    for _ in range(48):
        table = np.zeros((4, 256), np.uint32)
        for bit in range(32):
            table[bit >> 3] ^= (np.arange(256) >> (bit & 7) & 1).astype(np.uint32) * np.uint32(_times(power, 1 << bit))
        tables.append(table)
        power = _times(power, power)
    return tables


def joined_crc32s(crc: np.ndarray, n_bytes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """crc32 of joined parts, many at once; ``first`` has the place of the first part of each."""
    ends = np.cumsum(n_bytes)
    last = np.append(first[1:], len(crc)) - 1
    after = np.repeat(ends[last], np.diff(first, append=len(crc))) - ends
    crc = crc.astype(np.uint32)
    for k, table in enumerate(kept("crc32 shifts", _shift_tables)):
        at = np.flatnonzero(after >> k & 1)
        if len(at):
            x = crc[at]
            crc[at] = table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]
    return np.bitwise_xor.reduceat(crc, first)


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(4)
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        crc, length = (pc.struct_field(lists.flatten(), n).to_numpy() for n in ("crc", "length"))
        crc = joined_crc32s(crc, 4 * length, first).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(crc, pa.int64())], ["segment", "doc_id", "start", "n_tokens", "crc"]
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, from its decoded ids.

    ``start`` counts the ids of all documents before. Rows that repeat an id, or have none,
    are documents of their own. Files without blocks give an empty table.
    """
    parts = read_token_files(spark, path).mapInArrow(
        _checksums, "segment long, block long, doc_id long, nth long, start long, length long, crc long"
    )
    docs = parts.groupBy("segment", "nth", "doc_id", "start").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("block", "length", "crc"))).alias("parts")
    )
    docs = docs.select("segment", "doc_id", "start", "n_tokens", "parts").mapInArrow(
        _join_parts, "segment long, doc_id long, start long, n_tokens long, crc long"
    )
    sizes = spark.read.schema(FORMAT).parquet(path).groupBy("segment").agg(F.sum("n_ids").alias("n"))
    return docs.join(shifts(sizes, "segment", "n"), "segment").select(
        "doc_id", (F.col("shift") + F.col("start")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32")
    )
