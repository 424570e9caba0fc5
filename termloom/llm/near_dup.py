"""Near-duplicate documents by MinHash signatures, posted under their coordinates.

1. Every text becomes the set of its word shingles; equal sets are one class, which
   its smallest id stands for. A class has a signature of ``coords`` minima.
2. Signatures that agree in at least ``match_at`` coordinates are found by an inverted
   join: a document is posted under its coordinate-value pairs. The ``match_at - 1``
   pairs that most documents share are skipped: two documents that agree in
   ``match_at`` pairs still share one of the others, as all documents order their
   pairs alike. Collisions are counted over whole signatures within each posted list,
   and a list gives back a spanning star of each part that holds together.
3. The components of these stars are families: any two documents that could be linked
   are in the same family. Families gather the full sets of their members, confirm
   links on them, and again give back stars, whose components are the result.

Lists and families beyond a size are cut into blocks, and every pair of blocks meets in
a task of its own, so no task holds more than two blocks. Rows that come out of a task
grow with its members, not with their pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.llr import attach_totals
from ..staging import stage
from .batches import small_batches
from .graph import components
from .grouping import sorted_groups
from .hashing import WordHasher, shingles

COORDS = 48
MISS = 1e-6
BLOCK_ROWS = 4_096
BLOCK_SHINGLES = 2_000_000
MEMBER_BITS = 1 << 23


def match_threshold(coords: int, similarity: Fraction, miss: float) -> int:
    """Most agreeing coordinates that a pair at the similarity fails to have with at most that probability."""
    p, below = float(similarity), 0.0
    for t in range(coords + 1):
        below += math.comb(coords, t) * p**t * (1 - p) ** (coords - t)
        if below > miss:
            return max(1, t)
    return coords


def _signatures(sets: list[np.ndarray], coords: int) -> np.ndarray:
    """Minima under ``coords`` multiply-shift hashes; the sets are not empty."""
    factors = np.random.default_rng(7).integers(1, 2**63, coords, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), coords), np.uint32)
    for k, f in enumerate(factors):
        out[:, k] = np.minimum.reduceat(((flat * f) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _set_key(shingles: bytes) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


def _prints(n: int, coords: int):
    kinds = [("id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sig", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()

        def out(ids, hs, sets):
            full = [s for s in sets if len(s)]
            sig = iter([x.tobytes() for x in _signatures(full, coords)] if full else [])
            return pa.RecordBatch.from_arrays(
                [
                    ids,
                    hs,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(sig) if len(s) else None for s in sets], pa.binary()),
                ],
                schema=schema,
            )

        for batch in batches:
            ids, hs, held, size = batch.column(0), batch.column(2), [], 0
            for i, words in hasher.of_texts(batch.column(1).to_pylist()):
                held.append(shingles(words, n))
                size += len(held[-1])
                if size > 200_000:
                    own = i + 1 - len(held), len(held)
                    yield out(ids.slice(*own), hs.slice(*own), held)
                    held, size = [], 0
            if held:
                own = len(ids) - len(held), len(held)
                yield out(ids.slice(*own), hs.slice(*own), held)

    return run


def _posts(coords: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(coords, dtype=np.int64) << 32
        for batch in batches:
            for part in (batch.slice(at, 2000) for at in range(0, batch.num_rows, 2000)):
                ids = np.asarray(part.column(0))
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, coords)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, coords)), pa.array((sig.astype(np.int64) | place).ravel())], ["id", "key"]
                )

    return run


def _parts(n: int, near) -> Iterator[np.ndarray]:
    """Connected parts of n members; ``near(i, rest)`` says which of the rest are linked with i.

    Members that are linked leave the rest at once, so large parts cost few comparisons.
    """
    rest = np.arange(n)
    while len(rest):
        part, rest = [rest[0]], rest[1:]
        at = 0
        while at < len(part) and len(rest):
            hit = near(part[at], rest)
            part.extend(rest[hit])
            rest, at = rest[~hit], at + 1
        if len(part) > 1:
            yield np.array(part)


def _stars(ids: np.ndarray, parts: Iterator[np.ndarray]) -> list[np.ndarray]:
    out = []
    for part in parts:
        own = np.unique(ids[part])
        if len(own) > 1:
            out.append(np.column_stack([own[1:], np.full(len(own) - 1, own[0])]))
    return out


def _edges(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.concatenate([np.empty((0, 2), np.int64), *found])
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def _match_lists(coords: int, match_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, ["key", "i", "j"]):
            ids = table.column("id").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, coords)
            sizes = np.diff(bounds)
            twos = bounds[:-1][sizes == 2]
            twos = twos[(sig[twos] == sig[twos + 1]).sum(1) >= match_at]
            twos = twos[ids[twos] != ids[twos + 1]]
            found = [np.column_stack([ids[twos], ids[twos + 1]])]
            for lo, hi in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2], strict=True):
                own = sig[lo:hi]
                found += _stars(
                    ids[lo:hi], _parts(hi - lo, lambda i, rest: (own[rest] == own[i]).sum(1) >= match_at)  # noqa: B023
                )
            yield _edges(found)

    return run


def _sets(n: int, bitmap: bytes):
    """Shingle sets of the rows whose bit is set; the bitmap only saves work."""
    bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            batch = batch.filter(pa.array(bits[np.asarray(batch.column(2))] == 1))
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000)):
                sets = [shingles(w, n).tobytes() for _, w in hasher.of_texts(part.column(1).to_pylist())]
                sets = [s for s in sets if s]
                keys = [_set_key(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["set_key", "shingles"])

    return run


def _confirm(num: int, den: int):
    def links(sets: list[bytes]) -> Iterator[np.ndarray]:
        sizes = np.array([len(s) // 8 for s in sets])
        _, local = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        marked = np.zeros(len(local) and int(local.max()) + 1, bool)

        def near(i: int, rest: np.ndarray) -> np.ndarray:
            own = local[starts[i] : starts[i + 1]]
            marked[own] = True
            # only sets of a like size can reach the similarity
            like = (sizes[rest] * num <= sizes[i] * den) & (sizes[i] * num <= sizes[rest] * den)
            out = np.zeros(len(rest), bool)
            if like.any():
                s = sizes[rest[like]]
                at = np.repeat(starts[rest[like]] - np.concatenate([[0], np.cumsum(s)[:-1]]), s) + np.arange(s.sum())
                both = np.add.reduceat(marked[local[at]].astype(np.int64), np.concatenate([[0], np.cumsum(s)[:-1]]))
                out[like] = den * both >= num * (s + sizes[i] - both)
            marked[own] = False
            return out

        return _parts(len(sets), near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, ["family", "i", "j"]):
            ids, found = table.column("id").to_numpy(), []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo > 1:
                    found += _stars(ids[lo:hi], links(table.column("shingles").slice(lo, hi - lo).to_pylist()))
            yield _edges(found)

    return run


def _block_pairs(df: DataFrame, blocks: Column) -> DataFrame:
    """Each row once for every pair of blocks (i, j) that its block is in."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = df.withColumn("blocks", blocks.cast("int")).withColumn("own", own)
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("own"))
    )
    return (
        pairs.withColumn("other", F.explode(others))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("blocks", "own", "other")
    )


def _grouped(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, "id")


def _member_bits(members: DataFrame) -> bytes:
    """Bitmap of a fixed size over the hashes of the members' ids."""
    rows = (
        members.select(F.pmod(F.xxhash64("rep"), F.lit(MEMBER_BITS)).alias("p"))
        .groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("k"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("bits"))
        .collect()  # MEMBER_BITS / 32768 rows at most
    )
    out = bytearray(MEMBER_BITS // 8)
    for r in rows:
        out[(r.k - 1) * 4096 : r.k * 4096] = r.bits
    return bytes(out)


def _judged(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    shingle_words: int,
    similarity: Fraction,
    coords: int,
    miss: float,
    block_rows: int,
    block_shingles: int,
) -> DataFrame:
    """(id, h, n_shingles, set_key, component_id, root) of every row; root: its class is the first of its component.

    Classes are numbered in the order of their smallest ids, those without one last, so that ids which
    repeat or are missing keep nothing apart and bring nothing together.
    """
    small_batches(docs.sparkSession)
    match_at = match_threshold(coords, similarity, miss)
    ids = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")
    )
    prints = stage(
        ids.mapInArrow(_prints(shingle_words, coords), "id long, h long, n_shingles long, set_key binary, sig binary"),
        "prints",
    )
    full = prints.filter("n_shingles > 0")
    # the numbers are those that are written
    in_order = full.groupBy("set_key").agg(F.min("id").alias("rep")).orderBy(F.asc_nulls_last("rep"), "set_key")
    classes = stage(in_order.withColumn("node", F.monotonically_increasing_id()), "classes")
    own = full.join(classes, "set_key").filter(F.col("id").eqNullSafe(F.col("rep")))
    sigs = stage(own.select(F.col("node").alias("id"), "n_shingles", "sig").distinct(), "signatures")

    posts = sigs.select("id", "sig").mapInArrow(_posts(coords), "id long, key long")
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    of_id = Window.partitionBy("id")
    posted = (
        posts.join(shared, "key")
        .withColumn("nth", F.row_number().over(of_id.orderBy("n", "key")))
        .withColumn("alone", coords - F.count("*").over(of_id))
        .filter(F.col("alone") + F.col("nth") <= coords - match_at + 1)
        .join(sigs.select("id", "sig"), "id")
        .select("key", "id", "sig", "n")
    )
    lists = _block_pairs(posted, F.ceil(F.col("n") / block_rows)).drop("n")
    stars = _grouped(lists, "key", "i", "j").mapInArrow(_match_lists(coords, match_at), "a long, b long")
    families = components(stars).select(F.col("node").alias("id"), F.col("component").alias("family"))

    members = families.join(sigs.select("id", "n_shingles").distinct(), "id")
    weights = members.groupBy("family").agg(F.sum("n_shingles").alias("weight"))
    blocks = _block_pairs(members.join(weights, "family"), F.ceil(F.col("weight") / block_shingles))
    named = classes.select(F.col("node").alias("id"), "set_key", "rep")
    members = stage(blocks.select("id", "family", "i", "j").join(named, "id"), "families")
    texts = ids.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(MEMBER_BITS)).alias("p"))
    sets = texts.mapInArrow(_sets(shingle_words, _member_bits(members)), "set_key binary, shingles binary")
    links = _grouped(members.join(sets.dropDuplicates(["set_key"]), "set_key"), "family", "i", "j").mapInArrow(
        _confirm(similarity.numerator, similarity.denominator), "a long, b long"
    )
    linked = components(links)
    # a component's name is the smallest id of its first class
    sizes = linked.groupBy("component").agg(F.count("*").alias("n_rows"))
    first = classes.select(F.col("node").alias("component"), F.struct("rep").alias("first"))
    named = attach_totals(linked, stage(sizes.join(first, "component"), "component-names"), ["component"], "first", "node")
    found = classes.join(named, "node", "left").select(
        "set_key",
        F.when(F.col("first").isNotNull(), F.col("first.rep")).otherwise(F.col("rep")).alias("component_id"),
        F.coalesce(F.col("node") == F.col("component"), F.lit(True)).alias("root"),
    )
    rows = prints.select("id", "h", "n_shingles", "set_key").join(found, "set_key", "left")
    alone = F.col("set_key").isNull()
    return rows.select(
        "id",
        "h",
        "n_shingles",
        "set_key",
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | F.col("root")).alias("root"),
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: Fraction = Fraction(4, 5),
    coords: int = COORDS,
    miss: float = MISS,
    block_rows: int = BLOCK_ROWS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if their shingle sets have at least that Jaccard similarity.
    ``miss`` bounds the probability that the signatures of a linked pair agree too little
    for the pair to be looked at.

    Null and empty texts and texts without words have an empty set, are linked with
    nothing and kept. A text of fewer words is one shingle. Repeated ids: each row is
    judged by its own text, rows of one id and text are one document. A row without an id is
    compared like any other; its id is smaller than none, so a component is only
    null if all its ids are. An empty table gives an empty table; other columns are not read.
    """
    rows = _judged(docs, id_col, text_col, shingle_words, similarity, coords, miss, block_rows, block_shingles)
    return rows.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: Fraction = Fraction(4, 5),
    coords: int = COORDS,
    miss: float = MISS,
    block_rows: int = BLOCK_ROWS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near-duplicates, all columns.

    Of a group stays one row with its smallest id and a text of the class that this id
    stands for; of equal sets under one id the text with the smaller hash, and of equal rows one. So no
    text is lost of which nothing similar stays. Other edge cases as above.
    """
    rows = _judged(docs, id_col, text_col, shingle_words, similarity, coords, miss, block_rows, block_shingles)
    stays = rows.filter(F.col("root") & F.col("id").eqNullSafe(F.col("component_id")))
    # texts without words are no copies of each other
    alike = stays.groupBy("id", "h", F.coalesce(F.hex("set_key"), F.col("h").cast("string")).alias("alike"))
    kept = alike.agg(F.count("*").alias("n")).groupBy("id", "alike").agg(F.min(F.struct("h", "n")).alias("one"))
    kept = kept.select(F.col("id").alias("_kept_id"), F.col("one.h").alias("_kept_h"), F.col("one.n").alias("_kept_rows"))
    own = F.xxhash64(docs[text_col])
    rows = docs.join(kept, docs[id_col].cast("long").eqNullSafe(F.col("_kept_id")) & (own == F.col("_kept_h")))
    once = rows.filter("_kept_rows = 1").drop(*kept.columns)
    again = rows.filter("_kept_rows > 1").drop(*kept.columns)
    return once.unionByName(again.dropDuplicates([id_col, text_col]))
