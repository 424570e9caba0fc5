"""Exact top-k inner products by retrieval from buckets of vectors of like length.

Vectors are ordered by length, the longest first, and cut into chunks. The longest chunks give
every query k scores, the least of which is its threshold: a lower bound of its k-th best. By
the Cauchy-Schwarz inequality a vector x can reach a query's threshold t only if
|x| >= t / |q|, so whole chunks of shorter vectors are passed over for all queries of a block
at once. Groups of blocks meet groups of chunks in tiles, which visit their chunks from the
longest on and raise the thresholds by what they find. In a chunk the local threshold,
t / (|q| * longest in the chunk), is the least cosine that a vector needs. Where it is high,
vectors are first sieved by the few largest coordinates of the query: a unit vector of at least
that cosine lies in a known interval in each of them. Where it is low, vectors are sieved by
their lengths alone. What is left is verified by its product, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import stage
from .batches import batches_of
from .offsets import shifts

CHUNK = 2_048
BLOCK = 256
#: the longest chunks that travel with the job: so many, within so many bytes, but one at least
SEED_CHUNKS = 4
SEED_BYTES = 1 << 24
#: blocks and chunks on each side of what a task searches; a matrix moves once for each tile that it is in
TILE = 16
#: local cosine thresholds from which coordinates are looked at, and how many
HIGH_COSINE = 0.6
FOCUS = 4
SLACK = 1e-9  # of sums of doubles, so that no bound cuts off a tie

_CHUNKS = pa.schema(
    [
        ("part", pa.int64()),
        ("nth", pa.int64()),
        ("longest", pa.float64()),
        ("dim", pa.int64()),
        ("ids", pa.binary()),
        ("rows", pa.binary()),
    ]
)


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v) with v = floor(scale * x) of every component as a double; one row per id.

    Leaves out null ids, null vectors and those with a component that is null or not finite.
    Of rows that repeat an id the smallest vector stands for it.
    """
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _length(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of whole numbers; shorter vectors end in zeros."""
    n = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py() :]
    dim = int(n.max(initial=0))
    if (n == dim).all():
        return flat[: len(n) * dim].reshape(len(n), dim)
    out, at = np.zeros((len(n), dim), np.int64), 0
    for i, k in enumerate(n):
        out[i, :k] = flat[at : at + k]
        at += k
    return out


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held = TaskContext.get().partitionId(), 0, []

        def out(table: pa.Table) -> pa.RecordBatch:
            rows = _matrix(table.column("v").combine_chunks()).astype("<i8")
            ids = table.column("id").to_numpy().astype("<i8")
            longest = float(np.sqrt((rows.astype(float) ** 2).sum(1)).max(initial=0))
            values = [part, nth, longest, rows.shape[1], ids.tobytes(), rows.tobytes()]
            arrays = [pa.array([x], f.type) for x, f in zip(values, _CHUNKS, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=_CHUNKS)

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                yield out(table.slice(0, size))
                nth, held = nth + 1, table.slice(size).to_batches()
        if sum(b.num_rows for b in held):
            yield out(pa.Table.from_batches(held))

    return run


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["rows"], "<i8").reshape(len(ids), row["dim"])


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dim = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, dim - x.shape[1]))) if x.shape[1] < dim else x for x in (a, b))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers, held to 64 bits."""
    bound = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0)) * q.shape[1]
    if bound < 2**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 8 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class _Chunk:
    """A chunk, with its vectors from the longest to the shortest."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        lengths = np.sqrt((rows.astype(float) ** 2).sum(1))
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.rows, self.lengths = ids[order], rows[order], lengths[order]
        self.units = self.rows / np.maximum(self.lengths, 1e-300)[:, None]

    def sieve(self, q: np.ndarray, length: float, threshold: float) -> np.ndarray:
        """Places of the vectors that may reach the threshold, by the cheaper of both ways."""
        if threshold <= 0 or length == 0:
            return np.arange(len(self.ids))
        reach = int(np.searchsorted(-self.lengths, -(threshold / length) * (1 - SLACK), side="right"))
        if not reach:
            return np.arange(0)
        cosine = threshold / (length * self.lengths[0]) * (1 - SLACK)
        if cosine < HIGH_COSINE:
            return np.arange(reach)
        unit, found = q / length, np.ones(reach, bool)
        rest = np.sqrt(max(0.0, 1 - cosine * cosine))
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            # cos(angle of q to the axis, plus or minus the widest angle allowed)
            side = np.sqrt(max(0.0, 1 - unit[f] ** 2)) * rest
            low = unit[f] * cosine - side if unit[f] > -cosine else -1.0
            high = unit[f] * cosine + side if unit[f] < cosine else 1.0
            c = self.units[:reach, f]
            found &= (c >= low - SLACK) & (c <= high + SLACK)
        return np.flatnonzero(found)

    def search(
        self, q_ids: np.ndarray, q: np.ndarray, thresholds: np.ndarray, ties: np.ndarray, k: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, scores): up to k of the best for each query.

        None is below the query's threshold; what equals it has an id below the query's tie.
        """
        q, rows = _same_width(q, self.rows)
        lengths = np.sqrt((q.astype(float) ** 2).sum(1))
        units = self.units
        if rows.shape[1] > units.shape[1]:
            self.units = np.pad(units, ((0, 0), (0, rows.shape[1] - units.shape[1])))
        sieved = [self.sieve(q[i].astype(float), lengths[i], thresholds[i]) for i in range(len(q))]
        # queries that keep most of a chunk are verified by one product of matrices
        many = [i for i, s in enumerate(sieved) if len(s) * 4 > len(rows)]
        whole = dict(zip(many, _products(q[many], rows), strict=True)) if many else {}
        for i, s in enumerate(sieved):
            if not len(s):
                continue
            scores = whole[i][s] if i in whole else _products(q[i : i + 1], rows[s])[0]
            keep = (scores > thresholds[i]) | (scores == thresholds[i]) & (self.ids[s] < ties[i])
            keep &= self.ids[s] != q_ids[i]
            ids, scores = self.ids[s][keep], scores[keep]
            best = _best(ids, scores, k)
            if len(best):
                yield i, ids[best], scores[best]


class _Asked:
    """A block of queries and the best that has been found for each."""

    def __init__(self, row: dict, k: int) -> None:
        self.ids, self.rows = _unpacked(row)
        self.k, n = k, len(self.ids)
        self.best = [np.zeros(0, np.int64)] * n
        self.scores = [np.zeros(0, np.int64)] * n
        if row.get("thresholds") is None:
            self.thresholds, self.ties = np.full(n, -np.inf), np.full(n, 2**63 - 1)
        else:
            self.thresholds, self.ties = np.frombuffer(row["thresholds"]).copy(), np.frombuffer(row["ties"], "<i8").copy()
        self.lengths = np.sqrt((self.rows.astype(float) ** 2).sum(1))

    def need(self) -> float:
        """The least length that a vector needs to reach one of the thresholds."""
        known = (self.thresholds > 0) & (self.lengths > 0)
        return float(np.where(known, self.thresholds / np.maximum(self.lengths, 1e-300), 0.0).min(initial=np.inf))

    def take(self, chunk: _Chunk) -> None:
        for i, more, s in chunk.search(self.ids, self.rows, self.thresholds, self.ties, self.k):
            ids, scores = np.append(self.best[i], more), np.append(self.scores[i], s)
            best = _best(ids, scores, self.k)
            self.best[i], self.scores[i] = ids[best], scores[best]
            if len(best) == self.k:
                self.thresholds[i], self.ties[i] = scores[best][-1], ids[best][-1]

    def found(self) -> pa.RecordBatch:
        queries = np.repeat(self.ids, [len(x) for x in self.best])
        columns = [queries, np.concatenate([np.zeros(0, np.int64), *self.best]), np.concatenate([np.zeros(0, np.int64), *self.scores])]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "id", "score"])


def _seeded(seeds: list[dict], k: int):
    """Blocks of queries with what the longest chunks give: thresholds and ties, the length they need, best ids and scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = [_Chunk(*_unpacked(s)) for s in seeds]
        for batch in batches:
            for row in batch.to_pylist():
                asked = _Asked(row, k)
                for chunk in chunks:
                    asked.take(chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([row[c]]) for c in ("block", "dim", "ids", "rows")],
                        pa.array([asked.thresholds.tobytes()]),
                        pa.array([asked.ties.astype("<i8").tobytes()]),
                        pa.array([asked.need()]),
                        pa.array([[x.tolist() for x in asked.best]], pa.list_(pa.list_(pa.int64()))),
                        pa.array([[x.tolist() for x in asked.scores]], pa.list_(pa.list_(pa.int64()))),
                    ],
                    ["block", "dim", "ids", "rows", "thresholds", "ties", "need", "best_ids", "best_scores"],
                )

    return run


def _tiles(k: int):
    """Rows of tiles: first their blocks of queries, then their chunks, from the longest on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, asked = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["bg"], row["cg"]) != tile:
                    yield from (a.found() for a in asked)
                    tile, asked = (row["bg"], row["cg"]), []
                if row["longest"] is None:
                    asked.append(_Asked(row, k))
                    continue
                # thresholds rise within the tile
                reached = [a for a in asked if row["longest"] >= a.need() * (1 - SLACK)]
                if reached:
                    chunk = _Chunk(*_unpacked(row))
                    for a in reached:
                        a.take(chunk)
        yield from (a.found() for a in asked)

    return run


def _numbered(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """Chunks of vectors, numbered from the longest; equal lengths are told apart by their ids."""
    ordered = vectors.withColumn("length", _length(F.col("v")))
    ordered = ordered.repartitionByRange(F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
    chunks = stage(
        ordered.select("id", "v").mapInArrow(
            _chunks(size), "part long, nth long, longest double, dim long, ids binary, rows binary"
        ),
        name,
    )
    sizes = chunks.groupBy("part").agg(F.count("*").alias("n"))
    numbered = chunks.join(shifts(sizes, "part", "n"), "part")
    return numbered.withColumn("number", F.col("shift") + F.col("nth")).drop("part", "nth", "shift")


def top_products(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    chunk: int = CHUNK,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """(query_id, rank, id_col, score): the k highest products of each query with other vectors.

    Vectors become floor(scale * x). ``queries`` is a condition on ``id`` that says which rows
    are asked for; candidates are all rows of other ids. Ties go to the smaller id; ranks
    count from 1; a query with fewer candidates gets all of them.

    Null ids, null vectors and those with a component that is null or not finite take no part.
    Of rows that repeat an id the smallest vector stands for it. An empty vector, and what a
    shorter one lacks, counts as zeros. An empty table gives an empty table; other columns are
    not read. Products beyond 64 bits are held to the last number there is.
    """
    whole = stage(whole_vectors(vectors, id_col, vector_col, scale), "vectors")
    chunks = stage(_numbered(whole, chunk, "chunks-parts"), "chunks")
    blocks = _numbered(whole.filter(queries), block, "queries-parts").withColumnRenamed("number", "block")
    first = chunks.filter(F.col("number") < SEED_CHUNKS).orderBy("number")
    sizes = first.select((F.length("rows") + F.length("ids")).alias("size")).collect()
    n_seeds = sum(1 for i in range(len(sizes)) if i == 0 or sum(r.size for r in sizes[: i + 1]) <= SEED_BYTES)
    seeds = [r.asDict() for r in first.filter(F.col("number") < n_seeds).collect()]
    blocks = stage(
        blocks.select("block", "dim", "ids", "rows").mapInArrow(
            _seeded(seeds, k),
            "block long, dim long, ids binary, rows binary, thresholds binary, ties binary, need double, "
            "best_ids array<array<long>>, best_scores array<array<long>>",
        ),
        "queries",
    )
    # the grid of groups of blocks and groups of chunks: numbers alone first, so that only tiles in reach are made
    blocks_in, chunks_in = F.floor(F.col("block") / tile).alias("bg"), F.floor(F.col("number") / tile).alias("cg")
    rest = chunks.filter(F.col("number") >= n_seeds)
    last = rest.agg(F.max("number")).first()[0]
    grid = blocks.groupBy(blocks_in).agg(F.min("need").alias("need")).select(
        "bg", "need", F.explode(F.sequence(F.lit(0), F.lit((last or 0) // tile)).cast("array<long>")).alias("cg")
    )
    lengths = rest.groupBy(chunks_in).agg(F.max("longest").alias("longest"))
    grid = stage(grid.join(lengths, "cg").filter(F.col("longest") >= F.col("need") * (1 - SLACK)).select("bg", "cg"), "tiles")
    parts = ["dim", "ids", "rows"]
    asked = blocks.withColumn("bg", blocks_in).join(grid, "bg").select(
        "bg", "cg", F.lit(None).cast("double").alias("longest"), F.col("block").alias("number"), *parts, "thresholds", "ties"
    )
    no_bytes = F.lit(None).cast("binary")
    stored = rest.withColumn("cg", chunks_in).join(grid, "cg").select(
        "bg", "cg", "longest", "number", *parts, no_bytes.alias("thresholds"), no_bytes.alias("ties")
    )
    met = asked.union(stored).repartition("bg", "cg")
    # nulls first: the queries come before the chunks
    met = met.sortWithinPartitions("bg", "cg", F.col("longest").isNotNull(), "number")
    # a row is a whole matrix
    with batches_of(vectors.sparkSession, 4):
        searched = stage(met.mapInArrow(_tiles(k), "query_id long, id long, score long"), "found")
    own = blocks.mapInArrow(_own_best, "query_id long, id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = searched.union(own).withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _own_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the longest chunks gave, as rows."""
    for batch in batches:
        for row in batch.to_pylist():
            q_ids, _ = _unpacked(row)
            rows = [
                (int(q), i, s)
                for q, ids, scores in zip(q_ids, row["best_ids"], row["best_scores"], strict=True)
                for i, s in zip(ids, scores, strict=True)
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "id", "score"])
