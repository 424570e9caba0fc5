"""Principal components by spectral divide and conquer, and whitening by them.

The covariance is made in two passes over the distinct vectors, in whole numbers as far as
doubles hold them. It is a small matrix, which the driver takes apart: the polar factor of
the matrix less a shift, by dynamically weighted Halley steps (QDWH), tells the eigenvalues
above the shift from those below. Half of it and of the identity is the projector of the upper
invariant subspace; bases of that and of its complement split the matrix into two smaller
ones, and so on, down to single components. Only parts that hold wanted components are split.
The components then travel to all rows with the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .batches import small_batches

EPS = float(np.finfo(float).eps)
COMPONENTS = 4
SCALE = 256
_LONG = 2.0**63

# -- QDWH ------------------------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix: its matrix sign."""
    n = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return np.eye(n)
    x, eye = a / size, np.eye(n)
    # a lower bound of the smallest singular value
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        weight = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            new = b / c * x + (weight - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        else:
            half = np.linalg.inv(np.linalg.cholesky(eye + c * x.T @ x))
            new = b / c * x + (weight - b / c) * (x @ half.T) @ half
        new = (new + new.T) / 2
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        done = np.linalg.norm(new - x) <= np.cbrt(5 * EPS) and 1 - low <= 10 * EPS
        x = new
        if done:
            break
    return x


def _split(a: np.ndarray, shift: float, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below the shift; none if it does not part them."""
    n = len(a)
    projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    above = int(round(np.trace(projector)))
    if not 0 < above < n:
        return None
    rng = np.random.default_rng(n)
    basis = projector @ rng.standard_normal((n, above))
    for _ in range(3):
        whole = np.linalg.qr(projector @ basis, "complete")[0]
        upper, lower = whole[:, :above], whole[:, above:]
        if np.linalg.norm(lower.T @ a @ upper) <= 8 * n * EPS * scale:
            return upper, lower
        basis = upper
    return None


def principal_components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.linalg.norm(a)

    def parts(a: np.ndarray, basis: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
        n = len(a)
        if n == 1 or np.linalg.norm(a - np.diag(np.diag(a))) <= EPS * scale:
            found = sorted(zip(np.diag(a), basis.T, strict=True), key=lambda f: -f[0])
            return found[:most]
        middle = np.diag(a)
        # the mean parts any matrix that is no multiple of the identity; the median parts it more evenly
        shifts = [np.median(middle), middle.mean(), *np.quantile(middle, [0.3, 0.7]), (middle.max() + middle.min()) / 2]
        for shift in [*shifts, *(middle.mean() + middle.std() * f for f in (0.01, -0.01, 0.1, -0.1))]:
            found = _split(a, float(shift), scale)
            if found:
                break
        else:
            # equal up to rounding
            if np.linalg.norm(a - middle.mean() * np.eye(n)) <= 100 * n * EPS * scale:
                return [(middle.mean(), v) for v in basis.T[:most]]
            raise ArithmeticError("no shift parts the spectrum")
        out = []
        for part in found:
            if len(out) < most:
                inner = part.T @ a @ part
                out += parts((inner + inner.T) / 2, basis @ part, most - len(out))
        return out

    found = parts((a + a.T) / 2, np.eye(len(a)), most)
    vectors = np.array([v / np.linalg.norm(v) for _, v in found]).T
    # the quotient of a vector is twice as exact as the vector
    values = np.array([v @ a @ v for v in vectors.T])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# -- vectors ---------------------------------------------------------------------------------

_WIDTHS = ("<i2", "<i4", "<i8")


def _packed(vectors: pa.Array, scale: float) -> list[bytes | None]:
    """floor(scale * x) of each vector as narrow whole numbers without zeros at the end; none for a vector without."""
    out: list[bytes | None] = []
    offsets, null = vectors.offsets.to_numpy(), np.asarray(vectors.is_null())
    first = offsets[0]
    flat = vectors.values.slice(first, offsets[-1] - first)
    lacking = np.asarray(flat.is_null())
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(flat.cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)
        # what no whole number of 64 bits holds counts as not finite
        bad = lacking | ~((x < _LONG) & (x >= -_LONG))
    x[bad] = 0
    whole, some_bad = x.astype(np.int64), np.concatenate([[0], np.cumsum(bad)])
    for i in range(len(null)):
        lo, hi = offsets[i] - first, offsets[i + 1] - first
        if null[i] or some_bad[hi] > some_bad[lo]:
            out.append(None)
            continue
        v = whole[lo:hi]
        used = np.flatnonzero(v)
        v = v[: used[-1] + 1] if len(used) else v[:0]
        least, most = (int(v.min()), int(v.max())) if len(v) else (0, 0)
        kind = 0 if -(2**15) <= least and most < 2**15 else 1 if -(2**31) <= least and most < 2**31 else 2
        out.append(bytes([kind]) + v.astype(_WIDTHS[kind]).tobytes())
    return out


def _matrix(keys: list[bytes], dim: int) -> np.ndarray:
    """Rows of whole numbers, with zeros at the end of shorter vectors."""
    out = np.zeros((len(keys), dim), np.int64)
    for i, k in enumerate(keys):
        v = np.frombuffer(k, _WIDTHS[k[0]], offset=1)
        out[i, : len(v)] = v
    return out


def _parse(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array(_packed(batch.column(1), scale), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), keys], ["id", "key"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, total): sums by dimension, and at place -1 the number of vectors."""
    total, n = np.zeros(0, object), 0
    for batch in batches:
        keys = batch.column(0).to_pylist()
        if not keys:
            continue
        dim = max(len(k[1:]) // int(_WIDTHS[k[0]][2]) for k in keys)
        x = _matrix(keys, dim)
        exact = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * len(x) < 2**62
        own = (x if exact else x.astype(object)).sum(0)
        if dim > len(total):
            total = np.concatenate([total, np.zeros(dim - len(total), object)])
        total[:dim] += np.array([int(v) for v in own], object)
        n += len(keys)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *range(len(total))], pa.int64()), pa.array([str(n), *map(str, total)])], ["place", "total"]
    )


def _squares(centre: list[int]):
    """(i, j, total): sums of products of the distances from ``centre``, for i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, at = len(centre), np.array(centre, np.int64)
        total = np.zeros((dim, dim))
        for batch in batches:
            x = (_matrix(batch.column(0).to_pylist(), dim) - at).astype(float)
            total += x.T @ x
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "total"])

    return run


class _Whitener:
    """Whitens rows of whole numbers; as large as the dimensions times the components."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> None:
        self.n, self.sums = n, sums
        # the mean is a whole number and a rest of at most one half
        self.centre = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = np.array([(s - n * c) / n for s, c in zip(sums, self.centre, strict=True)])
        self.values, self.by = values, vectors / np.sqrt(values)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - np.array(self.centre, np.int64)) - self.rest) @ self.by

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums of (n * x - S)^2, held to 64 bits."""
        largest = max((abs(v) for v in (int(x.max(initial=0)), int(x.min(initial=0)))), default=0)
        bound = self.n * largest + max(map(abs, self.sums), default=0)
        if bound**2 * max(1, len(self.sums)) < 2**63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1)
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(1)
        return np.array([min(int(v), 2**63 - 1) for v in exact], np.int64)


def _products(model: _Whitener):
    """(i, j, total): sums of products of whitened components, for i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.by.shape[1]
        total = np.zeros((k, k))
        for batch in batches:
            y = model.whitened(_matrix(batch.column(0).to_pylist(), len(model.sums)))
            total += y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "total"])

    return run


_RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whiten(model: _Whitener, explained: np.ndarray, error: float):
    names = [f.split()[0] for f in _RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            rows = batch.num_rows
            x = _matrix(batch.column(1).to_pylist(), len(model.sums))
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                pa.array(np.repeat(model.deviations(x), k)),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _symmetric(sums: DataFrame, dim: int) -> np.ndarray:
    """A matrix of (i, j, total); as large as the dimensions squared, whatever the number of rows."""
    out = np.zeros((dim, dim))
    for i, j, total in sums.groupBy("i", "j").agg(F.sum("total")).collect():
        out[i, j] = out[j, i] = total
    return out


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    components: int = COMPONENTS,
) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) of every vector and component.

    x is floor(scale * entry). Covariance and components are those of the ``n`` distinct x
    vectors, however often they repeat. ``deviation`` is the sum of (n * x - S)^2 over the
    dimensions, with the sums S. ``whitened`` is x less the mean, projected on the component,
    over the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest entry of the whitened vectors' covariance less the identity.

    Rows without a vector, or with an entry that is null, not finite or too large for 64 bits,
    are left out. Rows that repeat an id, or have none, are rows of their own. A shorter vector ends
    in zeros. There are as many components as have a variance above rounding: none, and so
    no rows, if all vectors are equal or there are none. Equal eigenvalues share a subspace,
    of which any basis may come out. A deviation beyond 64 bits is the largest number. The
    dimensions squared have to fit on the driver; other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    keyed = stage(rows.mapInArrow(_parse(float(scale)), "id long, key binary").filter("key is not null"), "vectors")
    fit = stage(keyed.select("key").distinct(), "fit-list")
    sums = fit.mapInArrow(_sums, "place long, total string").groupBy("place")
    by_place = {r.place: int(r.total) for r in sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    n = by_place.pop(-1, 0)
    totals = [by_place[i] for i in range(len(by_place))]
    nothing = spark.createDataFrame([], _RESULT.replace("id long", f"`{id_col}` long", 1))
    if not n or not totals:
        return nothing
    model = _Whitener(n, totals, np.ones(1), np.zeros((len(totals), 1)))
    about = _symmetric(fit.mapInArrow(_squares(model.centre), "i long, j long, total double"), len(totals))
    covariance = about / n - np.outer(model.rest, model.rest)
    trace = float(np.trace(covariance))
    if trace <= 0:
        return nothing
    values, vectors = principal_components(covariance, min(components, len(totals)))
    real = values > 64 * len(totals) * EPS * values[0]
    values, vectors = values[real], vectors[:, real]
    model = _Whitener(n, totals, values, vectors)
    spread = _symmetric(fit.mapInArrow(_products(model), "i long, j long, total double"), len(values)) / n
    error = float(np.abs(spread - np.eye(len(values))).max())
    return keyed.mapInArrow(_whiten(model, values / trace, error), _RESULT).withColumnRenamed("id", id_col)
