"""Whitening of embeddings along their leading principal components.

The covariance is summed over tasks from centred vectors.  It is then a matrix of dimensions times
dimensions, small however many vectors there are, whose leading components come from Householder
tridiagonalisation, bisection on Sturm counts and inverse iteration.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import query, stored, table
from tillwork.llm.vectors import usable

#: whole numbers to a unit of an entry
STEPS = 256
EPS = np.finfo(np.float64).eps


# -- eigenvectors of a symmetric matrix ---------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflectors) of H' A H, where H is the product of I - 2 u u' by the columns u."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflectors = np.zeros((n, max(0, n - 2)))
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        largest = np.abs(x[1:]).max()
        if largest == 0:
            continue
        # scaled, so that the squares neither overflow nor vanish
        largest = max(largest, abs(x[0]))
        u = x / largest
        u[0] += np.copysign(np.sqrt(u @ u), u[0])
        u /= np.sqrt(u @ u)
        reflectors[k + 1 :, k] = u
        rest = a[k + 1 :, k + 1 :]
        w = rest @ u
        w = 2 * w - 2 * (u @ w) * u
        rest -= np.outer(u, w) + np.outer(w, u)
        a[k + 1 :, k] = x - 2 * (u @ x) * u
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each point the number of eigenvalues of the tridiagonal matrix below it."""
    at = np.asarray(at, np.float64)
    squares = off * off
    # a pivot of nearly 0 is moved to just below it
    least = max(np.finfo(np.float64).tiny, squares.max(initial=0) * np.finfo(np.float64).tiny)
    count = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i in range(len(diagonal)):
        pivot = diagonal[i] - at - (squares[i - 1] / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    margin = 2 * EPS * max(np.abs(low).max(), np.abs(high).max()) * n
    low, high = low - margin, high + margin
    # the j-th largest lies where n - j eigenvalues or fewer are below
    wanted = n - np.arange(1, k + 1)
    for _ in range(200):
        mid = low + (high - low) / 2
        open_ = (low < mid) & (mid < high)
        if not open_.any():
            break
        below = sturm_count(diagonal, off, mid)
        low = np.where(open_ & (below <= wanted), mid, low)
        high = np.where(open_ & (below > wanted), mid, high)
    return low + (high - low) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """x of (T - shift) x = right, by elimination with row exchanges; pivots of 0 become tiny."""
    n = len(diagonal)
    tiny = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(np.float64).tiny)
    # rows of three bands, as elimination leaves them
    main, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    x = right.copy()
    for i in range(n - 1):
        below = off[i]
        if abs(main[i]) >= abs(below):
            factor = below / main[i] if main[i] else 0.0
            main[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
        else:
            factor = main[i] / below
            main[i], up[i], main[i + 1], up2[i] = below, main[i + 1], up[i] - factor * main[i + 1], up[i + 1]
            up[i + 1] *= -factor
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= up2[i] * x[i + 2]
        pivot = main[i] if abs(main[i]) > tiny else np.copysign(tiny, main[i])
        x[i] /= pivot
        largest = np.abs(x).max()
        if largest > 1e100:
            x /= largest
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as columns, one for each of the falling ``values``.

    Values that lie close together form a cluster; within it every vector is kept orthogonal to
    those before it in each step of the iteration, starting from another vector each.
    """
    n = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), np.finfo(np.float64).tiny)
    out = np.zeros((n, len(values)))
    first = 0
    shift = np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # shifts within a cluster differ, so that equal values do not give one vector twice
        shift = value if j == first else min(value, shift - 2 * EPS * norm)
        x = np.random.default_rng(j).standard_normal(n)
        for _ in range(6):
            cluster = out[:, first:j]
            for _ in range(2):
                x -= cluster @ (cluster.T @ x)
            x /= np.sqrt(x @ x)
            x = _solved(diagonal, off, shift, x)
            x /= np.abs(x).max()
        cluster = out[:, first:j]
        for _ in range(2):
            x -= cluster @ (cluster.T @ x)
            x /= np.sqrt(x @ x)
        out[:, j] = x
    return out


def leading_eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the ``k`` largest eigenvalues of a symmetric matrix.

    The sign of a vector makes its largest entry positive.
    """
    matrix = np.asarray(matrix, np.float64)
    k = min(k, len(matrix))
    scale = np.abs(matrix).max(initial=0)
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = leading_vectors(diagonal, off, values)
    for u in reflectors.T[::-1]:
        vectors -= 2 * np.outer(u, u @ vectors)
    vectors *= np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0)[0] < 0, -1.0, 1.0)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    return values, vectors


# -- over tables --------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What the vectors of a fit list say: the mean, and the leading components to whiten by."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S exactly, that over n): 64-bit where they do, Python's integers beyond."""
        wide = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0) >= 1 << 62
        whole = x.astype(object) if wide else x
        gap = whole * self.n - np.array(self.sums, object if wide else np.int64)
        return gap, (gap / self.n).astype(np.float64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors / np.sqrt(self.values)


def steps_of(column: str) -> str:
    """SQL of a vector in whole steps; beyond 64 bits they end at the last of them."""
    return f"transform({column}, c -> floor(CAST(c AS DOUBLE) * {STEPS}))"


def _batches(batch: pa.RecordBatch, width: int, column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch with their vectors as rows of a matrix, shorter vectors filled up with zeros."""
    for small in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
        lists = small.column(column)
        lengths = lists.value_lengths().to_numpy()
        x = np.zeros((small.num_rows, width), np.int64)
        x[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
        yield small, x


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """(n, S): the number of vectors and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            for small, x in _batches(batch, width):
                n += small.num_rows
                # halves of 32 bits, whose sums over a part fit 64
                total += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            rows = [*[(i, str(s)) for i, s in enumerate(total)], (width, str(n))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["i", "s"])

    parts = fit.mapInArrow(add, "i long, s string")
    rows = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    found = {r.i: int(r.s) for r in rows}
    return found.get(width, 0), [found.get(i, 0) for i in range(width)]


def covariance(
    fit: DataFrame, width: int, out_width: int, n: int, row: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """The mean of the outer products of ``row(x)``, which is centred: each task adds up its own vectors.

    Tasks hand on one line of the matrix as a row, added up by Spark; the driver gets the whole,
    dimensions times dimensions.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros((out_width, out_width)), False
        for batch in batches:
            for _, x in _batches(batch, width):
                y = row(x)
                total += y.T @ y
                any_ = True
        if any_:
            lines = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), out_width)
            yield pa.RecordBatch.from_arrays([pa.array(range(out_width)), lines.cast(pa.list_(pa.float64()))], ["i", "line"])

    lines = fit.mapInArrow(multiply, "i long, line array<double>")
    sums = lines.select("i", F.posexplode("line").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((out_width, out_width))
    for i, j, v in sums.toLocalIterator():
        out[i, j] = v
    return (out + out.T) / (2 * max(n, 1))


def fitted(vectors: DataFrame, column: str, most: int) -> tuple[Whitening, DataFrame, int]:
    """The whitening by the distinct vectors of whole steps, those vectors as ``x``, and their dimensions."""
    fit = stored(vectors.select(F.col(column).alias("x")).distinct(), "whitening-fit")
    least, width = fit.agg(F.min(F.size("x")), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if least != width and width:
        # filled up, some may be the same
        padded = F.expr(f"concat(x, array_repeat(0L, {width} - size(x)))")
        fit = stored(fit.select(padded.alias("x")).distinct(), "whitening-fit")
    n, sums = _sums(fit, width)
    mean = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    v = covariance(fit, width, width, n, lambda x: mean.centred(x)[1]) if n and width else np.zeros((width, width))
    values, components = leading_eigen(v, most)
    # below this an eigenvalue is rounding: its component has no spread to divide by
    real = values > len(v) * EPS * np.trace(v)
    return Whitening(n, sums, values[real], components[:, real], float(np.trace(v))), fit, width


def whiten(vectors: DataFrame, most: int = 4) -> DataFrame:
    """The other columns of ``vectors`` and component, n, deviation, whitened, explained, identity_error.

    ``vectors`` needs embedding.  Vectors that are null or hold a null or non-finite entry are left
    out.  Entries become x = floor(256 * c) and are fitted on each distinct x once; shorter vectors
    count as filled up with zeros.  One row for each vector and each of the ``most`` leading
    components that has any spread: fewer where the distinct vectors span fewer dimensions, no row
    for an empty table or a single distinct vector.  A deviation beyond 64 bits is null.  Repeated rows
    have rows of their own.  The driver and the tasks hold matrices of dimensions times dimensions.
    Columns of ``vectors`` with those names are replaced.
    """
    new = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = [c for c in vectors.columns if c not in new and c != "embedding"]
    x = "x"
    while x in kept:
        x += "_"
    good = vectors.where(usable(F.col("embedding"))).select(*kept, F.expr(steps_of("embedding")).alias(x))
    model, fit, width = fitted(good, x, most)
    n_components = len(model.values)
    error = 0.0
    if n_components:
        white = covariance(fit, width, n_components, model.n, lambda v: model.whitened(model.centred(v)[1]))
        error = float(np.abs(white - np.eye(n_components)).max())
    explained = model.values / model.trace if n_components else model.values

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not n_components:
                continue
            for small, values in _batches(batch, width, x):
                gap, centred = model.centred(values)
                if int(np.abs(gap).max(initial=0)) ** 2 * max(width, 1) >= 1 << 63:
                    gap = gap.astype(object)
                square = (gap**2).sum(axis=1)
                deviation = [d if d < 1 << 63 else None for d in square]
                z = model.whitened(centred)
                rows = np.repeat(np.arange(small.num_rows), n_components)
                taken = small.take(pa.array(rows))
                columns = {c: taken.column(c) for c in kept} | {
                    "component": pa.array(np.tile(np.arange(1, n_components + 1, dtype=np.int32), small.num_rows)),
                    "n": pa.array([model.n] * len(rows), pa.int64()),
                    "deviation": pa.array(deviation, pa.int64()).take(pa.array(rows)),
                    "whitened": pa.array(z.ravel()),
                    "explained": pa.array(np.tile(explained, small.num_rows)),
                    "identity_error": pa.array(np.full(len(rows), error)),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    from pyspark.sql import types as T

    added = T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    return good.mapInArrow(project, T.StructType([*[vectors.schema[c] for c in kept], *added.fields]))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding along the four leading components."""
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select(*columns)
