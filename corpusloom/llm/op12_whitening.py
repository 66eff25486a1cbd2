"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor.

Vectors become integers (``floor(64 * c)``).  The fit list holds each distinct vector once; Spark makes it by a
grouping with partial aggregation, so a vector that holds a third of the rows is merged before the shuffle.  Tasks
add sums, and then products of centred rows, to one small matrix each, which few tasks add up: what reaches
the driver has the size of the dimension squared, whatever the number of rows.  There the scatter is
factored as ``L L'`` with the largest remaining diagonal first, and columns of L are rotated in pairs until they
are orthogonal: their squared norms are the scatter's eigenvalues, and the columns at length one its eigenvectors.
Squaring is never undone, so small eigenvalues keep their digits.

Sums are exact integers; rows are centred by the floor of the mean, exactly, and then by its fraction.

Results for special rows: vectors that are null or hold null, non-finite or huge entries (``|64 c|`` from 2**53) are
dropped, and so are vectors whose length is not the one that most vectors have (the longer of equals); a null
id is carried; repeated rows are results of their own and one entry of the fit list; directions without variance
are no components, so that equal vectors, or a single one, give no rows, as an empty table does; a deviation
that exceeds a long is null; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint, ship

SCALE = 64.0
COMPONENTS = 16
#: Entries of the integer vectors stay below this in size: doubles hold them.
HUGE = float(2**53)
#: A pivot below this share of the first one is rounding, not variance.
RANK_TOLERANCE = 1e-13
#: Columns are orthogonal when their cosine is below this.
ORTHOGONAL = 1e-15
SWEEPS = 60
_LOW_BITS = 26
#: Tasks that add the matrices of all others.
SUMMING_TASKS = 16


def integer_vectors(rows: DataFrame, vec_id: str, embedding: str, scale: float = SCALE) -> tuple[DataFrame, int]:
    """(vec_id, y) of the usable rows, and their dimension (0 without any)."""
    scaled = F.transform(F.col(embedding), lambda c: F.floor(F.lit(scale) * c.cast("double")))
    sound = lambda c: c.isNotNull() & (F.abs(F.lit(scale) * c.cast("double")) < HUGE)  # noqa: E731  false for NaN and infinities
    usable = rows.filter(F.col(embedding).isNotNull() & (F.size(embedding) > 0)).filter(F.coalesce(F.forall(embedding, sound), F.lit(False)))
    by_length = usable.groupBy(F.size(embedding).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if by_length is None:
        return usable.select(F.col(vec_id).alias("vec_id"), scaled.alias("y")), 0
    return usable.filter(F.size(embedding) == by_length["d"]).select(F.col(vec_id).alias("vec_id"), scaled.alias("y")), by_length["d"]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _partial(batches: Iterator[pa.RecordBatch], dim: int, add, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The sum of ``add(rows)`` over a task, as one array, in one row; none from a task without rows."""
    total = None
    for batch in batches:
        if batch.num_rows:
            part = add(_matrix(batch.column(0), dim))
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_pydict({"y": pa.array([total], pa.list_(kind))})


def _summed(fit: DataFrame, dim: int, add, kind: str) -> np.ndarray:
    """The sum of ``add`` over all rows: by task, then by ``SUMMING_TASKS`` tasks, whose arrays the driver adds."""
    arrow = pa.int64() if kind == "long" else pa.float64()
    parts = fit.select("y").mapInArrow(partial(_partial, dim=dim, add=add, kind=arrow), f"y array<{kind}>")
    size = len(add(np.zeros((1, dim), np.int64)))
    merged = parts.repartition(SUMMING_TASKS).mapInArrow(partial(_partial, dim=size, add=_add_rows, kind=arrow), f"y array<{kind}>")
    return np.sum([r["y"] for r in merged.collect()], axis=0)


def _add_rows(rows: np.ndarray) -> np.ndarray:
    return rows.sum(axis=0)


def _add_sums(y: np.ndarray) -> np.ndarray:
    """High and low parts by dimension, neither of which overflows."""
    return np.concatenate([(y >> _LOW_BITS).sum(axis=0), (y & ((1 << _LOW_BITS) - 1)).sum(axis=0)])


def _add_scatter(y: np.ndarray, floor: np.ndarray, fraction: np.ndarray) -> np.ndarray:
    d = _centred(y, floor, fraction)
    return (d.T @ d)[np.triu_indices(d.shape[1])]


def _add_whitened(y: np.ndarray, floor: np.ndarray, fraction: np.ndarray, transform: np.ndarray) -> np.ndarray:
    w = _centred(y, floor, fraction) @ transform
    return (w.T @ w).ravel()


def _centred(y: np.ndarray, floor: np.ndarray, fraction: np.ndarray) -> np.ndarray:
    return (y - floor).astype(np.float64) - fraction


def pivoted_cholesky(a: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """L (rows in pivot order, as many columns as the rank) and the order, with ``a[order][:, order] = L L'``."""
    a = np.array(a, np.float64)
    n = len(a)
    order = np.arange(n)
    left = a.diagonal().copy()
    factor = np.zeros((n, n))
    first = left.max(initial=0.0)
    for k in range(n):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= tolerance * first:
            return factor[:, :k], order
        for x in (order, left):
            x[[k, p]] = x[[p, k]]
        factor[[k, p], :k] = factor[[p, k], :k]
        factor[k, k] = math.sqrt(left[k])
        below = order[k + 1 :]
        factor[k + 1 :, k] = (a[below, order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated in pairs until all are orthogonal."""
    cols = np.array(factor.T, np.float64, order="C")  # a column is a row here
    n = len(cols)
    for _ in range(SWEEPS):
        turned = False
        for i in range(n - 1):
            for j in range(i + 1, n):
                p, q = cols[i], cols[j]
                pp, qq, pq = p @ p, q @ q, p @ q
                if abs(pq) <= ORTHOGONAL * math.sqrt(pp * qq):
                    continue
                turned = True
                tau = (qq - pp) / (2.0 * pq)
                t = math.copysign(1.0, tau) / (abs(tau) + math.hypot(1.0, tau))
                c = 1.0 / math.hypot(1.0, t)
                s = c * t
                cols[i], cols[j] = c * p - s * q, s * p + c * q
        if not turned:
            break
    return cols.T


def components_of(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter, falling, and its unit eigenvectors as columns; the largest entry of each is positive."""
    factor, order = pivoted_cholesky(scatter)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated**2).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(rotated)
    vectors[order] = rotated[:, falling] / norms[falling]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]) if vectors.size else np.ones(0)
    return norms[falling] ** 2, vectors * signs


def _deviations(y: np.ndarray, floor: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """The sum over dimensions of ``(n * y - S) ** 2``, exact, with S as ``n * floor + rest``."""
    d = y - floor
    if d.size and y.shape[1] * (float(n) * (float(np.abs(d).max()) + 1.0)) ** 2 < 2.0**62:
        return ((n * d - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - int(r)) ** 2 for v, r in zip(row, rest, strict=True)) for row in d]
    return [x if x < 2**63 else None for x in exact]


def _whiten(batches: Iterator[pa.RecordBatch], dim: int, floor, fraction, rest, n: int, transform, explained, error: float, schema) -> Iterator[pa.RecordBatch]:
    kept = transform.shape[1]
    for batch in batches:
        if not batch.num_rows or not kept:
            continue
        y = _matrix(batch.column(1), dim)
        rows = len(y)
        each = np.repeat(np.arange(rows), kept)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * kept, n, np.int64)),
                pa.array(_deviations(y, floor, rest, n), pa.int64()).take(pa.array(each)),
                pa.array((_centred(y, floor, fraction) @ transform).ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * kept, error)),
            ],
            names=schema,
        )


def whiten(spark: SparkSession, rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    ship(spark)
    vectors, dim = integer_vectors(rows, vec_id, embedding)
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if dim == 0:
        return spark.createDataFrame([], schema)
    fit = checkpoint(vectors.select("y").distinct())
    n = fit.count()
    parts = [int(x) for x in _summed(fit, dim, _add_sums, "long")]
    sums = [(high << _LOW_BITS) + low for high, low in zip(parts[:dim], parts[dim:], strict=True)]
    floor = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    fraction = rest / n
    upper = _summed(fit, dim, partial(_add_scatter, floor=floor, fraction=fraction), "double")
    scatter = np.zeros((dim, dim))
    scatter[np.triu_indices(dim)] = upper
    scatter = scatter + np.triu(scatter, 1).T
    values, vectors_of = components_of(scatter)
    kept = min(components, len(values))
    transform = vectors_of[:, :kept] / np.sqrt(values[:kept] / n)
    error = 0.0
    if kept:
        covariance = np.array(_summed(fit, dim, partial(_add_whitened, floor=floor, fraction=fraction, transform=transform), "double")) / n
        error = float(np.abs(covariance.reshape(kept, kept) - np.eye(kept)).max())
    explained = values[:kept] / np.trace(scatter) if kept else values[:0]
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    work = partial(_whiten, dim=dim, floor=floor, fraction=fraction, rest=rest, n=n, transform=transform, explained=explained, error=error, schema=names)
    return vectors.mapInArrow(work, schema)
