"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Every entry c becomes the whole number floor(256 * c). The fit list is each distinct vector
of such numbers once: ``n`` vectors with the sums ``S``. Its scatter, the sum of the centred
vectors' outer products, is added up in tasks, so that only matrices of dimension by
dimension, whatever the number of rows, come to the driver. There it is factored as ``L L'``
with the greatest remaining diagonal entry as the next pivot, and the columns of ``L`` are
rotated in pairs until all are orthogonal. Then ``L = U D``, so the squared norms of the columns are the scatter's
eigenvalues and the normalised columns its eigenvectors: the factor's own columns are
rotated, no product is formed that would square its condition.

Dropped are rows whose vector is null, empty, or holds a null or a number that isn't finite,
and rows whose vector isn't as long as most of the others (of equally common lengths, the
greatest counts). Repeated rows all have results. Directions without variance are no
components, so fewer than asked for may be found, and none where all vectors are equal or
the table is empty. A deviation beyond 64 bits is null; entries beyond 64 bits are held at
their limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows

STEPS = 256
COMPONENTS = 4
_LARGEST = 2**63 - 1
_MOST_SWEEPS = 60


@dataclass(frozen=True)
class Whitening:
    """A fitted projection; ``vectors`` has one row for each component."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A factor with ``a = L L'`` up to rounding, and the order in which its rows are triangular."""
    size = len(a)
    left, order, factor = a.diagonal().copy(), np.arange(size), np.zeros((size, size))
    least = size * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(size):
        at = k + int(np.argmax(left[order[k:]]))
        if left[order[at]] <= least:
            return factor[:, :k], order
        order[[k, at]] = order[[at, k]]
        pivot, rest = order[k], order[k + 1:]
        factor[pivot, k] = np.sqrt(left[pivot])
        factor[rest, k] = (a[rest, pivot] - factor[rest, :k] @ factor[pivot, :k]) / factor[pivot, k]
        left[rest] -= factor[rest, k] ** 2
    return factor, order


def orthogonal_columns(a: np.ndarray) -> np.ndarray:
    """``a`` times a rotation that makes its columns orthogonal.

    A sweep meets every pair of columns once, half of the columns with the other half at a
    time: one column stays in its place and the others move round the table.
    """
    a = a.copy()
    count = a.shape[1]
    seats = np.append(np.arange(count), -1) if count % 2 else np.arange(count)
    for _ in range(_MOST_SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            i, j = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            real = (i >= 0) & (j >= 0)
            turned |= _rotate(a, i[real], j[real])
            seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))
        if not turned:
            break
    return a


def _rotate(a: np.ndarray, i: np.ndarray, j: np.ndarray) -> bool:
    x, y = a[:, i], a[:, j]
    xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
    skew = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
    if not skew.any():
        return False
    i, j, x, y = i[skew], j[skew], x[:, skew], y[:, skew]
    ratio = (yy[skew] - xx[skew]) / (2 * xy[skew])
    tangent = np.where(ratio >= 0, 1.0, -1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
    cosine = 1 / np.hypot(1.0, tangent)
    sine = cosine * tangent
    a[:, i], a[:, j] = cosine * x - sine * y, sine * x + cosine * y
    return True


def eigenpairs(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and their unit vectors as rows; the greatest entry of each is positive."""
    factor, order = pivoted_cholesky(scatter)
    turned = np.empty_like(factor)
    turned[order] = orthogonal_columns(factor[order])
    norms = np.sqrt((turned * turned).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    falling = falling[norms[falling] > 0]
    vectors = (turned[:, falling] / norms[falling]).T
    signs = np.array([np.sign(v[np.argmax(np.abs(v))]) for v in vectors])
    return norms[falling] ** 2, vectors * signs[:, None]


def quantised(vector: Column) -> Column:
    """The whole numbers of a vector; null where an entry is missing or not finite."""
    wide = vector.cast("array<double>")
    odd = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~odd, F.transform(wide, lambda c: F.floor(c * STEPS)))


def _points(df: DataFrame, vector: str) -> tuple[DataFrame, str]:
    """Rows with the numbers of their vectors, all of one length."""
    name = rows.fresh(df, "point")
    points = df.withColumn(name, quantised(F.col(f"`{vector}`")))
    length = F.size(name)
    commonest = (
        points.where(length > 0).groupBy(length.alias("size")).agg(F.count(F.lit(1)).alias("times"))
        .orderBy(F.desc("times"), F.desc("size")).first()
    )
    return points.where(length == (commonest["size"] if commonest else -1)), name


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _fit_sums(points: DataFrame, size: int) -> tuple[int, tuple[int, ...]]:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for batch in batches:
            x = _matrix(batch.column(0), size)
            n += len(x)
            small = len(x) == 0 or float(np.abs(x.astype(float)).max()) * len(x) < 2.0**62
            sums = [s + int(t) for s, t in zip(sums, x.sum(axis=0) if small else x.astype(object).sum(axis=0))]
        yield pa.RecordBatch.from_pydict(
            {"at": pa.array(range(-1, size), pa.int32()), "total": pa.array([str(s) for s in [n, *sums]])}
        )

    parts = points.mapInArrow(add_up, "at int, total string")
    total = parts.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["at"]: int(r["total"]) for r in total.collect()}
    return found.get(-1, 0), tuple(found.get(i, 0) for i in range(size))


def _summed_matrix(points: DataFrame, of_batch, size: int) -> np.ndarray:
    """The sum over all batches of a square matrix that each batch gives."""

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            total += of_batch(batch.column(0))
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(size), pa.int32()), "line": pa.array(list(total))})

    def over_tasks(key: tuple, lines: pa.Table) -> pa.Table:
        total = _matrix(lines["line"].combine_chunks(), size).sum(axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "line": pa.array([total])})

    schema = "i int, line array<double>"
    found = points.mapInArrow(in_task, schema).groupBy("i").applyInArrow(over_tasks, schema).collect()
    out = np.zeros((size, size))
    for r in found:
        out[r["i"]] = r["line"]
    return out


def _fit(points: DataFrame, name: str, components: int) -> Whitening | None:
    distinct = rows.written(points.select(F.col(name).alias("x")).distinct(), "fit")
    first = distinct.first()
    if first is None:
        return None
    size = len(first["x"])
    n, sums = _fit_sums(distinct, size)
    mean = np.array([s / n for s in sums])

    def scatter(x: pa.Array) -> np.ndarray:
        centred = _matrix(x, size) - mean
        return centred.T @ centred

    whole = _summed_matrix(distinct, scatter, size)
    values, vectors = eigenpairs(whole)
    values, vectors = values[:components] / n, vectors[:components]
    weights = vectors.T / np.sqrt(values)

    def moments(x: pa.Array) -> np.ndarray:
        z = (_matrix(x, size) - mean) @ weights
        return z.T @ z

    covariance = _summed_matrix(distinct, moments, len(values)) / n if len(values) else np.zeros((0, 0))
    error = float(np.abs(covariance - np.eye(len(values))).max(initial=0.0))
    return Whitening(n, sums, values, vectors, float(np.trace(whole)) / n, error)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``df``; None where no vector counts."""
    return _fit(*_points(df, vector), components)


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """The exact sum of (n * x - S)^2 over the dimensions, None beyond 64 bits."""
    reach = model.n * np.abs(x.astype(float)).max(initial=0.0) + max(map(abs, model.sums))
    if reach * reach * max(1, x.shape[1]) < 2.0**62:
        apart = x * model.n - np.array(model.sums)
        return (apart * apart).sum(axis=1).tolist()
    apart = x.astype(object) * model.n - np.array(model.sums, object)
    return [int(t) if t <= _LARGEST else None for t in (apart * apart).sum(axis=1)]


def whitened_column(point: Column, model: Whitening) -> Column:
    """Struct of ``deviation`` and ``whitened``, the coordinates in all components."""
    mean, weights = model.mean, model.vectors.T / np.sqrt(model.values)

    @F.arrow_udf("deviation long, whitened array<double>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _matrix(batch, len(mean))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(deviations(x, model), pa.int64()),
                    pa.array(list((x - mean) @ weights), pa.list_(pa.float64())),
                ],
                names=["deviation", "whitened"],
            )

    return project(point)


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, str, Whitening | None]:
    """The rows that count, with the struct of ``whitened_column`` under the returned name, and the model."""
    points, point = _points(df, vector)
    model = _fit(points, point, components)
    name = rows.fresh(df, "whitening")
    if model is None or not len(model.values):
        empty = F.lit(None).cast("struct<deviation:bigint,whitened:array<double>>")
        return points.limit(0).drop(point).withColumn(name, empty), name, model
    return points.withColumn(name, whitened_column(F.col(point), model)).drop(point), name, model


def coordinates(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each row and component: the columns of ``df`` but the vector, then the digest's columns.

    Columns of ``df`` that are called like one of the digest's give way to it.
    """
    found, name, model = whiten(df, vector, components)
    total = model.trace if model is not None else 1.0
    shares = [float(v / total) for v in model.values] if model is not None else []
    ours = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    kept = [f"`{c}`" for c in df.columns if c != vector and c.lower() not in ours]
    at, value = rows.fresh(df, "at"), rows.fresh(df, "value")
    spread = found.select(*kept, F.col(name)["deviation"].alias("deviation"), F.posexplode(F.col(name)["whitened"]).alias(at, value))
    share = F.get(F.array(*map(F.lit, shares)).cast("array<double>"), F.col(at))
    return spread.select(
        *kept, (F.col(at) + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        F.col(value).alias("whitened"), share.alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
