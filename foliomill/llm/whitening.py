"""Whitening of embeddings: covariance from Spark, its leading components by tridiagonal methods, projection in the tasks.

Three passes over the vectors: exact sums, centred products, projection. What meets on the driver is one matrix of the
vectors' length squared, whatever the number of vectors. There it is reduced to a tridiagonal matrix by Householder
reflections; the leading eigenvalues are bracketed by counting signs of the pivots of shifted matrices (Sturm) and
bisected to the last digit; each vector comes from inverse iteration, those of close eigenvalues made orthogonal to each
other, and goes back through the reflections.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import stored

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
CLOSE = 1e-3  # eigenvalues nearer than this part of the matrix norm share a cluster
ROWS = 4096  # vectors worked on at once
_EPS = np.finfo(np.float64).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflectors of a symmetric matrix; reflector ``k`` acts on the rows after ``k``."""
    a, reflectors = np.array(matrix, np.float64), []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        length = np.linalg.norm(v)
        if length == 0 or np.linalg.norm(x[1:]) == 0:
            reflectors.append(np.zeros_like(x))  # nothing below the off-diagonal: no reflection
            continue
        v /= length
        reflectors.append(v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues under each value of ``at``: the negative pivots of the shifted matrix."""
    tiny = np.finfo(np.float64).tiny / _EPS
    below = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for k, d in enumerate(diagonal):
        pivot = d - at - (off[k - 1] ** 2 / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` largest eigenvalues in falling order, bisected until the bracket can't be halved."""
    n = len(diagonal)
    reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    low, high = np.full(many, (diagonal - reach).min()), np.full(many, (diagonal + reach).max())
    slack = _EPS * n * max(np.abs(low).max(), np.abs(high).max(), np.finfo(np.float64).tiny)
    low, high = low - slack, high + slack
    rank = n - 1 - np.arange(many)  # eigenvalues below the wanted one
    while True:
        mid = low + (high - low) / 2
        if not ((low < mid) & (mid < high)).any():
            return mid
        above = count_below(diagonal, off, mid) <= rank
        low, high = np.where(above, mid, low), np.where(above, high, mid)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """Solution of the shifted tridiagonal system by elimination with row exchanges; pivots are kept off zero."""
    n = len(diagonal)
    d, x = diagonal - shift, right.copy()
    up, up2, low = np.append(off, 0.0), np.zeros(n), np.append(off, 0.0)
    for k in range(n - 1):
        if abs(d[k]) >= abs(low[k]):
            if abs(d[k]) < floor:
                d[k] = floor
            f = low[k] / d[k]
            d[k + 1] -= f * up[k]
            x[k + 1] -= f * x[k]
        else:
            f = d[k] / low[k]
            d[k], up[k], d[k + 1] = low[k], d[k + 1], up[k] - f * d[k + 1]
            if k < n - 2:
                up2[k] = up[k + 1]
                up[k + 1] = -f * up2[k]
            x[k], x[k + 1] = x[k + 1], x[k] - f * x[k + 1]
    if abs(d[-1]) < floor:
        d[-1] = floor
    for k in range(n - 1, -1, -1):
        x[k] = (x[k] - (up[k] * x[k + 1] if k + 1 < n else 0) - (up2[k] * x[k + 2] if k + 2 < n else 0)) / d[k]
    return x


def leading_vectors(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    many = min(many, len(matrix))
    scale = np.abs(matrix).max(initial=0.0)
    if not many or not scale:
        return np.zeros(many), np.eye(many, len(matrix))
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, many)
    norm = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)
    lots = np.random.default_rng(7)
    vectors: list[np.ndarray] = []
    for k, value in enumerate(values):
        cluster = [j for j in range(k) if values[j] - value <= CLOSE * norm]
        x = lots.standard_normal(len(matrix))
        for _ in range(6):
            for _ in range(2):  # twice: once more for what rounding leaves
                for j in cluster:
                    x -= (vectors[j] @ x) * vectors[j]
            x /= np.linalg.norm(x)
            # a little beside the value, the more the later it stands in a cluster of equal ones
            x = _solve(diagonal, off, value - 4 * _EPS * norm * len(cluster), x, _EPS * norm)
            x /= np.abs(x).max()
        for _ in range(2):
            for j in cluster:
                x -= (vectors[j] @ x) * vectors[j]
            x /= np.linalg.norm(x)
        vectors.append(x)
    found = np.array(vectors)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        found[:, k + 1 :] -= 2 * np.outer(found[:, k + 1 :] @ v, v)
    return values * scale, found


class Fit(NamedTuple):
    """What the vectors' covariance says: sums are exact, ``vectors`` has a unit component per row."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _steps(entries: pa.Array, dims: int) -> np.ndarray:
    """Whole numbers of a list column, a row per vector."""
    flat = entries.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(SCALE * flat)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        raise ValueError("an entry is too large for a whole number of 64 bits")
    return scaled.astype(np.int64).reshape(-1, dims) + SHIFT


def usable_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``_id, _v``: rows whose vector has entries, none of them null or not finite."""
    v = F.col(vector_column)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return table.filter(v.isNotNull() & (F.size(v) > 0) & finite).select(F.col(id_column).alias("_id"), v.alias("_v"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Leading components over all ``rows`` (``_id, _v``); none without rows. Vectors of several lengths are an error."""
    shape = rows.agg(F.min(F.size("_v")), F.max(F.size("_v")), F.count("*")).first()
    if not shape[2]:
        return None
    if shape[0] != shape[1]:
        raise ValueError(f"the vectors have {shape[0]} to {shape[1]} entries")
    dims, n = shape[0], shape[2]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = _steps(batch.column(0).slice(at, ROWS), dims)
                # in two halves, so that no sum of a slice leaves 64 bits
                high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
                total = [t + (h << 32) + s for t, h, s in zip(total, high, low, strict=True)]
        names = ["_j", "_high", "_low"]
        parts = [list(range(dims)), [t >> 32 for t in total], [t & 0xFFFFFFFF for t in total]]
        yield pa.record_batch([pa.array(p, pa.int64()) for p in parts], names=names)

    parts = rows.select("_v").mapInArrow(add, "_j bigint, _high bigint, _low bigint")
    met = {r["_j"]: (r["_high"] << 32) + r["_low"] for r in parts.groupBy("_j").agg(F.sum("_high").alias("_high"), F.sum("_low").alias("_low")).collect()}
    sums = [met[j] for j in range(dims)]
    # the mean as a whole number and a rest, so that centring loses nothing to large offsets
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.float64) / n

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                centred = (_steps(batch.column(0).slice(at, ROWS), dims) - whole) - rest
                total += centred.T @ centred
        i, j = np.triu_indices(dims)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["_i", "_j", "_s"])

    parts = rows.select("_v").mapInArrow(multiply, "_i bigint, _j bigint, _s double").groupBy("_i", "_j").agg(F.sum("_s").alias("_s"))
    products = parts.toPandas()
    covariance = np.zeros((dims, dims))
    i, j = products["_i"].to_numpy(), products["_j"].to_numpy()
    covariance[i, j] = covariance[j, i] = products["_s"].to_numpy() / n
    values, vectors = leading_vectors(covariance, components)
    trace = float(np.trace(covariance))
    # a direction without variance can't be brought to unit variance
    real = values > _EPS * dims * max(trace, 0.0)
    return Fit(n, sums, values[real], vectors[real], trace)


def project(rows: DataFrame, model: Fit) -> DataFrame:
    """``_id, deviation, _w``: exact squared distance from the mean times n, and the whitened components of each vector."""
    n, sums = model.n, model.sums
    dims = len(sums)
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.float64) / n
    scaled = (model.vectors / np.sqrt(model.values)[:, None]).T
    shared = rows.sparkSession.sparkContext.broadcast((whole, rest, scaled))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, rest, scaled = shared.value
        leftover = [s % n for s in sums]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                centred = _steps(part.column(1), dims) - whole
                if dims * (n * (int(np.abs(centred).max(initial=0)) + 1)) ** 2 < 2**63:
                    exact = ((centred * n - np.array(leftover, np.int64)) ** 2).sum(1).tolist()
                else:  # too large for 64 bits on the way
                    exact = [sum((c * n - r) ** 2 for c, r in zip(v, leftover, strict=True)) for v in centred.tolist()]
                white = (centred - rest) @ scaled
                yield pa.record_batch(
                    [part.column(0), pa.array(exact, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                    names=["_id", "deviation", "_w"],
                )

    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"_id {id_type}, deviation bigint, _w array<double>")


def whitened(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: ``<id_column>, component, n, deviation, whitened, explained, identity_error``.

    Entries become whole numbers (``floor(1024 * entry) + 100000``) before anything else. A vector that is null, empty or
    holds a null or non-finite entry is dropped; vectors of several lengths, and numbers or deviations that 64 bits can't
    hold, are an error. Components without variance can't be whitened and have no rows, so equal vectors give an empty
    result, as an empty table does. Null and repeated ids stay rows of their own; equal eigenvalues get any orthogonal
    pair; other columns are not read. ``identity_error`` is measured on the stored projections.
    """
    id_type = table.schema[id_column].dataType.simpleString()
    rows = usable_vectors(table, id_column, vector_column)
    model = fit(rows, components)
    made = f"`{id_column}` {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], made)
    found = stored(project(rows, model), "projected")
    many = range(len(model.values))
    pairs = [(i, j) for i in many for j in many if i <= j]
    spread = found.agg(*[F.covar_pop(F.col("_w")[i], F.col("_w")[j]) for i, j in pairs]).first()
    error = max(abs(s - (i == j)) for s, (i, j) in zip(spread, pairs, strict=True))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    found = found.select("_id", "deviation", F.posexplode("_w").alias("_k", "whitened"))
    return found.select(
        F.col("_id").alias(id_column),
        (F.col("_k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_k")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
