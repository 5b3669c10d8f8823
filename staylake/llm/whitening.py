"""Embedding whitening: principal components of scaled integer vectors, and the rows in them with unit variance.

Sums, covariance and projection run over the rows on Spark; what reaches the driver is one
dimensions x dimensions matrix. There Householder reflections make it tridiagonal, bisection by
Sturm counts finds the leading eigenvalues, and inverse iteration (with reorthogonalisation inside
clusters of close eigenvalues) their vectors, which are sent back to every task for the projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from staylake.llm import _text as X
from staylake.llm._scratch import Scratch

#: x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Partial results that one task of the first summing level adds up.
FAN_IN = 64
_EPS = np.finfo(np.float64).eps


# ---- symmetric eigenproblem ------------------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflectors v_k of Q = H_0 H_1 ..., H_k = I - 2 v v^T, with Q^T a Q tridiagonal."""
    a, n = a.copy(), len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        v, size = x.copy(), np.abs(x).max()
        if size > 0:
            v /= size
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            v /= np.linalg.norm(v)
            below = a[k + 1:, k + 1:]
            p = below @ v
            q = 2 * (p - (v @ p) * v)
            below -= np.outer(v, q) + np.outer(q, v)
            a[k + 1:, k] -= 2 * (v @ x) * v
        reflectors.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def sturm_counts(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of the given numbers."""
    tiny = np.finfo(np.float64).tiny / _EPS
    pivot, below = d[0] - at, np.zeros(len(at), dtype=np.int64)
    for k in range(len(d)):
        if k:
            pivot = d[k] - at - e[k - 1] * (e[k - 1] / pivot)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` largest eigenvalues, falling, each bisected to neighbouring doubles of the matrix's size."""
    n = len(d)
    reach = np.r_[np.abs(e), 0] + np.r_[0, np.abs(e)]
    pad = 2 * _EPS * max(np.abs(d).max(), reach.max()) + np.finfo(np.float64).tiny
    low, high = np.full(many, (d - reach).min() - pad), np.full(many, (d + reach).max() + pad)
    wanted = n - 1 - np.arange(many)  # eigenvalues below the k-th largest
    for _ in range(2000):
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high) & (high - low > _EPS * pad)).any():
            break
        above = sturm_counts(d, e, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; a vanishing pivot becomes ``floor``."""
    n = len(d)
    main, up, up2, x = d - shift, np.r_[e, 0.0], np.zeros(n), b.copy()
    for k in range(n - 1):
        under = e[k]
        if abs(main[k]) >= abs(under):
            if main[k] == 0:
                main[k] = floor
            f = under / main[k]
            main[k + 1] -= f * up[k]
            x[k + 1] -= f * x[k]
        else:
            f = main[k] / under
            main[k], up[k], next_main, next_up = under, main[k + 1], up[k] - f * main[k + 1], up[k + 1]
            main[k + 1] = next_main
            up2[k], up[k + 1] = next_up, -f * next_up
            x[k], x[k + 1] = x[k + 1], x[k] - f * x[k + 1]
    for k in range(n - 1, -1, -1):
        rest = x[k] - (up[k] * x[k + 1] if k + 1 < n else 0) - (up2[k] * x[k + 2] if k + 2 < n else 0)
        x[k] = rest / (main[k] if abs(main[k]) > floor else np.copysign(floor, main[k]))
    return x


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues, by inverse iteration from fixed random starts.

    Values closer than 1e-3 of the matrix's norm form a cluster: every iterate is made orthogonal to
    the cluster's earlier vectors, and equal values are moved apart by a few ulps.
    """
    n = len(d)
    norm = max(np.abs(d).max() + 2 * (np.abs(e).max() if len(e) else 0), np.finfo(np.float64).tiny)
    rng, out, start, used = np.random.Generator(np.random.PCG64(13)), np.zeros((n, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            start = k
        used = min(value, used - 10 * _EPS * norm) if k > start else value
        x = rng.standard_normal(n)
        for _ in range(6):
            x = _solve(d, e, used, x / np.linalg.norm(x), _EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, start:k] @ (out[:, start:k].T @ x)
            x /= np.linalg.norm(x)
        out[:, k] = x
    return out


def leading_components(a: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors (columns)."""
    many = min(many, len(a))
    size = np.abs(a).max() if a.size else 0.0
    if size == 0:
        return np.zeros(many), np.eye(len(a))[:, :many]
    d, e, reflectors = tridiagonal(a / size)
    values = leading_eigenvalues(d, e, many)
    vectors = tridiagonal_vectors(d, e, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        vectors[k + 1:] -= 2 * np.outer(v, v @ vectors[k + 1:])
    return values * size, vectors


# ---- distributed sums ------------------------------------------------------------------------

def _blocks(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    column = X.column(batch, name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _summed(rows: DataFrame, name: str, width: int, partial: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over all rows of ``partial`` (of a block of rows, ``shape``): per task, then by two levels of groups.

    Integer partials are summed exactly. Every level adds in the order of the tasks, so a rerun over
    the same partitions gives the same bits.
    """
    exact = partial(np.zeros((0, width))).dtype.kind in "iu"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = partial(_blocks(batch.slice(lo, 4096), name, width))
                total = part if total is None else total + part
        if total is not None:
            t = TaskContext.get().partitionId()
            yield pa.record_batch({"task": np.full(shape[0], t, np.int64), "line": np.arange(shape[0], dtype=np.int32), "part": pa.array([r.tobytes() for r in total], pa.binary())})

    kind = np.int64 if exact else np.float64

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("task").to_numpy(), kind="stable")
        parts = table.column("part").to_pylist()
        total = np.zeros(shape[1], dtype=kind)
        for k in order.tolist():
            total += np.frombuffer(parts[k], dtype=kind)
        return pa.table({"task": [int(table.column("task")[int(order[0])].as_py())], "line": table.column("line")[:1].cast(pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    form = "task long, line int, part binary"
    parts = rows.select(name).mapInArrow(task, form)
    level = parts.withColumn("few", F.floor(F.col("task") / FAN_IN)).groupBy("few", "line").applyInArrow(lambda t: add(t.drop(["few"])), form)
    lines = level.groupBy("line").applyInArrow(add, form).orderBy("line").collect()  # one row per dimension
    return np.array([np.frombuffer(r["part"], dtype=kind) for r in lines]) if lines else np.zeros(shape, dtype=kind)


def scaled_vectors(vectors: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """id and x = floor(SCALE * entry) + SHIFT (longs) of every vector without null or non-finite entries."""
    v = F.col(vector_name).cast("array<double>")
    usable = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(usable).select(F.col(id_name).cast("long").alias("id"), F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))


def whiten(vectors: DataFrame, id_name: str, vector_name: str, components: int = COMPONENTS) -> DataFrame:
    """Every usable row in the leading principal components of all usable rows, scaled to unit variance.

    Returns for each row and component (from 1, by falling variance): the id as ``vec_id``,
    ``component``, ``n`` (rows fitted), ``deviation`` (sum over dimensions of (n * x - S)^2, S the
    sums; exact), ``whitened``, ``explained`` (share of the total variance) and ``identity_error``
    (largest difference of the whitened rows' covariance from the identity, measured over all rows).

    Rows whose vector is null, empty, or holds null or non-finite entries take no part. If lengths
    differ, the vectors of the most frequent length (the longest of equally many) are fitted and
    returned. Repeated rows and ids count as rows of their own; a null id stays null. Directions
    without variance have no whitened value: components whose eigenvalue is zero to double precision
    are left out, so constant tables, single rows and empty tables give an empty result. Other
    columns, whatever their names, are ignored. A deviation beyond 63 bits is an ArithmeticException.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = scratch.write(scaled_vectors(vectors, id_name, vector_name), "scaled")
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    common = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return empty
    width, n = common["width"], common["n"]
    rows = rows.where(F.size("x") == width)
    sums = _summed(rows, "x", width, lambda b: b.astype(np.int64).sum(0, keepdims=True), (1, width))[0]
    mean = np.array([int(s) / n for s in sums])  # true division of integers: correctly rounded

    def products(block: np.ndarray) -> np.ndarray:
        c = block - mean
        return c.T @ c

    cov = _summed(rows, "x", width, products, (width, width)) / n
    cov = (cov + cov.T) / 2
    values, axes = leading_components(cov, components)
    trace = float(np.trace(cov))
    some = values > trace * width * _EPS
    values, axes = values[some], axes[:, some]
    if not len(values):
        return empty
    projection = axes / np.sqrt(values)
    sums_list = [int(s) for s in sums]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(sums_list, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = _blocks(part, "x", width)
                far = np.abs(n * (x - mean)).max(initial=0)
                if far * far * width < 2 ** 62:
                    deviation = pa.array(((n * x - s) ** 2).sum(1))
                else:  # exact in Python's integers; Arrow refuses what a long cannot hold
                    deviation = pa.array([sum((n * int(c) - t) ** 2 for c, t in zip(r, sums_list, strict=True)) for r in x], pa.int64())
                white = (x - mean) @ projection
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
                yield pa.record_batch({"vec_id": X.column(part, "id"), "deviation": deviation, "white": pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))})

    white = scratch.write(rows.mapInArrow(project, "vec_id long, deviation long, white array<double>"), "white")
    many = len(values)
    middle = _summed(white, "white", many, lambda b: b.sum(0, keepdims=True), (1, many))[0] / n

    def spread(block: np.ndarray) -> np.ndarray:
        c = block - middle
        return c.T @ c

    error = float(np.abs(_summed(white, "white", many, spread, (many, many)) / n - np.eye(many)).max())
    share = F.array(*(F.lit(float(v / trace)) for v in values))
    each = white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    scratch.drop("scaled")
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
