"""Embedding whitening by shifted CholeskyQR.

Entries become integers, ``x = floor(scale * c) + offset``. The *fit list*
holds each distinct x-vector once: n vectors with exact sums S. Its centred
rows ``(n * x - S) / n`` form a tall matrix A that stays distributed:

1. A pass over the fit list sums the Gram matrix of ``Q = A R^-1`` (R is the
   identity at first; rows go through a triangular solve, never a product with
   an inverse). Tasks send one d x d partial each, added up by Spark.
2. The driver factors the Gram matrix, with a shift on its diagonal while it is
   ill conditioned, and composes R = L^T R. Passes go on until Q is orthonormal.
3. ``A = Q R``, so the SVD of the d x d matrix R gives the principal axes (its
   right singular vectors) and the eigenvalues ``s^2 / n`` of the covariance,
   without ever squaring A's condition number.

Only d x d matrices reach the driver, whatever the number of rows.

Rows that take part: those whose vector is not null, not empty, holds no null
and no entry beyond 2^56 in size (infinite and NaN ones are), and has the most
common length (of equally common ones the longest). All others are left out.
Copies count once in the fit list, and each copied row has its own result;
rows that repeat an id do too, and a null id stays null. Eigenvalues that are
zero to double precision (constant or repeated dimensions, n = 1) belong to no
component, as nothing can be divided by them. An empty table gives no rows.
Other columns of the table are never read, whatever their names.
A deviation beyond the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, ship, written

LIMIT = 1 << 56
SLICE = 2_000_000     # entries of a block that a task turns into doubles at a time
MOST_PASSES = 8
RANK = 1e-13          # singular values below this share of the largest are zero


@dataclass(frozen=True)
class Params:
    components: int = 16
    scale: int = 64
    offset: int = 1_000_000


@dataclass
class Model:
    n: int
    sums: list[int]
    axes: np.ndarray        # components x d, unit rows
    values: np.ndarray      # eigenvalues, falling
    trace: float
    identity_error: float = 0.0


def integer_rows(vectors: DataFrame, params: Params, id_col: str, vec_col: str) -> DataFrame:
    """``id, x`` of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < LIMIT)))
    common = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform(v, lambda c: F.floor(c * params.scale).cast("bigint") + params.offset)
    return rows.where(F.size(v) == (common["d"] if common else 0)).select("id", x.alias("x"))


def blocks(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The rows of an Arrow column as integer matrices of bounded size."""
    if len(column) == 0:
        return
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(column), -1)
    step = max(1, SLICE // x.shape[1])
    for low in range(0, len(x), step):
        yield x[low:low + step]


def spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit where that holds it, else Python integers."""
    about = np.abs(x.astype(np.float64) - np.array([s / n for s in sums])) * n
    if about.max(initial=0.0) < 2.0 ** 62:
        wrapped = np.array([s % (1 << 64) for s in sums], np.uint64).view(np.int64)
        with np.errstate(over="ignore"):
            return x * np.int64(n) - wrapped
    return x.astype(object) * n - np.array(sums, object)


def solved(a: np.ndarray, r: np.ndarray | None) -> np.ndarray:
    """``a r^-1`` for upper triangular ``r``, column by column."""
    if r is None:
        return a
    q = np.empty_like(a, order="F")
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def summed(rows: DataFrame, d: int, per_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``per_block``, a matrix of some rows of d
    doubles. One partial leaves each task; equal places meet in one group, as
    many rows as there were tasks."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in blocks(batch.column(0)):
                found = per_block(x)
                total = found if total is None else total + found
        if total is not None:
            flat = pa.array(np.ascontiguousarray(total, np.float64).ravel(), pa.float64())
            ends = pa.array(np.arange(0, total.size + 1, total.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.ListArray.from_arrays(ends, flat)], ["place", "values"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["values"].to_list()), axis=0)
        return pd.DataFrame({"place": group["place"].iloc[:1], "values": [total.tolist()]})

    kind = "place int, values array<double>"
    parts = rows.select("x").mapInArrow(partial, kind).groupBy("place").applyInPandas(add, kind).collect()
    return np.array([r["values"] for r in sorted(parts, key=lambda r: r["place"])]).reshape(-1, d)


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sums by dimension, as halves that cannot overflow."""
    entry = rows.select(F.posexplode("x").alias("place", "x"))
    found = entry.groupBy("place").agg(
        F.count("*").alias("n"), F.sum(F.shiftright("x", 32)).alias("high"),
        F.sum(F.col("x").bitwiseAND(F.lit((1 << 32) - 1).cast("bigint"))).alias("low")).collect()
    found.sort(key=lambda r: r["place"])
    return (found[0]["n"], [(r["high"] << 32) + r["low"] for r in found]) if found else (0, [])


def factor(g: np.ndarray, rows: int, first: bool) -> np.ndarray:
    """Upper triangular R with ``R^T R = g + shift``. The shift is that of
    shifted CholeskyQR on the first pass, and where g is still ill conditioned
    a smaller one, as Q then has unit scale."""
    d = len(g)
    unit = np.finfo(float).eps / 2
    eig = np.linalg.eigvalsh(g)
    top = max(float(eig[-1]), np.finfo(float).tiny)
    shift = 0.0
    if first:
        shift = min(11 * (rows * d + d * (d + 1)) * unit, 1e-8) * top
    elif eig[0] < 1e-3 * top:
        shift = 1e3 * d * unit * top
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, d * unit * top)


def fit(rows: DataFrame, params: Params) -> Model | None:
    """The model of the distinct vectors of ``rows`` (``x``); None without any."""
    ship(rows.sparkSession)
    listed = written(rows.select("x").distinct(), "whitening-fit-list")
    n, sums = totals(listed)
    if not n:
        discard(listed)
        return None
    d = len(sums)

    def centred(x: np.ndarray) -> np.ndarray:
        return np.asarray(spread(x, n, sums) / n, np.float64)

    r = None
    for done in range(MOST_PASSES):
        def gram(x: np.ndarray, r: np.ndarray | None = r) -> np.ndarray:
            q = solved(centred(x), r)
            return q.T @ q

        g = summed(listed, d, gram)
        live = np.flatnonzero(np.diag(g) > 0)
        if done and np.abs(g - np.eye(d))[np.ix_(live, live)].max(initial=0.0) < 1e-13 * d:
            break
        step = factor(g, n, first=not done)
        r = step if r is None else step @ r

    _, s, axes = np.linalg.svd(r)
    if not np.diag(g).any():
        s = np.zeros_like(s)  # nothing varies; R is but its shifts
    # R also holds the shifts in directions without variance: those are no components.
    kept = int((s > RANK * s.max(initial=0.0)).sum())
    real = s[:kept]
    kept = min(kept, params.components)
    model = Model(n, sums, axes[:kept], real[:kept] ** 2 / n, float((real ** 2).sum() / n))
    if kept:
        def moments(x: np.ndarray) -> np.ndarray:
            w = whitened(spread(x, n, sums), model)
            return np.vstack([w.sum(0), w.T @ w])

        m = summed(listed, kept, moments) / n
        model.identity_error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(kept)).max())
    discard(listed)
    return model


def whitened(spread_rows: np.ndarray, model: Model) -> np.ndarray:
    a = np.asarray(spread_rows / model.n, np.float64)
    return a @ model.axes.T / np.sqrt(model.values)


def deviations(spread_rows: np.ndarray) -> list[int | None]:
    """Exact sums of squares."""
    f = np.asarray(spread_rows, np.float64)
    if (f * f).sum(1).max(initial=0.0) < 2.0 ** 62:
        return (spread_rows * spread_rows).sum(1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in spread_rows.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def components(vectors: DataFrame, params: Params | None = None, id_col: str = "vec_id",
               vec_col: str = "embedding") -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``
    for each row that takes part and each component, numbered from 1 by falling
    eigenvalue. ``deviation`` is the row's exact sum of ``(n * x - S)^2``."""
    params = params or Params()
    rows = integer_rows(vectors, params, id_col, vec_col)
    model = fit(rows, params)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.axes):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    shared = vectors.sparkSession.sparkContext.broadcast(model)  # 16 axes of d doubles
    share = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, k = shared.value, len(shared.value.axes)
        for batch in batches:
            low = 0
            for x in blocks(batch.column(1)):
                apart = spread(x, m.n, m.sums)
                each = np.repeat(np.arange(len(x)), k)
                ids = batch.column(0).slice(low, len(x)).take(pa.array(each))
                low += len(x)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(each), m.n, np.int64)),
                     pa.array(deviations(apart), pa.int64()).take(pa.array(each)),
                     pa.array(whitened(apart, m).ravel()), pa.array(np.tile(share, len(x))),
                     pa.array(np.full(len(each), m.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
