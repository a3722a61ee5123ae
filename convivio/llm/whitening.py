"""Whitening of embeddings by polarisation covariance.

Components become whole numbers x = floor(scale * c), and the covariance is taken over each distinct x vector once. No
product of two dimensions is ever added up: for every dimension i and every pair i < j the exact squares of the centred
values x_i - S_i/n and of their sums (x_i + x_j) - (S_i + S_j)/n are aggregated, and

    2 cov(i, j) = var(x_i + x_j) - var(x_i) - var(x_j).

Exactness: with S = n m + r, a centred value times n is n (x - m) - r. Tasks add up squares of the small whole numbers
x - m in 64 bits, block by block, so that no block can overflow; Spark adds them as decimals; the constant r enters in
whole numbers of any size. Each task returns one row for every dimension and pair, whatever it reads. The assembled
matrix, a square of the dimension, goes through `eigh` on the driver; nothing else does.

Every row is then projected on the unit eigenvectors of the largest eigenvalues. `identity_error` is measured, not
derived: the whitened vectors of the fit list are aggregated once more.

Defined results: rows with a null vector, or with null, non-finite or excessively large components (`vectors.usable`),
are dropped. Shorter vectors are filled up with zeros to the longest. A null key is carried as null. Repeated rows are
all returned and count once in the fit. A component without variance (all of them with one distinct vector) has a null
`whitened` and counts no further in `identity_error`, and without any variance `explained` and `identity_error` are
null. A `deviation` beyond a long is null. An empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .vectors import SCALE, dimension_of, pack, unpack, usable, whole

COMPONENTS, BLOCK = 4, 4096


class Fit(NamedTuple):
    """n vectors with sums S; eigenvalues, largest first, and their unit eigenvectors as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray


def pair_squares(fit: DataFrame, shift: list[int]) -> DataFrame:
    """(i, j, squares): sums of ((x_i - m_i) + (x_j - m_j))^2 for i < j, and of (x_i - m_i)^2 for i = j."""
    dimension = len(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension), object)
        for batch in batches:
            y = unpack(batch.column(0), dimension) - np.array(shift, np.int64)
            largest = 2 * int(np.abs(y).max(initial=1)) + 1
            block = max(1, min(BLOCK, 2**62 // largest**2))
            for at in range(0, len(y), block):
                part = y[at:at + block]
                for i in range(dimension):
                    pair = part[:, i:] + part[:, i:i + 1]
                    pair[:, 0] = part[:, i]
                    total[i, i:] += np.einsum("ab,ab->b", pair, pair).astype(object)
        rows, columns = np.triu_indices(dimension)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array(columns, pa.int32()),
             pa.array([str(s) for s in total[rows, columns]])], ["i", "j", "squares"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, squares string")
    return parts.groupBy("i", "j").agg(F.sum(F.col("squares").cast("decimal(38,0)")).alias("squares"))


def covariance(n: int, sums: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix from the shifted squares of dimensions and pairs; one rounding for each entry."""
    dimension = len(sums)
    m, r = [s // n for s in sums], [s % n for s in sums]
    shifted = [s - n * k for s, k in zip(sums, m)]

    def spread(i: int, j: int) -> int:
        """Sum of (n a - r)^2, a being the shifted value of the dimension or pair: n^3 times its variance."""
        a, rest = (shifted[i], r[i]) if i == j else (shifted[i] + shifted[j], r[i] + r[j])
        return n * n * squares[i, j] - 2 * n * rest * a + n * rest * rest

    alone = [spread(i, i) for i in range(dimension)]
    out = np.zeros((dimension, dimension))
    for i in range(dimension):
        out[i, i] = alone[i] / n**3
        for j in range(i + 1, dimension):
            out[i, j] = out[j, i] = (spread(i, j) - alone[i] - alone[j]) / (2 * n**3)
    return out


def fit_list(fit: DataFrame, dimension: int) -> Fit:
    """`fit` has every distinct packed vector `x` once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, np.int64)
        for batch in batches:
            n += batch.num_rows
            total += unpack(batch.column(0), dimension).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, dimension), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["i", "total"])

    parts = fit.select("x").mapInArrow(run, "i int, total long").groupBy("i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = {r["i"]: int(r["total"]) for r in parts.collect()}
    n, sums = totals.get(-1, 0), [totals.get(i, 0) for i in range(dimension)]
    if not n or not dimension:
        return Fit(n, sums, np.zeros(0), np.zeros((dimension, 0)))
    found = pair_squares(fit, [s // n for s in sums]).collect()
    matrix = covariance(n, sums, {(r["i"], r["j"]): int(r["squares"]) for r in found})
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    # Of either sign, the one with which the largest entry is positive.
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(dimension)]
    return Fit(n, sums, values, vectors * np.where(largest < 0, -1.0, 1.0))


def _project(x: np.ndarray, fit: Fit, used: int) -> np.ndarray:
    """Whitened values of the first `used` components."""
    m, r = np.array([s // fit.n for s in fit.sums], np.int64), np.array([s % fit.n for s in fit.sums]) / fit.n
    return ((x - m) - r) @ (fit.vectors[:, :used] / np.sqrt(fit.values[:used]))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n x - S)^2; None beyond a long."""
    span = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if span**2 * max(1, len(sums)) < 2**63:
        centred = n * x - np.array(sums, np.int64)
        return np.einsum("ab,ab->a", centred, centred).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 2**63 else None for e in exact]


def identity_error(fit_rows: DataFrame, fit: Fit, used: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity, from a pass over it."""
    if not used:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((used, used))
        for batch in batches:
            white = _project(unpack(batch.column(0), len(fit.sums)), fit, used)
            total += white.T @ white
        a, b = np.indices((used, used)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total.ravel())], ["a", "b", "s"])

    sums = fit_rows.select("x").mapInArrow(run, "a int, b int, s double").groupBy("a", "b").agg(F.sum("s").alias("s"))
    return max(abs(r["s"] / fit.n - (r["a"] == r["b"])) for r in sums.collect())


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row for each usable row and component: key, component, n, deviation, whitened, explained, identity_error."""
    dimension = dimension_of(rows, vector)
    clean = rows.filter(usable(F.col(vector), dimension, scale)).select(
        F.col(key).cast("long").alias("key"), whole(F.col(vector), scale).alias("x"))
    packed = durable(pack(clean, "x", dimension))
    fit_rows = durable(packed.select("x").distinct())
    fit = fit_list(fit_rows, dimension)
    shown = min(components, dimension)
    # Rounding alone gives eigenvalues of about dimension * eps * the largest.
    least = max(fit.values.max(initial=0.0), 0.0) * dimension * 1e-15
    used = int((fit.values[:shown] > least).sum())
    trace, error = float(fit.values.sum()), identity_error(fit_rows, fit, used)
    explained = [float(e / trace) if used else None for e in fit.values[:shown]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, count = unpack(batch.column(1), dimension), batch.num_rows
            white = np.full((count, shown), np.nan)
            white[:, :used] = _project(x, fit, used)
            every = np.repeat(np.arange(count), shown)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, shown + 1), count), pa.int32()),
                pa.array(np.full(len(every), fit.n), pa.int64()),
                pa.array(_deviation(x, fit.n, fit.sums), pa.int64()).take(pa.array(every)),
                pa.array(white.ravel(), pa.float64(), from_pandas=True),
                pa.array(explained * count, pa.float64()), pa.array([error] * len(every), pa.float64())],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return packed.mapInArrow(run, f"`{key}` long, component int, n long, deviation long, whitened double, "
                                  "explained double, identity_error double")
