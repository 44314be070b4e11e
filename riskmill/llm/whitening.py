"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V are found without making V: every step multiplies V by a narrow block Q,
as one pass over all rows that sums the outer products of the centred rows with their coordinates in Q. A Chebyshev
polynomial in V, built by its three-term recurrence, damps the part of the spectrum below the block and raises the rest.
QR and Rayleigh-Ritz follow, and this goes on until the residuals of the wanted pairs certify them.

Tasks return sums of a width by the block's; other tasks add them up by rows, or the driver if all tasks' sums together
are at most 16 MB. The driver holds blocks of a vector's length by the block's width, never rows. Sums and centring are
exact: entries are whole numbers, and n times an entry less the sum is made before the division by n.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.llm.common import map_batches
from riskmill.sources.workspace import stage

COMPONENTS = 32
GUARD = 20  # more columns in the block than components: they set the filter's edge and carry close neighbours
DEGREE = 16
MOST_GAIN = 1e10  # of the filter in one round; a lower degree is taken if it would be more
TOLERANCE = 1e-13  # of the residuals, as a share of the largest eigenvalue
ROUNDS = 60
LEAST = 1e-11  # eigenvalues below this share of the largest one are zero to rounding and have no component
SCALE, SHIFT = 64, 1_000_000  # a whole number x stands for each entry: floor(64 c) + 1,000,000
LARGEST = 2**40  # entries beyond it are taken as it
TO_DRIVER = 2**24  # bytes of all tasks' sums up to which the driver adds them up


# --- Rows ---------------------------------------------------------------------------------------------


def whole_entries(vectors: DataFrame) -> DataFrame:
    """vec_id, x of the vectors without NULL and non-finite entries, and of the most common length (the longer, if two are)."""

    def convert(batch: pa.RecordBatch) -> dict:
        rows = []
        for vector in batch.column(1).to_pylist():
            usable = vector is not None and None not in vector and np.isfinite(vector).all()
            x = np.clip(np.floor(SCALE * np.array(vector, np.float64)), -LARGEST, LARGEST) + SHIFT if usable else None
            rows.append(None if x is None else x.astype(np.int64))
        return {"vec_id": batch.column(0), "x": pa.array(rows, pa.list_(pa.int64()))}

    entries = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = stage(map_batches(entries, convert, "vec_id bigint, x array<bigint>").filter("x IS NOT NULL"), "whole-entries")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("x") == lengths[0]["d"]) if lengths else rows


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


@dataclass
class Fitted:
    """Number of rows, sums per dimension (exact), and the trace of the covariance."""

    n: int
    sums: list[int]
    trace: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: as 64-bit integers if they are sure to fit, else as Python's."""
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums)) < 2**63:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares; NULL beyond a long."""
    if deviations.dtype == object or int(np.abs(deviations).max(initial=0)) ** 2 * max(1, deviations.shape[1]) >= 2**63:
        return [s if s < 2**63 else None for s in (sum(int(v) ** 2 for v in row) for row in deviations.tolist())]
    return (deviations**2).sum(axis=1).tolist()


def _sums(rows: DataFrame) -> Fitted:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                part = _matrix(batch.column(0)).sum(axis=0).astype(object)
                total, n = part if total is None else total + part, n + batch.num_rows
        if total is not None:
            values = [Decimal(int(v)) for v in total]
            columns = [pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38, 0)), pa.array([n] * len(values), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["i", "s", "n"])

    parts = rows.select("x").mapInArrow(add, "i int, s decimal(38,0), n bigint").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    found = parts.orderBy("i").collect()
    return Fitted(found[0]["n"], [int(r["s"]) for r in found]) if found else Fitted(0, [])


def summed(rows: DataFrame, shared, work: Callable[[np.ndarray, object], np.ndarray], entries: int) -> np.ndarray:
    """The sum over all rows' matrices of ``work(x, shared.value)``, a matrix of so many entries.

    Each task sends its sum row by row; they are added up in the order of the tasks, by tasks that the rows are dealt
    to or, if they are small together, by the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = None, -1
        for batch in batches:
            if batch.num_rows:
                task = batch.column(1)[0].as_py()
                part = work(_matrix(batch.column(0)), shared.value)
                total = part if total is None else total + part
        if total is not None:
            size = len(total)
            columns = [pa.array(range(size), pa.int32()), pa.array([task] * size, pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "task", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, values in zip(batch.column(0).to_pylist(), _matrix(batch.column(2)), strict=True):
                totals[i] = totals[i] + values if i in totals else values
        columns = [pa.array(totals, pa.int32()), pa.array(list(totals.values()), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["i", "v"])

    parts = rows.select("x", F.spark_partition_id().alias("task")).mapInArrow(partial, "i int, task int, v array<double>")
    if rows.rdd.getNumPartitions() * entries * 8 <= TO_DRIVER:
        found = parts.toArrow().sort_by([("task", "ascending"), ("i", "ascending")])
        whole = _matrix(found["v"].combine_chunks())
        return whole.reshape(-1, found["i"].to_numpy().max() + 1, whole.shape[1]).sum(axis=0)
    dealt = parts.repartition("i").sortWithinPartitions("i", "task")
    found = dealt.mapInArrow(add, "i int, v array<double>").toArrow()
    order = np.argsort(found["i"].to_numpy())
    return _matrix(found["v"].combine_chunks())[order]


# --- Eigenvectors -------------------------------------------------------------------------------------


def _times_covariance(rows: DataFrame, fitted: Fitted) -> Callable[[np.ndarray], np.ndarray]:
    """Q -> V Q, in one pass over the rows."""

    def work(x: np.ndarray, shared: tuple[Fitted, np.ndarray]) -> np.ndarray:
        fit, q = shared
        z = fit.centred(x)
        return z.T @ (z @ q)

    def times(q: np.ndarray) -> np.ndarray:
        shared = rows.sparkSession.sparkContext.broadcast((fitted, q))
        out = summed(rows, shared, work, q.size) / fitted.n
        shared.unpersist()
        return out

    return times


def _degree(top: float, edge: float) -> int:
    """The highest degree at which the filter raises the top of the spectrum by MOST_GAIN at most."""
    place = 2 * top / edge - 1
    growth = math.log(place + math.sqrt(place * place - 1)) if place > 1 else 0.0
    return DEGREE if growth == 0.0 else max(1, min(DEGREE, int(math.log(2 * MOST_GAIN) / growth)))


def _filtered(times: Callable, q: np.ndarray, vq: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The Chebyshev polynomial of V that stays within 1 on [0, edge], applied to ``q``; ``vq`` is V times ``q``.

    ``q`` holds Ritz vectors, so each column grows about alike; columns are scaled to their own length at the end.
    """
    half = values[-1] / 2
    before, now = q, vq / half - q
    for _ in range(_degree(values[0], values[-1]) - 1):
        before, now = now, 2 * (times(now) / half - now) - before
    return now / np.linalg.norm(now, axis=0)


def leading(times: Callable[[np.ndarray], np.ndarray], dimension: int, components: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns.

    Certified: the residual of each pair is below TOLERANCE times the largest value, or, if rounding keeps it above
    that, no longer falls. A residual bounds an eigenvalue's error by its square over the gap.
    """
    width = min(dimension, components + GUARD)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimension, width)))[0]
    vq = times(q)
    best, idle = math.inf, 0
    for _ in range(ROUNDS):
        ritz, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = ritz[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        if values[0] <= 0:
            break
        wanted = min(components, width)
        residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / values[0]
        idle = idle + 1 if residual > best / 4 else 0
        best = min(best, residual)
        if residual <= TOLERANCE or width == dimension and residual < 1e-9 or residual < 1e-10 and idle >= 2:
            break
        if values[-1] <= LEAST * values[0]:  # the block holds all of the spectrum that isn't zero
            raised = vq / np.maximum(values, LEAST * values[0])
        else:
            raised = _filtered(times, q, vq, values)
        q = np.linalg.qr(raised)[0]
        vq = times(q)
    else:
        raise RuntimeError(f"not certified after {ROUNDS} rounds: residual {best:.1e}")
    kept = values[:components] > LEAST * max(values[0], 0.0)
    return values[:components][kept], q[:, :components][:, kept]


# --- Whitened vectors ---------------------------------------------------------------------------------

WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per vector and component.

    Vectors that are NULL or hold NULL or non-finite entries, and those of another length than most, are left out. Each
    entry c is taken as floor(64 c) + 1,000,000 (at most 2**40 away from 1,000,000). Components are numbered from 1 by
    falling eigenvalue; those whose eigenvalue is zero to rounding have no rows. ``deviation`` is the exact sum of
    (n x - S)**2, NULL beyond a long; ``explained`` the eigenvalue's share of the trace; ``identity_error`` the largest
    entry by which the covariance of all whitened vectors differs from the identity.

    NULL and repeated vec_ids are vectors of their own; other columns are ignored; an empty table, or equal vectors
    only, give no rows.
    """
    rows = whole_entries(vectors)
    fitted = _sums(rows)
    if not fitted.n or not fitted.sums:
        return rows.sparkSession.createDataFrame([], WHITENED)
    context = rows.sparkSession.sparkContext

    def square_sum(x: np.ndarray, fit: Fitted) -> np.ndarray:
        return np.array([[(fit.centred(x) ** 2).sum()]])

    fitted.trace = float(summed(rows, context.broadcast(fitted), square_sum, 1)[0, 0]) / fitted.n
    if fitted.trace <= 0:
        return rows.sparkSession.createDataFrame([], WHITENED)
    values, basis = leading(_times_covariance(rows, fitted), len(fitted.sums), components)
    scaled = basis / np.sqrt(values)
    width = len(values)

    def moments(x: np.ndarray, shared: tuple[Fitted, np.ndarray]) -> np.ndarray:
        w = shared[0].centred(x) @ shared[1]
        return np.vstack([w.T @ w, w.sum(axis=0)])

    shared = context.broadcast((fitted, scaled))
    sums = summed(rows, shared, moments, width * (width + 1)) / fitted.n
    covariance = sums[:width] - np.outer(sums[width], sums[width])
    error = float(np.abs(covariance - np.eye(width)).max())
    shares, number_of_rows = values / fitted.trace, fitted.n

    def project(batch: pa.RecordBatch) -> dict:
        fit, axes = shared.value
        x = _matrix(batch.column(1)) if batch.num_rows else np.empty((0, len(fit.sums)), np.int64)
        deviations = fit.deviations(x)
        w = (deviations / fit.n).astype(np.float64) @ axes
        number = np.repeat(np.arange(len(x)), width)
        return {
            "vec_id": batch.column(0).take(pa.array(number)),
            "component": pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
            "n": pa.array(np.full(len(number), number_of_rows, np.int64)),
            "deviation": pa.array(squares(deviations), pa.int64()).take(pa.array(number)),
            "whitened": pa.array(w.reshape(-1)),
            "explained": pa.array(np.tile(shares, len(x))),
            "identity_error": pa.array(np.full(len(number), error)),
        }

    return map_batches(rows, project, WHITENED)
