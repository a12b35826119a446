"""Whitening of embeddings with refined eigenvectors.

Method: vectors become whole numbers, so sums and products are exact and do not depend on the order of tasks. Tasks add up
products of vectors centred at the whole number next to the mean; the driver gets one matrix of the dimension's size and
takes the rest of the mean off as an exact fraction. The eigenvectors of that covariance are found in float32 and corrected
by Ogita and Aishima's iteration, which needs matrix products only: in float64 until it stands still, then in extended
precision. Eigenvalues too close to each other for the correction are solved again as a small problem of their own, shifted
by their mean, in which their distances are large again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

EXACT = 2.0**53  # whole numbers below are exact in a double
HALF = 32  # bits of the lower half of a sum that is sent in two parts
ROUNDS = 40  # iterations at most; some six are usual


def whole_vectors(vectors: DataFrame, scale: int, *more: str) -> DataFrame:
    """vec_id, x, further columns: x is floor(scale * component) of every row, filled with zeros to the longest vector.

    Vectors that are NULL or hold a NULL or non-finite component take no part, nor do those whose numbers exceed a long.
    """
    scaled = F.expr(f"transform(embedding, c -> floor({scale} * cast(c AS double)))")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"), *more)
    fits = f"forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(cast(c AS double)) < {2.0**61} / {scale})"
    rows = rows.where(f"embedding IS NOT NULL AND {fits}")
    size = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    filled = F.slice(F.concat(scaled, F.array_repeat(F.lit(0).cast("long"), size)), 1, size) if size else F.array().cast("array<long>")
    return rows.select("vec_id", filled.alias("x"), *more)


def _matrices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        at = batch.column(batch.schema.get_field_index(column))
        yield batch, at.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), size)


def _products(y: np.ndarray) -> np.ndarray:
    """Exact y' y as Python integers; by floating point where every sum stays below 2^53."""
    out = np.zeros((y.shape[1],) * 2, object)
    most = float(np.abs(y).max(initial=0)) ** 2
    if most >= EXACT:
        return out + y.astype(object).T @ y.astype(object)
    step = max(1, int(EXACT / max(most, 1)))
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(float)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def _summed(fit: DataFrame, size: int, shift: list[int] | None) -> np.ndarray:
    """Exact sums over the vectors of ``fit``: of the vectors, or of the products of those less ``shift``.

    A task sends one row per line of its matrix, in three parts of 32 bits; parts are added where lines meet, so the driver
    gets the matrix once.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1, size) if shift is None else (size, size), object)
        for _, x in _matrices(batches, "x", size):
            total = total + (x.astype(object).sum(0, keepdims=True) if shift is None else _products(x - np.array(shift, np.int64)))
        low, rest = total & (1 << HALF) - 1, total >> HALF
        parts = [pa.array([r.tolist() for r in p], pa.list_(pa.int64())) for p in (rest >> HALF, rest & (1 << HALF) - 1, low)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *parts], names=["line", "p2", "p1", "p0"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            parts = np.stack([batch.column(i).flatten().to_numpy().reshape(batch.num_rows, size) for i in (1, 2, 3)], 1)
            for line, p in zip(batch.column(0).to_pylist(), parts):
                held[line] = held[line] + p if line in held else p.copy()
        made = [pa.array([h[i].tolist() for h in held.values()], pa.list_(pa.int64())) for i in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), *made], names=["line", "p2", "p1", "p0"])

    schema = "line int, p2 array<long>, p1 array<long>, p0 array<long>"
    found = fit.select("x").mapInArrow(add, schema).repartition(F.col("line")).mapInArrow(meet, schema).collect()
    out = np.zeros((1, size) if shift is None else (size, size), object)
    for r in found:
        for weight, part in ((2 * HALF, r.p2), (HALF, r.p1), (0, r.p0)):
            out[r.line] += np.array([v << weight for v in part], object)
    return out


def covariance(fit: DataFrame, size: int) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """Rows n, sums S, and the covariance (divisor n) of ``fit`` as a double and what that leaves of the exact fraction."""
    n = fit.count()
    sums = [int(s) for s in _summed(fit, size, None)[0]]
    if not n:
        return 0, sums, np.zeros((size, size)), np.zeros((size, size))
    shift = [(2 * s + n) // (2 * n) for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, shift)], object)  # what centring at whole numbers leaves
    exact = n * _summed(fit, size, shift) - np.outer(rest, rest)
    high = np.array([[int(v) / (n * n) for v in line] for line in exact]).reshape(size, size)
    low = np.zeros_like(high)
    for i in range(size):
        for j in range(size):
            p, q = high[i, j].as_integer_ratio()
            low[i, j] = (int(exact[i, j]) * q - p * n * n) / (q * n * n)
    return n, sums, high, low


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of neighbouring values that are at most ``gap`` apart, in groups of two or more."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > gap) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined_eigen(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of high + low in falling order, and their unit eigenvectors as columns, in extended precision."""
    a64, wide = high, high.astype(np.longdouble) + low
    size = len(high)
    x = np.linalg.eigh(high.astype(np.float32) if size else high)[1].astype(float)
    a, before, still = a64, np.inf, 0
    values = np.zeros(size, a.dtype)
    for _ in range(ROUNDS if size else 0):
        r = np.eye(size, dtype=a.dtype) - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        gap = 2 * (np.abs(s - np.diag(values)).sum(1).max() + np.abs(a).sum(1).max() * np.abs(r).sum(1).max())
        between = values[None, :] - values[:, None]
        far = np.abs(between) > gap
        fix = np.where(far, (off + values[None, :] * r) / np.where(far, between, 1), r / 2)
        x = x + x @ fix
        for group in _clusters(values, gap):
            part, middle = x[:, group], values[group].mean()
            inner = part.T @ (a @ part - middle * part)
            x[:, group] = part @ np.linalg.eigh(((inner + inner.T) / 2).astype(float))[1].astype(a.dtype)
        now = float(np.abs(fix).max())
        if a is not wide:
            if now >= before / 4:  # close eigenvalues keep float64 from settling
                a, x, before = wide, x.astype(np.longdouble), np.inf
            else:
                before = now
            continue
        still = still + 1 if now < 1e-9 else 0
        if still == 2:  # the error is squared each time; twice, as a sub-solve may follow a correction that was already small
            break
    for _ in range(2):  # the last sub-solve is orthogonal in double precision only
        x = x @ (1.5 * np.eye(size, dtype=x.dtype) - x.T @ x / 2)
    values = (x * (wide @ x)).sum(0) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(0))[order]
    lead = np.abs(x).argmax(0) if size else np.zeros(0, int)
    return values[order], x * np.where(x[lead, np.arange(size)] < 0, -1, 1)


@dataclass
class Whitening:
    """A fitted whitening; its size follows the dimension, not the table."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the components
    vectors: np.ndarray  # their unit vectors as columns
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of whole-number vectors (rows of ``x``)."""
        return self._centred(x).astype(float) / self.n @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2; None beyond a long."""
        z = self._centred(x)
        most = max((abs(int(v)) for v in (z.min(initial=0), z.max(initial=0))), default=0)
        if z.dtype != object and most**2 * max(z.shape[1], 1) < 1 << 63:
            return (z * z).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in (sum(int(c) ** 2 for c in row) for row in z)]

    def _centred(self, x: np.ndarray) -> np.ndarray:
        most = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, self.sums), default=0)
        if most < 1 << 63:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)


def fit_whitening(fit: DataFrame, size: int, components: int) -> Whitening:
    """Whitening by the first ``components`` eigenvectors of the covariance of ``fit`` (column x), fewer if its rank is lower."""
    n, sums, high, low = covariance(fit, size)
    values, vectors = refined_eigen(high, low)
    k = int((values[:components] > 1e-12 * max(float(values[0]) if size else 0.0, 0.0)).sum())
    total = float(np.trace(high)) or 1.0
    return Whitening(n, sums, values[:k].astype(float), vectors[:, :k].astype(float), (values[:k] / total).astype(float))


def identity_error(fit: DataFrame, size: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance (divisor n) of the whitened ``fit`` minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    names = [f"m{i}" for i in range(k)] + [f"c{i}_{j}" for i in range(k) for j in range(k)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for _, x in _matrices(batches, "x", size):
            w = model.apply(x)
            total += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=names)

    sums = np.array(fit.select("x").mapInArrow(add, ", ".join(f"{n} double" for n in names)).agg(*(F.sum(n) for n in names)).first()) / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every row and component.

    Fitted on each distinct whole-number vector once; every row that ``whole_vectors`` keeps is returned, repeated rows, rows
    without id and equal vectors included. There are fewer components where the vectors span fewer dimensions, none where all
    are equal, so then, as for an empty table, there are no rows. ``deviation`` is NULL beyond a long. Shorter vectors are
    filled with zeros. Equal eigenvalues share a space; any orthonormal vectors of it may be returned. Extra columns are
    left out.
    """
    rows = whole_vectors(vectors, scale)
    fit = stored(rows.select("x").distinct(), "distinct_vectors")
    size = fit.agg(F.max(F.size("x"))).first()[0] or 0
    model = fit_whitening(fit, size, components)
    error, k = identity_error(fit, size, model), len(model.values)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, "x", size):
            each = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), model.n, np.int64)), pa.array(model.deviation(x), pa.int64()).take(pa.array(each)),
                pa.array(model.apply(x).ravel()), pa.array(np.tile(model.explained, len(x))), pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)
