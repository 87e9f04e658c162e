"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries become whole numbers, x = floor(64 * c) + 1000000. The fit list holds each distinct
x vector once. Two passes over it give its mean and its scatter about the mean rounded to
whole numbers; both are sums of whole numbers, so they are exact and do not depend on how
rows are dealt, and the rest of the mean is taken off exactly too. The scatter is factored
by Cholesky with the largest remaining diagonal as pivot; one-sided Jacobi rotates the
columns of that triangular factor until they are orthogonal. Their squared norms are the
eigenvalues, the normalised columns the components.

What reaches the driver is the mean and a matrix of dimension x dimension, at any number of
rows; tasks send one such matrix each to the shuffle.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_arrow, small_batches

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 39)  # entries from here on have no exact place on the grid
COMPONENTS = 16
_EXACT = float(1 << 53)


def grid(v: Column) -> Column:
    """The whole-number vector of an array of numbers."""
    return F.transform(v, lambda c: (F.floor(c * SCALE) + SHIFT).cast("long"))


def usable(v: Column) -> Column:
    """False or null for a null vector and one with a null, non-finite or huge entry."""
    return F.forall(v, lambda c: F.abs(c) < F.lit(LARGEST))


def _rows(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summed(table: DataFrame, dim: int, size: int, start: Callable, add: Callable,
            kind: str) -> list:
    """Sums of ``size`` numbers over the vectors of ``table``: every task adds its batches
    into one vector of sums, which meet in a shuffle keyed by their place."""
    small_batches(table.sparkSession)
    value = pa.decimal128(38, 0) if kind.startswith("decimal") else pa.float64()

    def run(batches):
        total = start()
        for batch in batches:
            if batch.num_rows:
                total = total + add(_rows(batch.column(0), dim))
        v = [Decimal(int(x)) for x in total] if value != pa.float64() else total
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(v, value)], names=["at", "v"])

    sums = table.select("x").mapInArrow(run, f"at int, v {kind}").groupBy("at").agg(
        F.sum("v").alias("v")).collect()
    out = [0] * size
    for r in sums:
        out[r["at"]] = int(r["v"]) if value != pa.float64() else r["v"]
    return out


def _products(z: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, exact at any size of the entries."""
    top = float(np.abs(z).max(initial=0))
    if top * top * len(z) < _EXACT:
        f = z.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    z = z.astype(object)
    return z.T @ z


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G with a = G G^T, triangular but for the order of its rows; as many columns as the
    rank shows in double precision."""
    a, d = a.copy(), len(a)
    g = np.zeros((d, d))
    left = np.diag(a).copy()
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = int(left.argmax())
        if left[p] <= least:
            return g[:, :k]
        g[:, k] = (a[:, p] - g[:, :k] @ g[p, :k]) / np.sqrt(left[p])
        g[left == -np.inf, k] = 0.0  # rows chosen before
        g[p, k] = np.sqrt(left[p])
        left = left - g[:, k] ** 2
        left[p] = -np.inf
    return g


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of 0 .. n-1 in rounds of disjoint pairs (round robin)."""
    seats = list(range(n)) + ([-1] if n % 2 else [])
    out, half = [], len(seats) // 2
    for _ in range(len(seats) - 1):
        pairs = [(min(p), max(p)) for p in zip(seats[:half], seats[half:][::-1]) if -1 not in p]
        out.append((np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def jacobi(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``g`` rotated in pairs until all are orthogonal."""
    g = g.copy()
    n = g.shape[1]
    rounds, tol = _rounds(n), np.finfo(float).eps * max(4, n)
    for _ in range(sweeps):
        worst = 0.0
        for i, j in rounds:
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > tol
            i, j, a, b = i[turn], j[turn], a[:, turn], b[:, turn]
            zeta = (bb[turn] - aa[turn]) / (2 * ab[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = c * a - c * t * b, c * t * a + c * b
        if worst <= tol:
            return g
    raise ArithmeticError(f"columns not orthogonal after {sweeps} sweeps: {worst:g}")


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, components as rows) of a covariance. The largest entry of
    every component is positive."""
    g = jacobi(pivoted_cholesky(v))
    e = (g * g).sum(0)
    order = np.argsort(-e, kind="stable")
    u = (g / np.sqrt(e)).T[order]
    return e[order], u * np.sign(u[np.arange(len(u)), np.abs(u).argmax(1)])[:, None]


@dataclasses.dataclass(frozen=True)
class Whitening:
    n: int  # vectors of the fit list
    sums: tuple[int, ...]  # their sum in every dimension
    values: np.ndarray
    components: np.ndarray  # a row each
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of grid vectors."""
        base = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n / self.n for s in self.sums])
        return ((x - base).astype(float) - rest) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sum)^2, exact; None where no long holds it."""
        base = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n for s in self.sums])
        z = x - base
        about = (((z.astype(float)) * self.n - rest) ** 2).sum(1)
        small = about < 2.0**62
        y = np.where(small[:, None], z, 0) * self.n - rest
        out = (y * y).sum(1).tolist()
        for i in np.flatnonzero(~small):
            exact = sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(z[i], rest))
            out[i] = exact if exact < 1 << 63 else None
        return out


def _grid_rows(rows: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    v = F.col(column).cast("array<double>")
    return rows.select(F.struct(*(keep or ["*"])).alias("row"), v.alias("v")).where(usable(F.col("v"))).select(
        "row", grid(F.col("v")).alias("x"))


def fit_list(rows: DataFrame, column: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """The distinct grid vectors as a table, and their dimension: that of most of them."""
    x = scratch.table(_grid_rows(rows, column).select("x").distinct(), "fit-list")
    most = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    return x.where(F.size("x") == dim), dim


def fit(x: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list; None if it has no vector or no spread at all."""
    n, *sums = _summed(x, dim, dim + 1, lambda: np.zeros(dim + 1, object), lambda a: np.array(
        [len(a), *a.sum(0).tolist()], object), "decimal(38,0)") if dim else [0]
    if n == 0:
        return None
    base = np.array([s // n for s in sums])
    g = _summed(x, dim, dim * dim, lambda: np.zeros(dim * dim, object),
                lambda a: _products(a - base).ravel(), "decimal(38,0)")
    rest = [s % n for s in sums]
    cov = np.array([[(n * g[i * dim + j] - rest[i] * rest[j]) / (n * n) for j in range(dim)]
                    for i in range(dim)])
    if not np.diag(cov).any():
        return None
    values, u = eigen(cov)
    return Whitening(n, tuple(sums), values[:components], u[:components], float(np.trace(cov)))


def identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|, measured on it."""
    k = len(model.values)

    def add(a: np.ndarray) -> np.ndarray:
        w = model.apply(a)
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    s = np.array(_summed(x, model.dim, k + k * k, lambda: np.zeros(k + k * k), add, "double"))
    mean = s[:k] / model.n
    return float(np.abs(s[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening, column: str = "embedding",
              keep: list[str] | None = None) -> DataFrame:
    """(row, whitened array<double>, deviation) of the rows with a usable vector of the
    model's dimension; ``row`` is a struct of the columns ``keep`` (all)."""
    dim, k = model.dim, len(model.values)
    x = _grid_rows(rows, column, keep).where(F.size("x") == dim)

    def one(batch: pa.RecordBatch):
        a = _rows(batch.column("x"), dim)
        w = model.apply(a)
        yield {"row": batch.column("row"), "deviation": model.deviations(a),
               "whitened": pa.ListArray.from_arrays(
                   pa.array(np.arange(len(a) + 1) * k, pa.int32()), pa.array(w.ravel()))}

    schema = x.select("row").schema.add(
        "whitened", T.ArrayType(T.DoubleType())).add("deviation", "long")
    return map_arrow(x, one, schema)


def evaluate(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for
    every vector and component of ``COMPONENTS`` at most.

    Vectors that are null or hold a null, non-finite or huge entry (2^39 and more) take no
    part, nor those with another number of entries than most of the distinct ones (ties: the
    smaller number). Repeated rows are returned each and fitted once; a null vec_id is kept.
    Components without variance are left out, so a table whose vectors are all equal, like
    an empty one, gives an empty result. ``deviation`` is null where no long holds it. Equal
    eigenvalues keep the order of the rotation. Other columns are ignored.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("v"))
    x, dim = fit_list(rows, "v", Scratch(spark))
    model = fit(x, dim)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, "
                                     "whitened double, explained double, identity_error double")
    error = identity_error(x, model)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return transform(rows, model, "v", ["vec_id"]).select(
        F.col("row.vec_id").alias("vec_id"), "deviation", F.posexplode("whitened").alias(
            "at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"))
