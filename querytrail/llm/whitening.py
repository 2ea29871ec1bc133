"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors, as whole numbers, are written once in packed blocks.
With ``X`` their rows less the mean, each step makes one distributed pass:

    z = X v_j - U h,  h = U' X v_j,      u_j = z / |z|
    X' u_j = sum over the blocks,        v_(j+1) = what is left of it outside V

A task forms the rows of ``X`` from whole numbers, so the mean is taken off
before anything is multiplied, then its part of ``z`` and of ``X' z``.  ``U`` has
a row for every vector: it is held as ``X C`` with a small matrix ``C``, and a
task makes its rows of ``u_j`` from its rows of ``X``.  Both sides are
orthogonalised again against all earlier vectors (``X' U`` is known from the
steps before).  Only vectors of the embedding's length reach the driver.
The small projected matrix, bidiagonal but for rounding and new starts, gives
the singular values; components and deviations follow from it.

Steps end when the wanted triplets have converged, have done so again after a
new random start (which finds further copies of equal values), or the space is
used up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows of a packed block.
BLOCK_ROWS = 4_096
#: A triplet has converged when its residual is below this share of the
#: largest singular value; what is below :data:`RANK` of it is no component.
TOLERANCE = 1e-13
RANK = 1e-10
SEED = 20_240_611


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, dim, x array<long>)`` with ``floor(scale * c) + shift`` of
    every component.  Rows whose vector is null or empty, or has a null,
    non-finite or (as a long) not representable component are left out."""
    c = F.col("v")
    limit = F.lit(float(2**62) / scale)
    ok = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < limit))
    return (
        df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("v"))
        .where(c.isNotNull() & (F.size(c) > 0) & ok)
        .select("vec_id", F.size(c).alias("dim"), F.transform(c, lambda e: F.floor(e * F.lit(float(scale))) + F.lit(shift)).alias("x"))
    )


# --- packed blocks ----------------------------------------------------------


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


def packed_blocks(vectors: DataFrame, dim: int) -> DataFrame:
    """The distinct vectors of length ``dim``, some rows at a time: ``(base,
    width, block)`` with the rows less their smallest entry in as few bytes
    as hold them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                x = _rows(batch.column(0).slice(lo, BLOCK_ROWS), dim)
                base = int(x.min())
                span = int(x.max()) - base
                width = next((w for w in (1, 2, 4) if span < 1 << (8 * w)), 8)
                raw = (x.view(np.uint64) - np.uint64(base & (2**64 - 1))).astype(f"<u{width}").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([base], pa.int64()), pa.array([width], pa.int32()), pa.array([raw], pa.binary())], ["base", "width", "block"])

    distinct = vectors.where(F.col("dim") == dim).select("x").distinct()
    return distinct.mapInArrow(run, "base long, width int, block binary")


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for base, width, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = np.frombuffer(raw, f"<u{width}").astype(np.uint64) + np.uint64(base & (2**64 - 1))
            yield x.view(np.int64).reshape(-1, dim)


@dataclass
class Centre:
    """The mean of ``n`` whole vectors with the exact sums ``total``."""

    n: int
    total: list[int]

    def __post_init__(self) -> None:
        self.whole = np.array([t // self.n for t in self.total], np.int64)
        self.rest = np.array([(t % self.n) / self.n for t in self.total])

    def rows(self, x: np.ndarray) -> np.ndarray:
        """The rows of ``x`` less the mean; the difference of the whole parts
        is exact, so nothing is lost to the size of the mean."""
        return (x - self.whole).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum over dimensions of (n * x - S) ** 2``, exact; null beyond a long."""
        largest = self.n * float(np.abs(x - self.whole).max(initial=0) + 1)
        if largest < 2**31 and largest**2 * x.shape[1] < 2**62:
            left = self.n * (x - self.whole) - np.array([t % self.n for t in self.total], np.int64)
            return (left * left).sum(1).tolist()
        sums = [sum((self.n * v - t) ** 2 for v, t in zip(row, self.total, strict=True)) for row in x.tolist()]
        return [s if s < 2**63 else None for s in sums]


def _sums(blocks: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "double") -> list:
    """The sum of ``part(x)``, a vector of ``size`` numbers, over all blocks:
    a row per task and place, added up in Spark; ``size`` rows come back."""
    dtype = np.float64 if kind == "double" else object

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size, dtype), False
        for x in _blocks(batches, dim):
            total, some = total + part(x), True
        if some:
            values = pa.array(total) if kind == "double" else pa.array([str(int(t)) for t in total])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), values], ["place", "value"])

    rows = blocks.mapInArrow(run, f"place long, value {'double' if kind == 'double' else 'string'}")
    value = F.col("value") if kind == "double" else F.col("value").cast("decimal(38,0)")
    got = dict(map(tuple, rows.groupBy("place").agg(F.sum(value)).collect()))
    return [got.get(i, 0) for i in range(size)]


# --- bidiagonalisation ------------------------------------------------------


def _outside(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` less its part in the span of ``basis``, orthogonalised twice."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


@dataclass
class Decomposition:
    """``values``: singular values of the centred rows, falling; ``vectors``:
    their right singular vectors, by columns."""

    values: np.ndarray
    vectors: np.ndarray
    steps: int


def bidiagonalise(gram: Callable[[np.ndarray], tuple[float, np.ndarray]], dim: int, wanted: int, tolerance: float = TOLERANCE, seed: int = SEED) -> Decomposition:
    """The ``wanted`` largest singular triplets of an ``n x dim`` matrix ``X``.
    ``gram(c)`` is the pass over the rows: ``|X c|**2`` and ``X' X c``."""
    random = np.random.default_rng(seed)
    V, C, G = (np.empty((dim, 0)) for _ in range(3))  # V; U = X C; X' U
    B = np.empty((0, 0))
    v, settled = _outside(random.standard_normal(dim), V), None
    while V.shape[1] < dim:
        v /= np.linalg.norm(v)
        # U' X v: its part along earlier u, taken off before the pass and after.
        h = G.T @ v
        c = v - C @ h
        square, back = gram(c)
        again = C.T @ back
        if C.shape[1] and np.abs(again).max() > 1e-11 * np.sqrt(square):
            c, h = c - C @ again, h + again
            square, back = gram(c)
        alpha = np.sqrt(square)
        k = V.shape[1]
        V = np.column_stack([V, v])
        if k and alpha <= RANK * 1e-3 * np.linalg.norm(B, 2):
            alpha, c, back = 0.0, np.zeros(dim), np.zeros(dim)  # X v lies in U: v brings no new direction
        elif alpha == 0:
            c, back = np.zeros(dim), np.zeros(dim)
        else:
            c, back = c / alpha, back / alpha
        C, G = np.column_stack([C, c]), np.column_stack([G, back])
        B = np.block([[B, h[:, None]], [np.zeros((1, k)), np.array([[alpha]])]])
        P, s, Qt = np.linalg.svd(B)
        left = G @ P - V @ (B.T @ P)
        residual = np.linalg.norm(left, axis=0)
        v = _outside(back, V)
        if k + 1 == dim:
            break
        if k + 1 > wanted and (residual[: wanted + 1] <= tolerance * s[0]).all():
            if settled is not None and np.allclose(s[:wanted], settled, rtol=1e-10, atol=1e-12 * s[0]):
                break
            settled = s[:wanted].copy()
            v = _outside(random.standard_normal(dim), V)
        if np.linalg.norm(v) <= 1e-12 * max(np.linalg.norm(back), s[0] * 1e-3, 1e-300):
            v = _outside(random.standard_normal(dim), V)  # the space of this start is used up
    _, s, Qt = np.linalg.svd(B)
    keep = min(wanted, int((s > RANK * s[0]).sum())) if s[0] > 0 else 0
    vectors, _ = np.linalg.qr(V @ Qt[:keep].T) if keep else (np.empty((dim, 0)), None)
    return Decomposition(s[:keep], vectors, V.shape[1])


# --- the operator -----------------------------------------------------------


@dataclass
class Whitening:
    """A fitted space of vectors of one length."""

    centre: Centre
    vectors: np.ndarray  # unit components, by columns
    deviations: np.ndarray  # roots of the eigenvalues of the covariance
    explained: np.ndarray
    identity_error: float
    steps: int

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ self.vectors / self.deviations


def fit(vectors: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors of length ``dim`` in the result
    of :func:`whole_vectors`."""
    blocks = written(packed_blocks(vectors, dim), "whitening")
    sums = [int(s) for s in _sums(blocks, dim, lambda x: np.r_[len(x), x.astype(object).sum(0)], dim + 1, "whole")]
    centre = Centre(sums[0], sums[1:])

    def gram(c: np.ndarray) -> tuple[float, np.ndarray]:
        def part(x: np.ndarray) -> np.ndarray:
            rows = centre.rows(x)
            z = rows @ c
            return np.r_[z @ z, z @ rows]

        got = np.array(_sums(blocks, dim, part, dim + 1))
        return got[0], got[1:]

    whole = _sums(blocks, dim, lambda x: np.array([(centre.rows(x) ** 2).sum()]), 1)[0]
    found = bidiagonalise(gram, dim, components)
    values = found.values**2 / centre.n
    fitted = Whitening(centre, found.vectors, np.sqrt(values), values * centre.n / whole if whole else values, 0.0, found.steps)
    k = len(values)
    if k:

        def products(x: np.ndarray) -> np.ndarray:
            y = fitted.whiten(x)
            return np.r_[y.sum(0), (y.T @ y).reshape(-1)]

        got = np.array(_sums(blocks, dim, products, k + k * k)) / centre.n
        covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        fitted.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return fitted


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)`` for every row whose vector takes part and every
    component from 1, by falling variance.

    The fit is over the distinct vectors, so copies have no weight; every row,
    copies and null ids too, gets its values.  Vectors of another length are a
    space of their own, fitted apart.  Components without variance (fewer
    distinct vectors than dimensions, a constant dimension, a single vector)
    are left out.  Components of equal variance may come in any rotation.
    ``deviation`` is null where it exceeds a long.  Empty input gives no rows.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, id_col, vector_col, scale, shift)
    out = None
    # One row for each length of vectors that occurs.
    for dim in sorted(r.dim for r in vectors.select("dim").distinct().collect()):
        fitted = fit(vectors, dim, components)
        part = vectors.where(F.col("dim") == dim).select("vec_id", "x").mapInArrow(_projection(fitted, dim), _RESULT)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], _RESULT) if out is None else out


def _projection(fitted: Whitening, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.deviations)
        for batch in batches if k else ():
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                ids, x = batch.column(0).slice(lo, BLOCK_ROWS), _rows(batch.column(1).slice(lo, BLOCK_ROWS), dim)
                n = len(x)
                each = pa.array(np.repeat(np.arange(n), k))
                deviation = pa.array(fitted.centre.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, fitted.centre.n)),
                        deviation.take(each), pa.array(fitted.whiten(x).reshape(-1)), pa.array(np.tile(fitted.explained, n)),
                        pa.array(np.full(n * k, fitted.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run
