"""Embedding whitening with a covariance found by polarisation.

Entries become whole numbers, so everything up to the covariance matrix is
exact.  For every dimension, and for the sum of every pair of dimensions, the
squares of the centred values are added up over all vectors; a pair's
covariance is half of what the variance of the sum has over the two single
variances.  The matrix is put together on the driver (its size depends on the
number of dimensions alone) and handed to ``eigh``.

Values are centred in two steps that lose nothing: by the nearest whole number
to the mean before they are squared, and by the remainder of the mean in
arbitrary-precision integers afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# An entry c stands for the whole number floor(64 c) + 1000000.
SCALE, OFFSET = 64, 1_000_000
LARGEST = 4e18          # entries whose scaled value lies beyond are taken for it
EXACT, LIMB = pa.decimal128(38, 0), 10**18


def usable(vector: str) -> Column:
    """Neither null nor empty, and all entries are finite numbers."""
    c = F.col(f"`{vector}`")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(c) > 0) & ~bad, F.lit(False))


def whole_numbers(vectors: pa.Array, dims: int) -> np.ndarray:
    c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def exact_sums(a: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    if a.dtype == object:
        return a.sum(axis=0)
    return (a >> 32).sum(axis=0).astype(object) * (1 << 32) + (a & 0xFFFFFFFF).sum(axis=0).astype(object)


def pair_squares(z: np.ndarray) -> np.ndarray:
    """For each dimension and each sum of two (in the order of ``triu_indices``), the sum of squares."""
    if 4 * float(np.abs(z.astype(np.float64)).max(initial=0)) ** 2 * max(1, len(z)) >= 2.0**62:
        z = z.astype(object)
    out = []
    for i in range(z.shape[1]):
        rest = z[:, i:] + z[:, i:i + 1]
        rest[:, 0] = z[:, i]
        out.append((rest * rest).sum(axis=0).astype(object))
    return np.concatenate(out)


@dataclass
class Whitening:
    """The fitted transform: ``n`` vectors with exact ``sums``, eigenpairs in falling order, and the measured error."""
    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray     # dimensions x components
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The whole number next to each mean, and what is left of the sums."""
        base = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        return base, np.array([s - self.n * int(b) for s, b in zip(self.sums, base)], np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        base, left = self.centre()
        return ((x - base) - left / self.n) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - S) squared, exactly."""
        base, left = self.centre()
        z = x - base
        if (self.n * (float(np.abs(z.astype(np.float64)).max(initial=0)) + 1)) ** 2 * self.dims >= 2.0**62:
            z, left = z.astype(object), left.astype(object)
        y = self.n * z - left
        return (y * y).sum(axis=1)


def _partial(vectors: DataFrame, vector: str, dims: int, sums: Callable[[np.ndarray], np.ndarray], exact: bool = True) -> list:
    """Add up ``sums(x)`` over all vectors: within each task, then by place in Spark; a row a place comes to the driver.

    Exact sums travel as two numbers, so that none outgrows a decimal.
    """
    kind = EXACT if exact else pa.float64()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                got = sums(whole_numbers(batch.column(0), dims))
                total = got if total is None else total + got
        if total is not None:
            halves = zip(*[divmod(int(v), LIMB) for v in total]) if exact else (np.zeros(len(total)), total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), *[as_decimals(h) if exact else pa.array(h, kind) for h in halves]],
                                             names=["place", "high", "low"])

    sql = "decimal(38,0)" if exact else "double"
    parts = vectors.select(F.col(f"`{vector}`")).mapInArrow(add, f"place long, high {sql}, low {sql}")
    found = parts.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return [int(r["high"]) * LIMB + int(r["low"]) if exact else r["low"] for r in sorted(found, key=lambda r: r["place"])]


def as_decimals(values) -> pa.Array:
    """Whole numbers as decimals; null where one has more than 38 digits."""
    return pa.array([str(v) if abs(v) < 10**38 else None for v in values], pa.string()).cast(EXACT)


def remaining(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int, int]:
    """The vectors that count, their number and their dimensions.

    Null and empty vectors and those with a null or non-finite entry go.
    Vectors of different lengths have no common covariance: the commonest
    length stays (of equally common ones the longest).
    """
    kept = vectors.where(usable(vector))
    common = kept.groupBy(F.size(F.col(f"`{vector}`")).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return kept, 0, 0
    return kept.where(F.size(F.col(f"`{vector}`")) == common["dims"]), int(common["count"]), int(common["dims"])


def fit_whitening(vectors: DataFrame, vector: str = "embedding", components: int = 32) -> tuple[DataFrame, Whitening | None]:
    """The vectors that count and their transform (None if there is no vector, or all are equal).

    Components without variance (below the rounding of the largest) can't be
    whitened and are left out, so there may be fewer than ``components``.
    Repeated vectors count each.
    """
    kept, n, dims = remaining(vectors, vector)
    if not n:
        return kept, None
    sums = _partial(kept, vector, dims, exact_sums)
    model = Whitening(n, sums, np.zeros((dims, dims)), np.ones(1), np.zeros((dims, 1)), np.zeros(1))
    base, left = model.centre()
    found = _partial(kept, vector, dims, lambda x: pair_squares(x - base))
    # of n s - S, for s a dimension or a sum of two: n^2 times the squares about the whole number, less n times what was left squared
    rows, cols = np.triu_indices(dims)
    squares = {}
    for at, (i, j) in enumerate(zip(rows.tolist(), cols.tolist())):
        r = int(left[i]) if i == j else int(left[i]) + int(left[j])
        squares[i, j] = n * n * found[at] - n * r * r
    for (i, j), q in squares.items():
        cross = 2 * q if i == j else q - squares[i, i] - squares[j, j]
        model.covariance[i, j] = model.covariance[j, i] = cross / (2 * n**3)
    values, vecs = np.linalg.eigh(model.covariance)
    values, vecs = values[::-1], vecs[:, ::-1]
    good = int((values > max(values[0], 0.0) * dims * 1e-14).sum())
    if not good:
        return kept, None
    good = min(good, components)
    model.values, model.vectors = values[:good], np.ascontiguousarray(vecs[:, :good])
    model.explained = model.values / np.trace(model.covariance)
    found = _partial(kept, vector, dims, lambda x: (lambda w: (w.T @ w).ravel())(model.project(x)), exact=False)
    products = np.array(found).reshape(good, good)
    model.identity_error = float(np.abs(products / n - np.eye(good)).max())
    return kept, model


def whiten(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """Add ``whitened`` (array of double, a value a component) and ``deviation`` (decimal, exact; null
    beyond 38 digits).

    ``vectors`` are those that ``fit_whitening`` gave back, or others that
    pass ``usable`` and have as many entries; input columns of these names are
    replaced.
    """
    @F.arrow_udf("struct<deviation:decimal(38,0),whitened:array<double>>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = whole_numbers(batch, model.dims)
            w = model.project(x)
            d = model.deviation(x)
            d = as_decimals(d.tolist()) if d.dtype == object else pa.array(d).cast(EXACT)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.StructArray.from_arrays([d, lists], ["deviation", "whitened"])

    row = F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row")
    done = vectors.select(row, project(F.col(f"`{vector}`")).alias("done"))
    taken = {"deviation", "whitened"}
    return done.select(*[F.col(f"row.`{c}`") for c in vectors.columns if c.lower() not in taken], F.col("done.deviation"), F.col("done.whitened"))


__all__ = ["Whitening", "fit_whitening", "remaining", "usable", "whiten", "whole_numbers"]
