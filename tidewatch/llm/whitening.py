"""Whitening of embeddings, with eigenvectors of their covariance by FEAST contour integration.

Spark makes the moments and the projections over all rows; the covariance, as large as the dimension
squared, comes to the driver. There the wanted part of the spectrum is cut into slices by inertia
counts: of a tridiagonal matrix with the same inertia, the number of negative pivots says how many
eigenvalues lie below a shift. For each slice a block of random vectors goes through the spectral
projector of a circle around it, a quadrature of solves with complex shifts; Rayleigh-Ritz on the
span gives eigenpairs, and the block goes through again until residuals stop falling. A slice must
give as many pairs as its counts say, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.equal_average import finite_vectors

#: Eigenvalues up to this share of the trace are rounding, as the data's whole numbers have no more digits.
RANK = 1e-11
#: A slice with more eigenvalues, or with ends further apart than this ratio, is cut.
SLICE, WIDEST = 12, 10.0
#: Nodes of the quadrature on a half circle, and the most passes of a block.
NODES, PASSES = 8, 40
#: Residuals over the matrix norm that may be the rounding of doubles.
EXACT = 1e-12
#: floor(scale * x) saturates here, where doubles still hold each whole number.
LARGEST = 2**50


# ------------------------------------------------------------------ eigenpairs


class Inertia:
    """Counts the eigenvalues of a symmetric matrix below a shift."""

    def __init__(self, matrix: np.ndarray):
        a = matrix.astype(float)
        for k in range(len(a) - 2):  # reflections to tridiagonal form keep the inertia of all shifts
            v = a[k + 1 :, k].copy()
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            length = v @ v
            if length:
                for part in (a[k + 1 :, :], a[:, k + 1 :].T):
                    part -= np.outer(v, (2 / length) * (v @ part))
        self.diagonal = np.diag(a).copy()
        self.squares = np.diag(a, 1) ** 2
        self.small = np.finfo(float).tiny * max(1.0, float(self.squares.max(initial=0)))

    def below(self, shift: float) -> int:
        negative, pivot = 0, 1.0
        for d, square in zip(self.diagonal, [0.0, *self.squares], strict=False):
            pivot = d - shift - square / pivot
            if abs(pivot) < self.small:
                pivot = -self.small
            negative += pivot < 0
        return int(negative)


def slices(inertia: Inertia, low: float, high: float, most: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of slices that hold the ``most`` largest eigenvalues above ``low``."""
    top = inertia.below(high)
    out, waiting = [], [(low, high, inertia.below(low), top)]
    while waiting:
        a, b, under, upto = waiting.pop()
        if upto == under or upto <= top - most:
            continue
        middle = None
        if b > WIDEST * a or upto - under > SLICE and b - a > 1e-9 * b:
            middle = _gap(inertia, a, b)
        if middle is None:
            out.append((a, b, upto - under))
        else:
            at = inertia.below(middle)
            waiting += [(a, middle, under, at), (middle, b, at, upto)]
    return out


def _gap(inertia: Inertia, a: float, b: float) -> float | None:
    """A place near the middle that is as far from eigenvalues as may be."""
    for clear in (1e-2, 1e-3, 1e-5):
        for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
            x = a * (b / a) ** share
            d = clear * min(x - a, b - x)
            if inertia.below(x - d) == inertia.below(x + d):
                return x
    return None


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, rising, and their vectors as columns."""
    size = len(matrix)
    middle, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 - nodes))
    shifts = [(middle + radius * t) * np.eye(size) - matrix for t in turns]
    scale = np.linalg.norm(matrix)
    block = np.random.default_rng(0).standard_normal((size, min(size, count + max(8, count // 2))))
    best = None
    for _ in range(PASSES):
        projected = sum(
            (w / 2) * (radius * t * np.linalg.solve(s, block)).real
            for w, t, s in zip(weights, turns, shifts, strict=True)
        )
        basis, _ = np.linalg.qr(projected)
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        inside = (values > low) & (values <= high)
        if inside.sum() != count:
            continue
        vectors = block[:, inside]
        residual = np.linalg.norm(matrix @ vectors - vectors * values[inside], axis=0).max()
        if best is not None and residual > best[0] / 2 and best[0] <= EXACT * scale:
            break  # as good as doubles get
        if best is None or residual < best[0]:
            best = (residual, values[inside], vectors)
    if best is None or best[0] > EXACT * scale:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high} were not all found")
    return best[1], best[2]


def largest_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues (those that aren't rounding), falling, and unit vectors as columns."""
    trace = float(np.trace(matrix)) if len(matrix) else 0.0
    if trace <= 0:
        return np.empty(0), np.empty((len(matrix), 0))
    inertia = Inertia(matrix)
    found = [feast(matrix, *s) for s in slices(inertia, RANK * trace, trace * (1 + 1e-9), most)]
    values = np.concatenate([f[0] for f in found])
    vectors = np.concatenate([f[1] for f in found], axis=1)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[:, order]


# ------------------------------------------------------------------ moments over Spark


@dataclass
class Fit:
    """Whole-number moments of the vectors: their number and the sum of each dimension."""

    n: int
    sums: list[int]
    scale: float
    offset: int

    def __post_init__(self) -> None:
        self.floor = np.array([s // self.n for s in self.sums], np.int64)
        self.over = np.array([s % self.n for s in self.sums], object)

    def whole(self, batch: pa.RecordBatch) -> np.ndarray:
        return whole_numbers(batch, len(self.sums), self.scale, self.offset)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the whole part of the mean is taken off exactly."""
        return (x - self.floor).astype(float) - (self.over / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)^2, exact."""
        away = x - self.floor
        most = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if most * most * len(self.sums) < 2**63:
            y = self.n * away - self.over.astype(np.int64)
            return pa.array(np.einsum("ij,ij->i", y, y)).cast(pa.decimal128(38, 0))
        y = self.n * away.astype(object) - self.over
        exact = (int(v) for v in (y * y).sum(axis=1))
        return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def whole_numbers(batch: pa.RecordBatch, dimension: int, scale: float, offset: int) -> np.ndarray:
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    return np.clip(np.floor(scale * values), -LARGEST, LARGEST).astype(np.int64) + offset


def fitted(kept: DataFrame, dimension: int, scale: float, offset: int) -> Fit:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(dimension, object), 0
        for batch in batches:
            x = whole_numbers(batch, dimension, scale, offset)
            high, low = (x >> 24).sum(axis=0), (x & 0xFFFFFF).sum(axis=0)  # sums of any batch fit
            sums += high.astype(object) * 2**24 + low.astype(object)
            n += len(x)
        if n:
            totals = pa.array([Decimal(s) for s in sums], pa.decimal128(28, 0))
            yield pa.RecordBatch.from_pydict({"place": np.arange(dimension), "total": totals, "n": np.full(dimension, n)})

    parts = kept.select("vector").mapInArrow(run, "place long, total decimal(28,0), n long")
    rows = parts.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r["place"])  # as many as dimensions
    return Fit(rows[0]["n"], [int(r["total"]) for r in rows], scale, offset)


def _products(kept: DataFrame, n: int, size: int, rows_of) -> np.ndarray:
    """Covariance, with divisor n, of ``rows_of(batch)`` (rows, size) over all of ``kept``.

    A task centres its rows by their own mean before it multiplies; the means' products come on top.
    """
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, square = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            y = rows_of(batch)
            own = y.mean(axis=0)
            shift, both = own - mean, count + len(y)
            y = y - own
            square += y.T @ y + np.outer(shift, shift) * (count * len(y) / both)
            mean += shift * (len(y) / both)
            count = both
        if count:
            yield pa.RecordBatch.from_pydict({
                "i": i, "j": j, "within": square[i, j], "n": np.full(len(i), float(count)),
                "x": mean[i], "y": mean[j],
            })

    parts = kept.select("vector").mapInArrow(run, "i long, j long, within double, n double, x double, y double")
    rows = parts.groupBy("i", "j").agg(
        F.sum("within").alias("within"), F.sum(F.col("n") * F.col("x") * F.col("y")).alias("between"),
        F.sum(F.col("n") * F.col("x")).alias("x"), F.sum(F.col("n") * F.col("y")).alias("y"),
    )
    out = np.zeros((size, size))
    for r in rows.collect():  # as many as the matrix has entries
        value = (r["within"] + r["between"] - r["x"] * r["y"] / n) / n
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = value
    return out


def whitened(
    df: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000
) -> DataFrame:
    """Per vector of ``df`` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened,
    explained and identity_error.

    Entries become x = floor(scale * c) + offset. Components are unit eigenvectors of x's covariance
    (divisor n) by falling eigenvalue e; ``whitened`` is x - S / n on a component over sqrt(e),
    ``deviation`` (decimal) the sum of (n * x - S)^2, ``explained`` e over the trace, and
    ``identity_error`` the largest entry of |covariance of all whitened rows - identity|.

    Edge cases: rows whose vector is null, empty, or holds a null, NaN or infinite entry are dropped,
    and so are those of another length than the most frequent one (of ties the longest). There are at
    most as many components as the covariance has eigenvalues over ``RANK`` of its trace, so equal or
    single vectors give no rows. Of equal eigenvalues any vectors of their space come. Entries
    saturate at 2^50, and a deviation beyond 38 digits is null. Repeated rows and null vec_ids count
    and come back. An empty table gives an empty one. Other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    vectors = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    vectors = finite_vectors(vectors, "vector")
    usual = vectors.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    dimension = usual["size"]
    kept = vectors.where(F.size("vector") == dimension)
    fit = fitted(kept, dimension, scale, offset)
    covariance = _products(kept, fit.n, dimension, lambda batch: fit.centred(fit.whole(batch)))
    values, axes = largest_eigenpairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    axes = axes / np.sqrt(values)
    found = _products(kept, fit.n, len(values), lambda batch: fit.centred(fit.whole(batch)) @ axes)
    error = float(np.abs(found - np.eye(len(values))).max())
    explained = values / np.trace(covariance)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            x = fit.whole(batch)
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(rows)),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "n": np.full(len(rows), fit.n),
                "deviation": fit.deviations(x).take(pa.array(rows)),
                "whitened": (fit.centred(x) @ axes).ravel(),
                "explained": np.tile(explained, len(x)),
                "identity_error": np.full(len(rows), error),
            })

    return kept.mapInArrow(project, schema)
