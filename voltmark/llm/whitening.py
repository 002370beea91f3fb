"""Whitening of embeddings: each vector in the principal axes of all of them, with unit variance along each.

The covariance is summed on Spark from centred vectors. Its leading eigenvalues come from Householder's
tridiagonal form by bisection with Sturm counts, its eigenvectors from inverse iteration, in which those of close
eigenvalues are kept orthogonal. The matrix has the square of the *dimension* of the vectors, however many there are,
so this part is done once, on the driver. The axes are broadcast and every vector is projected on them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmark.llm.scratch import small_batches

#: Entries become ``floor(SCALE * c) + OFFSET``.
SCALE, OFFSET = 64, 1_000_000
#: An eigenvalue below this part of the greatest can't be told from 0 in double precision.
NEGLIGIBLE = 2.0**-36
_SAFE = 2**62


@dataclass
class Fit:
    """Vectors of one length: their number, the sums of their entries (without ``OFFSET``) and, once solved, the axes."""

    n: int
    sums: list[int]
    #: Eigenvectors over the roots of their eigenvalues, one column each; NaN where the eigenvalue is negligible.
    axes: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0


def whitened(vectors: DataFrame, components: int = 32, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, component int, n long, deviation long, whitened double, explained double, identity_error double``:
    a row for each usable vector and each of the first ``components`` components (as many as the vectors are long, at most).

    A vector is left out if it is null or an entry is null, not finite, or so large that ``floor(64 c) + 1000000`` is no
    long. The entries of the others become those integers ``x``, with ``n`` vectors and sums ``S`` in each dimension.

    * ``deviation``: sum over all dimensions of ``(n x - S)^2``, exact; null if that is no long.
    * ``whitened``: ``x - S / n`` on the component, over the root of its eigenvalue. Null if the eigenvalue is below 2^-36 of
      the greatest, as with constant vectors or fewer vectors than components: nothing varies there that could be scaled.
    * ``explained``: eigenvalue over the trace of the covariance (divisor ``n``); 0 if nothing varies.
    * ``identity_error``: largest absolute entry of the covariance of ``whitened`` minus the identity, measured on
      the projected vectors, over the components that are not null.

    Repeated rows and ids count each for itself, a null id stays null, other columns are not read. Vectors of
    different lengths can't share axes: each length is whitened by itself, with its own ``n``; an empty
    vector has no component and so no row. An empty table gives an empty result.

    The table is read four times: for the sums, the covariance, the covariance of the result, the result. What a task
    sends is of the size of one covariance matrix, and there are four tasks for each core at most, however large the table.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding")
    )
    # Tasks read several files rather than send a matrix for each.
    few = rows.select("embedding").coalesce(4 * spark.sparkContext.defaultParallelism)
    fits = _sums(few)
    for length, matrix in _matrices(few, fits, _centred_rows).items():
        fits[length].axes, fits[length].explained = axes(matrix, components)
    for length, matrix in _matrices(few, fits, _whitened_rows).items():
        # The axes are the same for all rows, so null components are all null.
        real = ~np.isnan(fits[length].axes).any(axis=0)
        error = np.abs(matrix - np.eye(len(matrix)))[np.ix_(real, real)]
        fits[length].identity_error = float(error.max()) if error.size else 0.0
    return _projected(rows, fits)


def usable(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vector: the length, the rows that hold a usable one, and ``floor(64 c)`` of their entries."""
    lengths = np.diff(column.offsets.to_numpy()) * column.is_valid().to_numpy(zero_copy_only=False)
    first, last = column.offsets.to_numpy()[[0, -1]]
    starts = column.offsets.to_numpy()[:-1] - first
    entries = column.values.slice(first, last - first).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * entries)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) < 2.0**63 - 2.0**21))])
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[starts + lengths] == bad[starts])
    for length in np.unique(lengths[good]):
        at = np.flatnonzero(good & (lengths == length))
        if length:
            yield int(length), at, scaled[starts[at][:, None] + np.arange(length)].astype(np.int64)


def _sums(rows: DataFrame) -> dict[int, Fit]:
    def run(batches):
        found: dict[int, Fit] = {}
        for batch in batches:
            for length, at, x in usable(batch.column("embedding")):
                x = x if len(x) * int(np.abs(x).max()) < _SAFE else x.astype(object)
                fit = found.setdefault(length, Fit(0, [0] * length))
                fit.n += len(at)
                fit.sums = [a + int(b) for a, b in zip(fit.sums, x.sum(axis=0), strict=True)]
        for length, fit in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * length, pa.int32()),
                    pa.array(range(length), pa.int32()),
                    pa.array([fit.n] * length, pa.int64()),
                    pa.array([Decimal(s) for s in fit.sums], pa.decimal128(38, 0)),
                ],
                names=["length", "i", "n", "s"],
            )

    parts = rows.mapInArrow(run, "length int, i int, n long, s decimal(38,0)")
    total = parts.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))
    fits: dict[int, Fit] = {}
    for row in total.orderBy("length", "i").collect():  # as many rows as the vectors have dimensions
        fits.setdefault(row.length, Fit(row.n, [])).sums.append(int(row.s))
    return fits


def _centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """``n x - S``, exact: 64-bit integers, or Python's where those could overflow."""
    if fit.n * int(np.abs(x).max()) + max(map(abs, fit.sums)) < _SAFE:
        return fit.n * x - np.array(fit.sums, np.int64)
    return fit.n * x.astype(object) - np.array(fit.sums, object)


def _centred_rows(x: np.ndarray, fit: Fit) -> np.ndarray:
    return _centred(x, fit).astype(np.float64) / fit.n


def _whitened_rows(x: np.ndarray, fit: Fit) -> np.ndarray:
    return _centred_rows(x, fit) @ fit.axes


def _matrices(rows: DataFrame, fits: dict[int, Fit], made) -> dict[int, np.ndarray]:
    """For each length the mean of the products of any two columns of what ``made`` makes of the vectors."""
    shared = rows.sparkSession.sparkContext.broadcast(fits)

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in usable(batch.column("embedding")):
                part = made(x, shared.value[length])
                product = part.T @ part
                found[length] = found[length] + product if length in found else product
        for length, product in found.items():
            i, j = np.triu_indices(len(product))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), length, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(product[i, j])],
                names=["length", "i", "j", "product"],
            )

    parts = rows.mapInArrow(run, "length int, i int, j int, product double")
    total = parts.groupBy("length", "i", "j").agg(F.sum("product").alias("product")).toPandas()
    matrices = {}
    for length, part in total.groupby("length"):
        size = int(part["i"].max()) + 1
        matrix = np.zeros((size, size))
        matrix[part["i"], part["j"]] = matrix[part["j"], part["i"]] = part["product"] / fits[length].n
        matrices[length] = matrix
    return matrices


def _projected(rows: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(fits)
    schema = T.StructType([rows.schema["vec_id"]]).fields + T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double, identity_error double"
    ).fields
    names = [f.name for f in schema]

    def run(batches):
        for batch in batches:
            for length, at, x in usable(batch.column("embedding")):
                fit = shared.value[length]
                many, each = len(at), fit.axes.shape[1]
                value = _whitened_rows(x, fit)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(at, each))),
                        pa.array(np.tile(np.arange(1, each + 1, dtype=np.int32), many)),
                        pa.array(np.full(many * each, fit.n, np.int64)),
                        pa.array(_deviations(x, fit), pa.int64()).take(pa.array(np.repeat(np.arange(many), each))),
                        pa.array(value.ravel(), mask=np.isnan(value.ravel())),
                        pa.array(np.tile(fit.explained, many)),
                        pa.array(np.full(many * each, fit.identity_error)),
                    ],
                    names=names,
                )

    return rows.mapInArrow(run, T.StructType(schema))


def _deviations(x: np.ndarray, fit: Fit) -> list[int | None] | np.ndarray:
    apart = _centred(x, fit)
    if apart.dtype != object and apart.shape[1] * int(np.abs(apart).max()) ** 2 < 2**63:
        return (apart * apart).sum(axis=1)
    exact = (apart.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


# Eigenvectors of a symmetric matrix


def axes(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvectors of the greatest eigenvalues, over the roots of these, and the part of the trace of each."""
    size = float(np.abs(covariance).max(initial=0.0))
    most = min(most, len(covariance))
    if size == 0.0:
        return np.full((len(covariance), most), np.nan), np.zeros(most)
    scaled = covariance / size  # so that no square over- or underflows
    diagonal, beside, reflectors = tridiagonal(scaled)
    values = leading(diagonal, beside, most)
    vectors = np.stack(inverse_iteration(diagonal, beside, values), axis=1)
    for at, v in reversed(reflectors):
        vectors[at:] -= 2.0 * np.outer(v, v @ vectors[at:])
    # The quotient's error is that of the vector squared.
    values = np.einsum("ik,ij,jk->k", vectors, scaled, vectors)
    values = np.where(values > NEGLIGIBLE * values.max(), values, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        over = vectors / np.sqrt(values * size)
    return np.where(values > 0, over, np.nan), values / np.trace(scaled)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and side diagonal of an orthogonally similar tridiagonal matrix, and the reflections that lead
    there: (first coordinate, unit vector) each."""
    a, reflectors = matrix.copy(), []
    beside = np.zeros(max(0, len(a) - 1))
    for k in range(len(a) - 1):
        column = a[k + 1 :, k]
        if not column[1:].any():
            beside[k] = column[0]
            continue
        beside[k] = -math.copysign(float(np.linalg.norm(column)), column[0])
        v = column.copy()
        v[0] -= beside[k]
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append((k + 1, v))
    return np.diag(a).copy(), beside, reflectors


def below(diagonal: np.ndarray, beside: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each ``x``: negative pivots of its shifted form."""
    least = np.finfo(float).tiny * max(1.0, float((beside**2).max(initial=0.0)))
    pivot = diagonal[0] - x
    count = (pivot < 0).astype(int)
    for d, b in zip(diagonal[1:], beside, strict=True):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - x - b * b / pivot
        count += pivot < 0
    return count


def leading(diagonal: np.ndarray, beside: np.ndarray, most: int) -> np.ndarray:
    """The greatest eigenvalues, falling: all intervals are halved at once until no double lies inside."""
    radius = np.abs(np.append(beside, 0.0)) + np.abs(np.append(0.0, beside))
    low, high = np.full(most, (diagonal - radius).min()), np.full(most, (diagonal + radius).max())
    margin = 1e-12 * max(1.0, float(np.abs([low[0], high[0]]).max()))
    low, high = low - margin, high + margin
    rank = len(diagonal) - np.arange(most)  # the eigenvalue is the rank-th from below
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        enough = below(diagonal, beside, middle) >= rank
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """A unit eigenvector for each of the falling ``values``. Neighbours closer than a thousandth of the matrix form a
    cluster, whose vectors are made orthogonal in every step; equal values are moved apart by a rounding error."""
    size = float(max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0)))
    apart = 16 * np.finfo(float).eps * size
    chance = np.random.Generator(np.random.PCG64(7))
    found: list[np.ndarray] = []
    cluster, shift = 0, math.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            cluster = k
        shift = min(float(value), shift - apart) if k > cluster else float(value)
        z = chance.standard_normal(len(diagonal))
        for _ in range(6):
            z = solve(diagonal - shift, beside, z / np.linalg.norm(z), apart)
            for _ in range(2):
                for other in found[cluster:k]:
                    z = z - (other @ z) / (other @ other) * other
        found.append(z / np.linalg.norm(z))
    return found


def solve(diagonal: np.ndarray, beside: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """The solution of a symmetric tridiagonal system, by elimination with exchange of rows. A pivot of 0 is
    replaced by ``least``."""
    n = len(diagonal)
    d, u, w, z = diagonal.tolist(), [*beside.tolist(), 0.0], [0.0] * n, right.tolist()
    for i in range(n - 1):
        under = float(beside[i])
        if abs(d[i]) >= abs(under):
            factor = under / (d[i] if d[i] else least)
            d[i + 1] -= factor * u[i]
            z[i + 1] -= factor * z[i]
        else:
            factor = d[i] / under
            d[i], u[i], d[i + 1], w[i], u[i + 1] = under, d[i + 1], u[i] - factor * d[i + 1], u[i + 1], -factor * u[i + 1]
            z[i], z[i + 1] = z[i + 1], z[i] - factor * z[i + 1]
    for i in range(n - 1, -1, -1):
        rest = z[i]
        if i + 1 < n:
            rest -= u[i] * z[i + 1]
        if i + 2 < n:
            rest -= w[i] * z[i + 2]
        z[i] = rest / (d[i] if abs(d[i]) > least * 1e-16 else math.copysign(least, d[i]))
    return np.array(z)
