"""Whitening of integer vectors on their leading principal components.

The components are found by Chebyshev-filtered subspace iteration: a block of vectors is run
through a polynomial of the covariance that damps the unwanted end of its spectrum, made
orthonormal, and rotated to its Ritz vectors, until the residuals of the wanted ones certify
them. The covariance is never formed: each degree of the polynomial is one distributed pass over
the centred rows that gives X'(XQ), a matrix of dimensions by block width.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from xmlindex.session import Staging

# Integers up to here are exact as doubles and leave room for sums over a batch.
LARGEST = 1 << 52


@dataclass(frozen=True)
class Fitting:
    """How components are sought.

    `guard` vectors beyond the wanted ones keep the block away from the spectrum that is damped;
    `degree` bounds the polynomial of one cycle; a component is certified when the norm of its
    residual Vq - eq is at most `tolerance` times the largest eigenvalue; more than `passes`
    passes raise ArithmeticError.
    """

    components: int = 8
    guard: int = 24
    degree: int = 12
    tolerance: float = 2e-14
    passes: int = 600
    seed: int = 11


@dataclass(frozen=True)
class Whitening:
    """What was fitted: counts and exact sums, components as rows, their eigenvalues, falling."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int
    identity_error: float


def quantise_shifted(vector: Column, scale: int = 1024, shift: int = 100_000) -> Column:
    """floor(scale * c) + shift of each component as a double.

    Null where the vector is null or empty, a component is null or not finite, or a scaled
    component lies beyond 2^52, where doubles no longer tell integers apart.
    """
    values = vector.cast("array<double>")
    usable = F.forall(values, lambda c: F.coalesce(F.abs(c * scale) < float(LARGEST), F.lit(False)) & ~F.isnan(c))
    return F.when(usable & (F.size(values) > 0), F.transform(values, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(rows: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """x - S/n with the integers subtracted as integers, so nothing of a large mean is lost."""
    return (rows - whole) - part


def _summed(vectors: DataFrame, width: int, function: Callable[[np.ndarray], np.ndarray], columns: int,
            kind: str = "double") -> list[list]:
    """The sum over all batches of `function(rows)`, a matrix of `columns` columns, row by row."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = function(_matrix(batch.column(0), width))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.from_numpy_dtype(total.dtype)))],
                names=["line", "entries"],
            )

    parts = vectors.mapInArrow(partial, f"line int, entries array<{kind}>")
    add = "decimal(38,0)" if kind == "bigint" else "double"
    sums = [F.sum(F.element_at("entries", n + 1).cast(add)) for n in range(columns)]
    rows = parts.groupBy("line").agg(F.array(*sums).alias("entries")).collect()
    return [row["entries"] for row in sorted(rows, key=lambda row: row["line"])]


def _chebyshev(apply: Callable[[np.ndarray], np.ndarray], block: np.ndarray, first: np.ndarray, values: np.ndarray,
               degree: int) -> np.ndarray:
    """The block through a polynomial that stays within 1 on [0, least Ritz value] and grows above.

    `first` is the covariance times the block, known from the Ritz step, so a polynomial of degree
    d costs d - 1 passes. The recurrence is scaled by its value at the largest Ritz value.
    """
    half = values[-1] / 2
    scale = half / (values[0] - half)
    factor = scale
    before, now = block, (first - half * block) * (factor / half)
    for _ in range(degree - 1):
        following = 1 / (2 / scale - factor)
        before, now = now, (apply(now) - half * now) * (2 * following / half) - factor * following * before
        factor = following
    return now


def leading_eigenpairs(apply: Callable[[np.ndarray], np.ndarray], width: int, how: Fitting) -> tuple:
    """(eigenvalues falling, vectors as columns, residual norms, passes) of a positive semidefinite map.

    `apply` multiplies a block of columns. Directions without variance (an eigenvalue of at most
    1e-13 of the largest) are no components.
    """
    size = min(width, how.components + how.guard)
    block = np.linalg.qr(np.random.default_rng(how.seed).standard_normal((width, size)))[0]
    passes = 0
    while True:
        image = apply(block)
        passes += 1
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residuals = np.linalg.norm(image - block * values, axis=0)
        top = values[0]
        wanted = min(how.components, int((values > 1e-13 * top).sum())) if top > 0 else 0
        if (residuals[:wanted] <= how.tolerance * max(top, 0)).all():
            return values[:wanted], block[:, :wanted], residuals[:wanted], passes
        if passes >= how.passes:
            raise ArithmeticError(f"not certified after {passes} passes: residuals {residuals[:wanted] / top}")
        if values[-1] <= 1e-13 * top:
            filtered = image  # the block holds all variance there is: one more multiplication does
        else:
            # The largest direction may outgrow the others only so far that they keep their digits.
            growth = math.acosh(max(2 * top / values[-1] - 1, 1 + 1e-12))
            degree = max(2, min(how.degree, int(18 / growth)))
            before = passes

            def counted(columns: np.ndarray) -> np.ndarray:
                nonlocal passes
                passes += 1
                return apply(columns)

            filtered = _chebyshev(counted, block, image, values, degree)
            assert passes == before + degree - 1
        lengths = np.linalg.norm(filtered, axis=0)
        block = np.linalg.qr(filtered / np.where(lengths > 0, lengths, 1))[0]


def fit_whitening(vectors: DataFrame, column: str = "vector", how: Fitting = Fitting()) -> Whitening:
    """Components of the covariance (divisor n) of all integer vectors in `column`.

    Null vectors take no part. If lengths differ, those of the most frequent length are the fit
    list (of two equally frequent ones the longer). Repeated rows count each time. Without rows,
    or if all are equal, there are no components. Every pass reads the staged vectors alone and
    sends one small matrix a partition to the shuffle; the driver holds matrices of dimensions by
    block width.
    """
    rows = vectors.select(F.col(f"`{column}`").cast("array<bigint>").alias("x")).where("x is not null and size(x) > 0")
    with Staging() as staging:
        rows = staging.write(rows, "whitening")
        lengths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
        if lengths is None:
            return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0), 0, 0.0)
        width, n = lengths["width"], lengths["count"]
        rows = rows.where(F.size("x") == width)

        # High and low halves are summed apart: neither overflows, whatever the row count.
        halves = _summed(rows, width, lambda x: np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)], axis=1), 2, "bigint")
        sums = tuple((int(high) << 32) + int(low) for high, low in halves)
        whole = np.array([s // n for s in sums], np.int64)
        part = np.array([s % n / n for s in sums])

        def spread(x: np.ndarray) -> np.ndarray:
            return (_centred(x, whole, part) ** 2).sum(axis=0)[:, None]

        trace = float(np.sum(_summed(rows, width, spread, 1))) / n

        def apply(block: np.ndarray) -> np.ndarray:
            def product(x: np.ndarray) -> np.ndarray:
                centred = _centred(x, whole, part)
                return centred.T @ (centred @ block)

            return np.array(_summed(rows, width, product, block.shape[1])) / n

        if trace == 0:
            return Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0, np.zeros(0), 0, 0.0)
        values, found, residuals, passes = leading_eigenpairs(apply, width, how)
        weights = found / np.sqrt(values)

        def moments(x: np.ndarray) -> np.ndarray:
            z = _centred(x, whole, part) @ weights
            return np.concatenate([z.T @ z, z.sum(axis=0)[:, None]], axis=1)

        sums_of_z = np.array(_summed(rows, width, moments, len(values) + 1)) / n
        mean = sums_of_z[:, -1]
        error = float(np.abs(sums_of_z[:, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    return Whitening(n, sums, found.T.copy(), values, trace, residuals, passes, error)


def _deviations(rows: np.ndarray, model: Whitening, whole: np.ndarray) -> pa.Array:
    """Sums over dimensions of (n x - S)^2, exact; null beyond 38 digits."""
    n, rest = model.n, np.array([s % model.n for s in model.sums], np.int64)
    shifted = rows - whole
    reach = (int(np.abs(shifted).max(initial=0)) + 1) * n
    if reach * reach * rows.shape[1] < 1 << 63:
        values = ((shifted * n - rest) ** 2).sum(axis=1)
        return pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))
    exact = [sum((int(x) * n - int(r)) ** 2 for x, r in zip(row, rest)) for row in shifted]
    return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, model: Whitening, column: str = "vector", output: str = "whitening") -> DataFrame:
    """The rows with a usable vector and a struct `output`: `deviation` and the array `whitened`.

    `whitened` has x - S/n projected on each component, over the root of its eigenvalue;
    `deviation` is the exact sum of (n x - S)^2 as decimal(38,0). Rows whose vector is null or of
    another length than the fitted ones are left out. Without components the array is empty. All
    other columns stay; one named like `output` is replaced. Nothing is shuffled.
    """
    width = len(model.sums)
    n = max(model.n, 1)
    whole = np.array([s // n for s in model.sums], np.int64)
    part = np.array([s % n / n for s in model.sums])
    weights = model.components.T / np.sqrt(model.eigenvalues)

    @F.arrow_udf("struct<deviation: decimal(38,0), whitened: array<double>>")
    def project(x: pa.Array) -> pa.Array:
        if not len(x):
            kinds = [pa.field("deviation", pa.decimal128(38, 0)), pa.field("whitened", pa.list_(pa.float64()))]
            return pa.array([], pa.struct(kinds))
        rows = _matrix(x, width)
        found = _centred(rows, whole, part) @ weights
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1)))
        return pa.StructArray.from_arrays([_deviations(rows, model, whole), lists], names=["deviation", "whitened"])

    usable = vectors.where(F.size(F.col(f"`{column}`")) == width) if width else vectors.where(F.lit(False))
    return usable.withColumn(output, project(F.col(f"`{column}`").cast("array<bigint>")))
