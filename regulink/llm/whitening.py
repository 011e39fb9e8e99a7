"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Components are the leading eigenvectors of the covariance V of the distinct quantised vectors. V is
never formed: V times a thin matrix Q is one distributed pass of (X - mean)ᵀ((X - mean) Q). A
polynomial of V, built by the Chebyshev recurrence, damps the unwanted part of the spectrum; QR and
Rayleigh-Ritz follow, until the residual of every wanted component certifies it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import table
from regulink.llm.vectors import binaries, dense, dimension, vectors
from regulink.session import freeze

SCALE, SHIFT = 64, 1_000_000  # x = floor(SCALE * c) + SHIFT
COMPONENTS = 16
BLOCK_ROWS = 2048  # vectors in a row of the fit list
DEGREE = 12  # of the filter, at most
SPREAD = 1e10  # the filter raises no component more than this above the least wanted one
EXACT = 1e-13  # residual of a certified component, as a share of the largest eigenvalue
CYCLES = 500
DIRECT_PARTS = 64  # more partial sums than this are added up in tasks before they reach the driver
ADDERS = 16
LEAST_SHARE = 1e-12  # of the trace; components below it have no spread to divide by
_BOUND = 1 << 62


@dataclass
class Whitening:
    """``sums`` are exact, of ``x - SHIFT``; column j of ``vectors`` belongs to ``values[j]``."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    identity_error: float
    passes: int

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and what is left of it."""
        return _centre(self.sums, self.n)


def _centre(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    whole = [s // n for s in sums]
    rest = [(s - w * n) / n for s, w in zip(sums, whole, strict=True)]
    return np.array(whole, np.int64), np.array(rest)


def _pack(y: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Rows of whole numbers in as few bytes as each needs; equal rows have equal bytes."""
    low, high = y.min(axis=1), y.max(axis=1)
    width = np.full(len(y), 8)
    for size in (4, 2, 1):
        top = 1 << (8 * size - 1)
        width[(low >= -top) & (high < top)] = size
    for size in (1, 2, 4, 8):
        rows = np.flatnonzero(width == size)
        if len(rows):
            yield rows, binaries(y[rows].astype(f"<i{size}").tobytes(), np.full(len(rows), size * y.shape[1]))


def _unpack(column: pa.Array, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole numbers of the packed rows, by their width."""
    width = pc.binary_length(column).to_numpy(zero_copy_only=False) // d
    for size in np.unique(width).tolist():
        rows = np.flatnonzero(width == size)
        data = b"".join(column.take(pa.array(rows)).to_pylist())
        yield rows, np.frombuffer(data, f"<i{size}").reshape(-1, d).astype(np.int64)


def quantised(df: DataFrame, d: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of each row whose vector has ``d`` finite entries; ``x`` holds
    ``floor(64 * c)`` of each entry. Entries too large for a long are cut to 2^62."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = dense(batch.column(1), d)
            if len(rows):
                y = np.clip(np.floor(matrix * SCALE), -float(_BOUND), float(_BOUND)).astype(np.int64)
                ids = batch.column(0).take(pa.array(rows))
                for some, packed in _pack(y):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(some)), packed], ["vec_id", "x"])

    return vectors(df, id_col, vec_col).mapInArrow(pack, "vec_id long, x binary")


def _fit_list(x: DataFrame, d: int) -> DataFrame:
    """Each distinct vector once, many to a row of one width."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                for _, y in _unpack(batch.column(0).slice(begin, BLOCK_ROWS), d):
                    top = int(max(-(y.min() + 1), y.max()))
                    size = next(s for s in (1, 2, 4, 8) if top < 1 << (8 * s - 1))
                    data = y.astype(f"<i{size}").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([size], pa.int32()), pa.array([data], pa.binary())], ["width", "rows"]
                    )

    return x.select("x").distinct().mapInArrow(block, "width int, rows binary")


def _blocks_of(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for width, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        yield np.frombuffer(rows.as_buffer(), f"<i{width}").reshape(-1, d).astype(np.int64)


def _counts(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            for y in _blocks_of(batch, d):
                n += len(y)
                # halves of the numbers cannot overflow in a block
                high = (y >> 32).sum(axis=0).tolist()
                low = (y & 0xFFFFFFFF).sum(axis=0).tolist()
                sums = [s + (h << 32) + v for s, h, v in zip(sums, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([n, *sums])])], ["sums"])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (d + 1)
        for batch in batches:
            for one in batch.column(0).to_pylist():
                total = [a + b for a, b in zip(total, json.loads(one), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(total)])], ["sums"])

    rows = blocks.mapInArrow(add, "sums string").repartition(ADDERS).mapInArrow(join, "sums string").collect()
    total = [sum(column) for column in zip(*[json.loads(r["sums"]) for r in rows], strict=True)]
    return total[0], total[1:]


def _summed(
    blocks: DataFrame, d: int, function: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], parts: int
) -> np.ndarray:
    """The sum of ``function`` over all blocks: one table of bounded size from each task."""

    def total(tables: Iterable[np.ndarray]) -> pa.RecordBatch:
        sums = np.zeros(shape)
        for one in tables:
            sums += one
        return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield total(function(y) for batch in batches for y in _blocks_of(batch, d))

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield total(np.frombuffer(v.as_buffer()).reshape(shape) for batch in batches for v in batch.column(0))

    rows = blocks.mapInArrow(add, "sums binary")
    if parts > DIRECT_PARTS:
        rows = rows.repartition(ADDERS).mapInArrow(join, "sums binary")
    sums = np.zeros(shape)
    for row in rows.toLocalIterator() if parts > 4 * DIRECT_PARTS else rows.collect():
        sums += np.frombuffer(row["sums"]).reshape(shape)
    return sums


class _Floor:
    """A lower bound of the spectrum from Lanczos steps that ride on the passes of the filter."""

    def __init__(self, d: int, seed: int) -> None:
        v = np.random.default_rng(seed).standard_normal(d)
        self.basis, self.diagonal, self.beside = [v / np.linalg.norm(v)], [], []
        self.done = False

    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, image: np.ndarray) -> None:
        if self.done:
            return
        self.diagonal.append(float(self.basis[-1] @ image))
        known = np.array(self.basis)
        rest = image - known.T @ (known @ image)
        rest -= known.T @ (known @ rest)
        norm = float(np.linalg.norm(rest))
        self.beside.append(norm)
        self.done = norm <= 1e-12 * max(abs(self.diagonal[0]), 1e-300) or len(self.basis) == len(image)
        if not self.done:
            self.basis.append(rest / norm)

    def bound(self) -> float:
        if len(self.diagonal) < 2:
            return 0.0
        inner = self.beside[: len(self.diagonal) - 1]
        least = np.linalg.eigvalsh(np.diag(self.diagonal) + np.diag(inner, 1) + np.diag(inner, -1))[0]
        return max(0.0, float(least) - self.beside[len(self.diagonal) - 1])


def leading_components(
    apply: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 1
) -> tuple[np.ndarray, np.ndarray, float, int]:
    """The ``k`` largest eigenvalues, their vectors, the largest residual, and the number of passes.

    ``apply`` gives V times a matrix. A block of ``3 k`` columns is filtered; components whose
    residual is small enough are locked, and the filter works on what is left beside them.
    """
    k = min(k, d)
    m = min(d, 3 * k)
    floor, passes = _Floor(d, seed + 1), 0
    q = np.eye(d) if m == d else np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))[0]
    locked = np.zeros((d, 0))

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        found = apply(np.column_stack([block, floor.vector()]))
        floor.step(found[:, -1])
        return found[:, :-1]

    before = math.inf
    for _ in range(CYCLES):
        q = np.linalg.qr(np.column_stack([locked, q]))[0]
        image = times(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residuals = np.linalg.norm(image - q * values, axis=0)
        top = max(values[0], 0.0)
        worst = float(residuals[:k].max())
        stuck = worst <= 1e-10 * top and worst > before / 2
        if m == d or worst <= EXACT * top or stuck:
            return values[:k], q[:, :k], worst, passes
        before = worst
        # the leading run of exact components is locked
        good = residuals <= EXACT * top
        number = int(np.argmin(good[:k])) if not good[:k].all() else k
        locked, q, image, values = q[:, :number], q[:, number:], image[:, number:], values[number:]

        upper = max(values[-1], 1e-300)
        lower = min(floor.bound(), upper * 0.999)
        middle, half = (upper + lower) / 2, (upper - lower) / 2
        grown = [math.acosh(max(1.0, (v - middle) / half)) for v in (values[0], values[k - number - 1])]
        degree = DEGREE if grown[0] - grown[1] <= 0 else int(math.log(SPREAD) / (grown[0] - grown[1]))
        degree = min(max(degree, 1), DEGREE)
        # scaled recurrence: the wanted end of the spectrum keeps its size
        sigma = first = half / max(values[0] - middle, half)
        last, now = q, (image - middle * q) * (sigma / half)
        for _ in range(degree - 1):
            following = 1 / (2 / first - sigma)
            now -= locked @ (locked.T @ now)
            now, last = (times(now) - middle * now) * (2 * following / half) - last * (sigma * following), now
            sigma = following
        q = now - locked @ (locked.T @ now)
        q = q / np.maximum(np.linalg.norm(q, axis=0), 1e-300)
    raise ArithmeticError(f"components not certified after {CYCLES} cycles")


def fit_whitening(
    x: DataFrame, d: int, components: int = COMPONENTS
) -> Whitening | None:
    """Whitening fitted on each distinct vector of ``x`` once; ``None`` if there is none.

    Components whose share of the variance is below ``LEAST_SHARE`` are left out: there is nothing
    to divide by. The sign of a component is such that its largest entry is positive.
    """
    blocks = freeze(_fit_list(x, d), "fit")
    n, sums = _counts(blocks, d)
    if not n:
        return None
    parts = blocks.rdd.getNumPartitions()
    whole, rest = _centre(sums, n)
    trace = float(_summed(blocks, d, lambda y: ((y - whole - rest) ** 2).sum(keepdims=True)[0], (1,), parts)[0]) / n

    def apply(block: np.ndarray) -> np.ndarray:
        def times(y: np.ndarray) -> np.ndarray:
            centred = (y - whole) - rest
            return centred.T @ (centred @ block)

        return _summed(blocks, d, times, block.shape, parts) / n

    if trace == 0:
        return Whitening(d, n, sums, np.zeros(0), np.zeros((d, 0)), trace, 0.0, 0.0, 0)
    values, found, residual, passes = leading_components(apply, d, components)
    there = values > LEAST_SHARE * trace
    values, found = values[there], found[:, there]
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    unit = found / np.sqrt(values)

    def moments(y: np.ndarray) -> np.ndarray:
        w = ((y - whole) - rest) @ unit
        return np.vstack([w.sum(axis=0), w.T @ w])

    both = _summed(blocks, d, moments, (len(values) + 1, len(values)), parts) / n
    error = np.abs(both[1:] - np.outer(both[0], both[0]) - np.eye(len(values))).max()
    return Whitening(d, n, sums, values, found, trace, residual, float(error), passes)


def whiten(x: DataFrame, fitted: Whitening) -> DataFrame:
    """One row for each row of ``x`` and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``. ``deviation`` is exact, and null beyond 38 digits."""
    d, n, sums = fitted.dim, fitted.n, fitted.sums
    whole, rest = fitted.centre
    k = len(fitted.values)
    unit = fitted.vectors / np.sqrt(fitted.values)
    explained = fitted.values / fitted.trace if k else fitted.values
    squares, top = sum(s * s for s in sums), max((abs(s) for s in sums), default=0)
    limit = Decimal(10) ** 38

    def deviations(y: np.ndarray) -> pa.Array:
        most = int(np.abs(y).max())
        if (n * most + top) ** 2 * d < _BOUND:
            apart = n * y - np.array(sums, np.int64)
            return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
        if most * most * d < _BOUND and most * top * d < _BOUND:
            own = (y * y).sum(axis=1).tolist()
            mixed = (y * np.array(sums, np.int64)).sum(axis=1).tolist()
        else:
            rows = y.tolist()
            own = [sum(v * v for v in row) for row in rows]
            mixed = [sum(v * s for v, s in zip(row, sums, strict=True)) for row in rows]
        exact = [Decimal(n * n * a - 2 * n * b + squares) for a, b in zip(own, mixed, strict=True)]
        return pa.array([v if v < limit else None for v in exact], pa.decimal128(38, 0))

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, y in _unpack(batch.column(1), d):
                at = pa.array(np.repeat(np.arange(len(rows)), k))
                number = len(rows) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)).take(at),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(number, n)),
                        deviations(y).take(at),
                        pa.array((((y - whole) - rest) @ unit).ravel()),
                        pa.array(np.tile(explained, len(rows))),
                        pa.array(np.full(number, fitted.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return x.mapInArrow(give, _RESULT)


_RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whitened_vectors(
    df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Whitened vectors of all rows, see :func:`whiten`.

    Rows whose vector is null, empty, of another length than the commonest, or holds a null or
    non-finite entry are dropped; rows that repeat an id or a vector, or have no id, all stay. An
    empty table and one without any spread have no component, so no rows.
    """
    d = dimension(vectors(df, id_col, vec_col))
    if not d:
        return df.sparkSession.createDataFrame([], _RESULT)
    x = freeze(quantised(df, d, id_col, vec_col), "quantised")
    fitted = fit_whitening(x, d, components)
    if fitted is None or not len(fitted.values):
        return df.sparkSession.createDataFrame([], _RESULT)
    return whiten(x, fitted)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """``deviation`` is null where it is beyond a long; ``deviation_exact`` has it."""
    found = whitened_vectors(table(spark, folder, "embeddings"))
    return found.withColumnRenamed("deviation", "deviation_exact").withColumn(
        "deviation", F.expr("try_cast(deviation_exact as long)")
    )
