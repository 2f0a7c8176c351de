"""Whitening of embedding vectors by spectrum slicing.

Three passes over the vectors, each one row of partial sums per task and dimension: exact sums, the covariance of the centred
vectors, and the covariance of the whitened ones. Only the finished d x d covariance comes to the driver, so what passes
there depends on the dimension and not on the number of rows.

The eigenvectors are found on the driver. The covariance is brought to tridiagonal form; the signs in the LDLT
factorisation of the shifted form count the eigenvalues above the shift. Bisection on these counts isolates each leading eigenvalue,
Rayleigh quotient iteration finds it with its vector, and counts on both sides of it certify its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 32

# Entries become integers: floor(SCALE * c) + OFFSET.
SCALE = 64
OFFSET = 1_000_000

# Entries that are turned into a matrix at once.
ENTRIES_AT_ONCE = 1 << 19

# Eigenvalues below this part of the trace are rounding, and nothing is whitened along them.
NEGLIGIBLE = 1e-12

_PARTIAL = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("dim", T.IntegerType()),
    T.StructField("exact", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType())),
])


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` vectors, exact sums by dimension, unit eigenvectors as columns and their eigenvalues, falling."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean, from exact integers."""
        return (self.n * x - self.sums) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Per row the exact sum of ``(n * x - sums) ** 2``."""
        off = self.n * x - self.sums
        if len(off) and (off.astype(np.float64) ** 2).sum(axis=1).max() > 9.2e18:
            raise OverflowError("a deviation does not fit into 64 bits")
        return (off * off).sum(axis=1)


# Fitting the model: numpy on one d x d matrix


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal ``q`` with ``a = q t q.T``, by Householder reflections."""
    a, d = a.copy(), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        a[k + 1 :, k:] -= 2.0 * np.outer(x, x @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ x, x)
        q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def count_above(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: the positive pivots of the LDLT of the shifted matrix."""
    tiny = np.finfo(np.float64).tiny ** 0.5
    squares = np.concatenate(([0.0], beside * beside))
    pivot, above = 1.0, 0
    for value, square in zip((diagonal - shift).tolist(), squares.tolist(), strict=True):
        pivot = value - square / pivot
        if abs(pivot) < tiny:
            pivot = -tiny  # an eigenvalue at the shift itself is not above it
        above += pivot > 0
    return above


def leading_pairs(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of symmetric ``a``, falling, and their unit vectors as columns.

    Eigenvalues that agree to rounding cannot be told apart; such a group gets orthogonal vectors of its space, and its
    place is certified as a whole. An eigenvalue that the counts do not certify is an ArithmeticError.
    """
    diagonal, beside, q = tridiagonal(a)
    t = np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1)
    radius = np.abs(np.concatenate((beside, [0.0]))) + np.abs(np.concatenate(([0.0], beside)))
    scale = max(float(np.max(np.abs(diagonal) + radius)), np.finfo(np.float64).tiny)
    rounding = 64 * len(a) * np.finfo(np.float64).eps * scale
    above = lambda shift: count_above(diagonal, beside, shift)
    lower, upper = float(np.min(diagonal - radius)) - rounding, float(np.max(diagonal + radius)) + rounding
    known = {lower: len(a), upper: 0}

    def counted(shift: float) -> int:
        if shift not in known:
            known[shift] = above(shift)
        return known[shift]

    values, vectors = [], np.zeros((len(a), 0))
    while len(values) < count:
        number = len(values)  # of eigenvalues that are done; all of them are greater than the next
        # The narrowest known interval that holds the next eigenvalue: more than `number` above low, at most that above high.
        low = max(s for s, c in known.items() if c > number)
        high = min(s for s, c in known.items() if c <= number)
        while counted(low) > number + 1 and high - low > rounding:
            middle = (low + high) / 2
            low, high = (middle, high) if counted(middle) > number else (low, middle)
        inside = min(counted(low) - number, count - number)
        for i in range(inside):
            value, vector = _rayleigh(t, low, high, vectors, counted, number + i, rounding, alone=inside == 1)
            values.append(value)
            vectors = np.column_stack((vectors, vector))
    order = np.argsort(-np.asarray(values), kind="stable")
    values, vectors = np.asarray(values)[order], vectors[:, order]
    for i, value in enumerate(values):
        if not above(value + 4 * rounding) <= i < above(value - 4 * rounding):
            raise ArithmeticError(f"eigenvalue {i + 1} is not certified by the counts")
    return values, q @ vectors


def _rayleigh(t: np.ndarray, low: float, high: float, found: np.ndarray, counted: Callable[[float], int], number: int,
              rounding: float, alone: bool) -> tuple[float, np.ndarray]:
    """The eigenvalue between ``low`` and ``high`` with its vector, orthogonal to those ``found``.

    Rayleigh quotient iteration from the middle of the interval; if it leaves the interval, the interval is halved by a
    count and it starts again.
    """
    identity = np.eye(len(t))

    def orthogonal(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(t - shift * identity, x)
        except np.linalg.LinAlgError:  # the shift is the eigenvalue to the last bit
            y = np.linalg.solve(t - (shift + rounding / 64) * identity, x)
        return orthogonal(y / np.linalg.norm(y))

    while True:
        middle = (low + high) / 2
        # A fixed start that no eigenvector is likely to be orthogonal to; two steps of inverse iteration aim it.
        x = orthogonal(np.cos(np.arange(1, len(t) + 1) * (number + 1.0)))
        x = solved(middle, solved(middle, x))
        value = float(x @ t @ x)
        near = False
        for _ in range(12):
            x = solved(value, x)
            value = float(x @ t @ x)
            if near:  # one step beyond, which takes the vector to its last bits
                break
            near = np.linalg.norm(t @ x - value * x) <= rounding / 8
        right = np.linalg.norm(t @ x - value * x) <= rounding and low - rounding <= value <= high + rounding
        if right or high - low <= rounding:
            return value, x
        if alone:
            low, high = (middle, high) if counted(middle) > number else (low, middle)
        else:
            return value, x


# Passes over the vectors


def usable_vectors(rows: DataFrame, width: int) -> Callable[[pa.RecordBatch], Iterator[tuple[pa.Array, np.ndarray]]]:
    """Function from a batch (vec_id, embedding) to ids and integer vectors of the rows that remain, some rows at a time."""

    def run(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
        at_once = max(1, ENTRIES_AT_ONCE // width)
        for start in range(0, batch.num_rows, at_once):
            part = batch.slice(start, at_once)
            column = part.column("embedding")
            right = pc.fill_null(pc.equal(pc.list_value_length(column), width), False)
            ids, column = part.column("vec_id").filter(right), column.filter(right)
            entries = column.flatten().cast(pa.float64()).fill_null(np.nan)
            c = entries.to_numpy(zero_copy_only=False).reshape(len(column), width)
            finite = np.isfinite(c).all(axis=1)
            scaled = np.floor(SCALE * c[finite])
            if len(scaled) and np.abs(scaled).max() >= 2.0**62:
                raise OverflowError("an entry does not fit into 64 bits")
            yield ids.filter(pa.array(finite)), scaled.astype(np.int64) + OFFSET

    return run


def _partial_sums(rows: DataFrame, width: int, exact: bool, terms: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """One row per task and dimension of what ``terms`` makes of the task's vectors: a vector of longs, or a matrix of doubles."""
    usable = usable_vectors(rows, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for _, x in usable(batch):
                if len(x):
                    made = terms(x)
                    total, n = made if total is None else total + made, n + len(x)
        if total is not None:
            dims = np.arange(-1 if exact else 0, len(total), dtype=np.int32)  # dimension -1 is the number of rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(dims), TaskContext.get().partitionId(), np.int64)), pa.array(dims),
                pa.array(np.concatenate(([n], total)) if exact else np.zeros(len(dims), np.int64)),
                pa.array([None] * len(dims) if exact else list(total), pa.list_(pa.float64())),
            ], names=_PARTIAL.names)

    return rows.select("vec_id", "embedding").mapInArrow(run, _PARTIAL)


def _summed(partial: DataFrame, width: int) -> np.ndarray:
    """The matrix of all tasks together. Dimensions are dealt to tasks, each adds its rows in task order, so sums repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for dim, row in zip(batch.column("dim").to_pylist(), rows, strict=True):
                held[dim] = held[dim] + row if dim in held else row.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["dim", "sums"])

    dealt = partial.repartition("dim").sortWithinPartitions("part").select("dim", "sums")
    found = dealt.mapInArrow(run, "dim int, sums array<double>").collect()  # one row per dimension
    out = np.zeros((len(found), width))
    for row in found:
        out[row["dim"]] = row["sums"]
    return out


def vector_width(rows: DataFrame) -> int:
    """The width that most vectors have, of equal counts the greater one; 0 without vectors."""
    width = F.size("embedding")
    most = rows.where("embedding IS NOT NULL").groupBy(width.alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return most["width"] if most else 0


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted to all usable vectors of ``rows`` (vec_id, embedding); None if there are none or all are the same."""
    width = vector_width(rows)
    if width == 0:
        return None
    exact = _partial_sums(rows, width, True, lambda x: x.sum(axis=0)).groupBy("dim").agg(F.sum("exact").alias("s")).collect()
    by_dim = {r["dim"]: r["s"] for r in exact}  # one row per dimension
    if not by_dim:
        return None
    n, sums = by_dim[-1], np.array([by_dim[i] for i in range(width)], np.int64)
    plain = Whitening(n, sums, np.eye(width), np.ones(width), 0.0, 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = plain.centred(x)
        return y.T @ y

    covariance = _summed(_partial_sums(rows, width, False, products), width) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    if not trace > 0:
        return None
    values, vectors = leading_pairs(covariance, min(components, width))
    kept = int((values > NEGLIGIBLE * trace).sum())
    model = Whitening(n, sums, vectors[:, :kept], values[:kept], trace, 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        return np.vstack((w.T @ w, w.sum(axis=0)))

    total = _summed(_partial_sums(rows, width, False, moments), kept) / n
    mean = total[kept]  # zero but for rounding, as the vectors are centred before they are projected
    error = float(np.abs(total[:kept] - np.outer(mean, mean) - np.eye(kept)).max())
    return Whitening(n, sums, vectors[:, :kept], values[:kept], trace, error)


WHITENED = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
])


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of all usable vectors of ``rows`` (vec_id, embedding): one row per vector and component.

    A vector is dropped if it is null, holds null or non-finite entries, or has not the width that most vectors have. Other
    columns are not looked at, whatever their names. Every remaining row is fitted and returned, also repeated rows and null ids.
    Components are numbered from 1 by falling eigenvalue; there are at most ``components``, at most as many as dimensions,
    and none along which the vectors do not vary (an eigenvalue up to ``NEGLIGIBLE`` of the trace). So the result is empty for an
    empty table, for one vector and for vectors that are all the same. An entry or a deviation beyond 64 bits is an OverflowError.
    """
    model = fit_whitening(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], WHITENED)
    usable = usable_vectors(rows, len(model.sums))
    kept = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in usable(batch):
                count = len(x)
                yield pa.RecordBatch.from_arrays([
                    ids.cast(pa.int64()).take(pa.array(np.repeat(np.arange(count), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * kept, model.n, np.int64)), pa.array(np.repeat(model.deviations(x), kept)),
                    pa.array(model.whiten(x).reshape(-1)), pa.array(np.tile(model.values / model.trace, count)),
                    pa.array(np.full(count * kept, model.identity_error)),
                ], names=WHITENED.names)

    return rows.select("vec_id", "embedding").mapInArrow(run, WHITENED)
