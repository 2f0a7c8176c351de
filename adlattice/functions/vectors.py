"""Vector columns: cosine in the JVM for single pairs, Arrow batches for many."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from adlattice.functions.scalars import as_column


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity in double precision; NaN for a zero vector, 0.0 for unequal lengths."""
    a, b = as_column(a), as_column(b)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    value = F.when(norms == 0, F.lit(float("nan"))).otherwise(dot(a, b) / F.when(norms != 0, norms))
    return F.when(F.size(a) != F.size(b), F.lit(0.0)).otherwise(value)


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """An Arrow list column of equally long, non-null vectors as a float64 matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1).astype(np.float64)


def list_array(matrix: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as an Arrow list column, without a Python object per number."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(matrix).ravel()))


def packed_array(matrix: np.ndarray) -> pa.Array:
    """Rows of a float32 matrix as an Arrow binary column: a vector moves, and is stored, as one value."""
    data = np.ascontiguousarray(matrix, dtype="<f4")
    offsets = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * 4)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def matrix_of_packed(vectors: pa.Array) -> np.ndarray:
    """The inverse of :func:`packed_array`, as float64; for equally long, non-null vectors."""
    vectors = vectors.cast(pa.binary())
    offsets = np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset : vectors.offset + len(vectors) + 1]
    data = np.frombuffer(vectors.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view("<f4").reshape(len(vectors), -1).astype(np.float64)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN, as its direction is undefined."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    with np.errstate(divide="ignore", invalid="ignore"):
        return matrix / norms[:, None]


def cosine_to(vectors: np.ndarray, packed: bool = False):
    """Arrow UDF: cosine of a vector column to every row of a small matrix, as array<double>.

    The column must hold vectors of the matrix's width only (see ``with_dimension``); ``packed`` ones are binary.
    """
    read = matrix_of_packed if packed else matrix_of
    reference = unit_rows(np.asarray(vectors, dtype=np.float64))

    @F.arrow_udf("array<double>")
    def similarities(column: pa.Array) -> pa.Array:
        if len(column) == 0:
            return pa.array([], pa.list_(pa.float64()))
        values = unit_rows(read(column)) @ reference.T
        offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return similarities
