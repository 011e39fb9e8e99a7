"""Vector columns as matrices: which rows take part, and arrays packed into binary columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Only the id and the vector, under fixed names; vectors of anything but floats are doubles."""
    kind = df.schema[vec_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    vector = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))


def dimension(given: DataFrame) -> int:
    """The commonest length of the vectors, the smaller one of two; 0 if there is none."""
    sizes = given.where("size(vector) > 0").groupBy(F.size("vector").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else 0


def dense(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``d`` finite numbers, and these as a matrix of doubles."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    there = np.flatnonzero(sizes == d)
    begins = np.cumsum(sizes) - sizes
    matrix = flat[begins[there][:, None] + np.arange(d)]
    finite = np.isfinite(matrix).all(axis=1)
    return there[finite], matrix[finite]


def binaries(data: bytes, sizes: np.ndarray) -> pa.Array:
    """A binary column of the given sizes over ``data``."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
