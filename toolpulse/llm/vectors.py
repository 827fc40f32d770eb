"""Helpers for columns of numeric arrays."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Not null and without null or non-finite components; true for an empty array."""
    number = lambda x: x.cast("double")
    fine = lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, fine), F.lit(False))


def matrix(column, dtype) -> np.ndarray:
    """A list column as rows of a matrix; shorter rows are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out
