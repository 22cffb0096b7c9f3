"""Vector columns as arrays, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, no null or non-finite component, not zero (and not empty)."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, scale: float = 1.0) -> np.ndarray:
    """Rows of equal length as float64, divided by scale."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1) / scale
