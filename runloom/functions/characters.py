"""Texts of an Arrow batch as arrays of characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, where each text begins, its length) of a column; null is empty.  Bytes as they are if all are ASCII."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    if len(data) and data.max() > 127:
        at = np.concatenate([[0], np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False))])
        return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), at[:-1], np.diff(at)
    at = at - at[0]
    return data, at[:-1], np.diff(at)
