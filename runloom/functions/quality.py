"""Base qualities: Phred+33 strings as columns."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .characters import codes

#: Characters whose values a task holds at once, unless a single read has more.
_HELD = 1_000_000


def phred(qual: str, floor: int | None = 2) -> Column:
    """The qualities of a string, floored for error sums and not for histograms (floor=None)."""

    def decode(i: Column) -> Column:
        q = F.ascii(F.substring(F.col(qual), i, F.lit(1))) - 33
        return q if floor is None else F.greatest(q, F.lit(floor))

    return F.when(F.length(qual) > 0, F.transform(F.sequence(F.lit(1), F.length(qual)), decode)).when(F.col(qual).isNotNull(), F.array().cast("array<int>"))


def error_of(q: Column) -> Column:
    return F.pow(F.lit(10.0), -q / 10.0)


def _in_order(values: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of n values from each place on, added one after the other: a row's sum does not depend on the rows beside it."""
    order = np.argsort(-n, kind="stable")
    total, at, n = np.zeros(len(n)), at[order], n[order]
    for i in range(int(n.max(initial=0))):
        active = int(np.searchsorted(-n, -i, "left"))
        if active < 16:
            for r in range(active):
                total[r] = np.cumsum(np.concatenate([total[r : r + 1], values[at[r] + i : at[r] + n[r]]]))[-1]
            break
        total[:active] += values[at[:active] + i]
    out = np.empty_like(total)
    out[order] = total
    return out


def _summed(qual: pa.Array, value: Callable[[int], float], table: np.ndarray) -> pa.Array:
    data, at, n = codes(qual)
    out, first = np.zeros(len(n)), 0
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(at + n, at[first] + _HELD, "right")))
        part = data[at[first] : at[last - 1] + n[last - 1]]
        if part.dtype == np.uint8:
            values = table[part]
        else:
            distinct, number = np.unique(part, return_inverse=True)
            values = np.array([value(int(c) - 33) for c in distinct])[number]
        out[first:last] = _in_order(values, at[first:last] - at[first], n[first:last])
        first = last
    return pa.array(out, mask=qual.is_null().to_numpy(zero_copy_only=False))


def _error(q: int) -> float:
    return math.pow(10.0, -max(q, 2) / 10.0)


def _log10_right(q: int) -> float:
    return math.log10(1 - _error(q))


_ERRORS = np.array([_error(c - 33) for c in range(256)])
_LOG10_RIGHT = np.array([_log10_right(c - 33) for c in range(256)])


def _error_sum(qual: pa.Array) -> pa.Array:
    return _summed(qual, _error, _ERRORS)


def _log10_sum(qual: pa.Array) -> pa.Array:
    return _summed(qual, _log10_right, _LOG10_RIGHT)


def _phred_sum(qual: pa.Array) -> pa.Array:
    data, at, n = codes(qual)
    upto = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
    return pa.array(upto[at + n] - upto[at] - 33 * n, pa.int32(), mask=qual.is_null().to_numpy(zero_copy_only=False))


# Sums over a read are made by arrays for whole batches.
_error_total = F.arrow_udf(_error_sum, T.DoubleType())
_log10_total = F.arrow_udf(_log10_sum, T.DoubleType())
_phred_total = F.arrow_udf(_phred_sum, T.IntegerType())


def total(qual: str = "qual") -> Column:
    """The sum of the qualities, not floored; null for a missing string, 0 for an empty one."""
    return _phred_total(F.col(qual))


def expected_error(seq: str = "seq", qual: str = "qual") -> Column:
    """Mean expected error; null for an empty read."""
    return F.try_divide(_error_total(F.col(qual)), F.length(seq))


def log10_likelihood(qual: str = "qual") -> Column:
    """log10 of the product of 1 - error over the read."""
    return _log10_total(F.col(qual))


def likelihood(qual: str = "qual") -> Column:
    return F.pow(F.lit(10.0), log10_likelihood(qual))
