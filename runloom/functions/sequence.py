"""Bases of a read: composition, complement, index and control sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .characters import codes

BASES = ["A", "C", "G", "T"]


def count_of(seq: str, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(F.col(seq), F.lit(base), F.lit("")))


def resolved(seq: str = "seq") -> Column:
    """Characters that are not N: the denominator of entropy and frequency."""
    return F.length(seq) - count_of(seq, "N")


def _entropy(seq: pa.Array) -> pa.Array:
    data, _, n = codes(seq)
    of = np.repeat(np.arange(len(n)), n)
    count = lambda b: np.bincount(of[data == ord(b)], minlength=len(n))
    total = n - count("N")
    out = np.zeros(len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        for b in BASES:
            p = count(b) / total
            out += np.where(p > 0, -p * np.log2(p), 0.0)
    return pa.array(out, mask=(total == 0) | seq.is_null().to_numpy(zero_copy_only=False))


_entropy_of = F.arrow_udf(_entropy, T.DoubleType())


def entropy(seq: str = "seq") -> Column:
    """P5: base entropy in bits; null if nothing is resolved."""
    return _entropy_of(F.col(seq))


def max_frequency(seq: str = "seq") -> Column:
    """Share of the most frequent base; null if nothing is resolved."""
    return F.try_divide(F.greatest(*[count_of(seq, b) for b in BASES]), resolved(seq))


def complement(base: Column) -> Column:
    """P17."""
    return F.translate(base, "ACGT", "TGCA")


def ratio_percent(part: Column, rest: Column) -> Column:
    """100 a / (a + b), null where the denominator is 0."""
    return F.try_divide(100.0 * part, part + rest)


def clip(x: Column, most: float) -> Column:
    """The clipping of densities (0.01 errors, 20 ratios, 80 assignment qualities)."""
    return F.least(x, F.lit(float(most)))


def control_name(name: Column, unknown: bool = False) -> Column:
    """Names of controls (and of unassigned reads)."""
    found = F.lower(name).startswith("control")
    return found | F.lower(name).startswith("unknown") if unknown else found
