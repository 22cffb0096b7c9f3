"""Error profile of control reads: extraction, alignment walk, and all counters in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import alignment, indices


def _chosen(reads: DataFrame, controls: list[str] | DataFrame | None) -> DataFrame:
    return reads if controls is None else indices.control_reads(reads, controls)


def control_bases(reads: DataFrame, controls: list[str] | DataFrame | None = None, mask: DataFrame | None = None) -> DataFrame:
    """The bases of (control) reads, without masked positions."""
    bases = alignment.explode_alignment(_chosen(reads, controls))
    return bases if mask is None else alignment.masked(bases, mask)


def control_counters(reads: DataFrame, controls: list[str] | DataFrame | None = None, mask: DataFrame | None = None, **options) -> DataFrame:
    """alignment.base_counters of (control) reads; what the tables A2-A7, A21, A22 and C-7 are made from."""
    return alignment.base_counters(_chosen(reads, controls), mask, **options)


def control_tables(reads: DataFrame, controls: list[str] | DataFrame | None = None, mask: DataFrame | None = None, **options) -> DataFrame:
    """A2-A6, both classes of NM, in one scan of the reads and one exchange; see alignment.profiles."""
    return alignment.profiles(control_counters(reads, controls, mask, **options))
