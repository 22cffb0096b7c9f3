"""Flagging reads and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from ..operators import flags
from ..sources import sam


def filter_reads(reads: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(flagged reads, filter report): one pass each, nothing is shuffled but a row of counters per task."""
    flagged = flags.flag_reads(reads, **options)
    return flagged, flags.filter_report(flagged)


def write_flagged(reads: DataFrame, path: str, **options) -> DataFrame:
    """K1 with A1 in one pass: flagged reads are written, and the filter report is counted by the writing job itself (one row)."""
    seen = Observation("filter_report")
    sam.write_reads(flags.flag_reads(reads, **options).observe(seen, *flags.report_counters()), path)
    found = seen.get
    return reads.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"{n} long" for n in found))
