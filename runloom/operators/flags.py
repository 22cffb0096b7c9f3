"""Flagging reads: expected error, complexity, length, likelihood; the filter report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quality, sequence


def check_cutoffs(entropy: float | None = None, frequency: float | None = None, percent: float | None = None) -> None:
    """At most one complexity filter, cutoffs in their ranges."""
    if entropy is not None and frequency is not None:
        raise ValueError("choose the entropy or the frequency filter, not both")
    for name, value, most in (("entropy", entropy, 2), ("frequency", frequency, 1), ("percent", percent, 1)):
        if value is not None and not 0 <= value <= most:
            raise ValueError(f"the {name} cutoff lies outside 0 to {most}")


def flag_reads(reads: DataFrame, max_error: float | None = 0.01, entropy: float | None = None, frequency: float | None = None, min_length: int = -1, max_length: int = -1, reset: bool = False) -> DataFrame:
    """Reads with their metrics, one column per reason, and failed_qc.

    Reasons are not exclusive; a read is marked, never dropped.  A comparison with a missing value
    (an empty read has no mean error) does not fail a read, but a read of only N fails the complexity filters.
    """
    check_cutoffs(entropy, frequency)
    never = F.lit(False)
    out = reads.withColumns({
        "avg_expected_error": quality.expected_error(),
        "base_entropy": sequence.entropy(),
        "max_base_frequency": sequence.max_frequency(),
        "failed_before": never if reset else F.coalesce(F.col("failed_qc"), never),
    })
    fails = lambda c: F.coalesce(c, never)
    short = fails(F.length("seq") < min_length) if min_length >= 0 else never
    long = fails(F.length("seq") > max_length) if max_length >= 0 else never
    reasons: dict[str, Column] = {
        "fails_length": short | long,
        "fails_entropy": never if entropy is None else F.coalesce(F.col("base_entropy") < entropy, F.lit(True)),
        "fails_frequency": never if frequency is None else F.coalesce(F.col("max_base_frequency") > frequency, F.lit(True)),
        "fails_error": never if max_error is None else fails(F.col("avg_expected_error") > max_error),
    }
    out = out.withColumns(reasons)
    return out.withColumn("failed_qc", F.col("failed_before") | F.col("fails_length") | F.col("fails_entropy") | F.col("fails_frequency") | F.col("fails_error"))


def report_counters() -> list[Column]:
    """A1: totals per reason, as aggregates over flagged reads."""
    n = lambda c: F.count_if(F.col(c)).alias(c.replace("fails_", "n_").replace("failed_", "n_failed_"))
    return [F.count(F.lit(1)).alias("n_total"), *[n(c) for c in ("failed_before", "fails_length", "fails_entropy", "fails_frequency", "fails_error", "failed_qc")]]


def filter_report(flagged: DataFrame) -> DataFrame:
    """A1: totals per reason, one aggregate over the flagged reads."""
    return flagged.agg(*report_counters())


#: Values that are sorted on the driver at most.
MOST_SORTED = 50_000


def kth_smallest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th smallest value (from 0), exactly and without a global sort.

    Approximate quantiles bracket it, and again inside the bracket, until a single value or at
    most MOST_SORTED rows are left; each round is an aggregate and narrows some hundredfold.
    """
    x = F.col(column)
    inside, below, slack = values.where(x.isNotNull()), 0, 1e-3
    k = max(k, 0)
    while True:
        n, least, most = inside.agg(F.count("*"), F.min(x), F.max(x)).first()
        if not n:
            return None
        at = min(k - below, n - 1)
        if least == most:
            return least
        if n <= MOST_SORTED:
            return inside.orderBy(x).select(column).collect()[at][0]
        low, high = inside.agg(F.percentile_approx(x, [max(0.0, at / n - slack), min(1.0, (at + 1) / n + slack)], 10_000)).first()[0]
        under, upto = inside.agg(F.count_if(x < low), F.count_if(x <= high)).first()
        if under <= at < upto and upto - under < n:
            inside, below = inside.where((x >= low) & (x <= high)), below + under
        else:
            slack *= 10  # the bracket missed, or narrowed nothing
            if slack > 1:
                return inside.orderBy(x).select(column).limit(at + 1).agg(F.max(x)).first()[0]


def bottom_percent(reads: DataFrame, percent: float, metric: Column | None = None) -> DataFrame:
    """Fail reads whose likelihood lies below the element int(percent * n) of the sorted ones (log10, 9 digits)."""
    check_cutoffs(percent=percent)
    scored = reads.withColumn("log10_likelihood", F.round(quality.log10_likelihood() if metric is None else metric, 9))
    # The selection reads one column several times; kept meanwhile, and made anew should an executor be lost.
    values = scored.select("log10_likelihood").persist()
    n = values.agg(F.count("log10_likelihood")).first()[0]
    cutoff = kth_smallest(values, "log10_likelihood", int(percent * n))
    values.unpersist()
    return scored.withColumn("cutoff", F.lit(cutoff).cast("double")).withColumn("fails_likelihood", F.coalesce(F.col("log10_likelihood") < F.col("cutoff"), F.lit(False)))
