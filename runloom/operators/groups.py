"""Read groups: splitting, tallies, retention and subsampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence


def with_group(reads: DataFrame) -> DataFrame:
    """K2: a missing read group becomes `unknown`."""
    return reads.withColumn("rg", F.coalesce("rg", F.lit("unknown")))


def group_counts(reads: DataFrame, header: DataFrame | None = None) -> DataFrame:
    """K2: reads per output group, those of the header without reads included."""
    counted = with_group(reads).groupBy("rg").agg(F.count("*").alias("n_reads"))
    if header is None:
        return counted
    return header.select("rg").distinct().join(counted, "rg", "full").select("rg", F.coalesce("n_reads", F.lit(0)).alias("n_reads"))


def split_by_group(reads: DataFrame, path: str, header: DataFrame | None = None) -> None:
    """K2: one folder per read group; groups of the header without reads get an empty one.

    The header is as long as a file's list of groups; those without reads are written one by one.
    """
    grouped = with_group(reads)
    grouped.write.partitionBy("rg").parquet(path)
    if header is not None:
        made = reads.sparkSession.read.schema(grouped.schema).parquet(path).select("rg").distinct()
        for row in header.select("rg").distinct().join(made, "rg", "left_anti").collect():
            grouped.drop("rg").limit(0).write.parquet(f"{path}/rg={row['rg']}")


def flag_tally(reads: DataFrame) -> DataFrame:
    """C-5: reads and mapped reads by group and pass/fail, subtotals and TOTAL by rollup."""
    status = F.when(F.coalesce(F.col("failed_qc"), F.lit(False)), "fail").otherwise("pass")
    made = with_group(reads).withColumn("status", status).rollup("rg", "status").agg(F.count("*").alias("n"), F.count_if("mapped").alias("n_mapped"), F.grouping_id().alias("g"))
    return made.select(F.when(F.col("g") == 3, "TOTAL").otherwise(F.col("rg")).alias("rg"), F.when(F.col("g") > 0, "all").otherwise(F.col("status")).alias("status"), "n", "n_mapped")


def retained_groups(tally: DataFrame, least: int = 200_000, target: int = 1_000_000) -> DataFrame:
    """Passing groups, not controls nor totals, with more than `least` mapped reads; fraction target / count, 1 at most."""
    named = F.col("rg").isNotNull() & (F.col("rg") != "") & (F.col("rg") != "TOTAL") & ~sequence.control_name(F.col("rg"))
    kept = tally.where((F.col("status") == "pass") & named & (F.col("n_mapped") > least))
    return kept.select("rg", "n_mapped", F.least(F.lit(1.0), target / F.col("n_mapped")).alias("fraction"))


def subsample(reads: DataFrame, retained: DataFrame) -> DataFrame:
    """Mapped reads of the retained groups, each kept with its group's probability.

    The draw is a digest of the name, so mates stay together and a rerun draws the same.
    """
    joined = reads.where("mapped AND rg IS NOT NULL").join(retained.select("rg", "fraction"), "rg")
    limit = F.lower(F.lpad(F.hex(F.floor(F.col("fraction") * 16777216)), 6, "0"))
    return joined.where((F.col("fraction") >= 1) | (F.substring(F.md5("name"), 1, 6) < limit))
