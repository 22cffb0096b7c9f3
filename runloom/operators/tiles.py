"""Lanes and tiles: error, intensity, focus and cluster statistics; base-call controls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASES = ["a", "c", "g", "t"]


def merge_tiles(first: DataFrame, second: DataFrame, values: list[str]) -> DataFrame:
    """Statistics of two files by lane and tile, the first non-missing value wins."""
    a, b = first.select("lane", "tile", *values), second.select("lane", "tile", *[F.col(v).alias(f"__{v}") for v in values])
    return a.join(b, ["lane", "tile"], "full").select("lane", "tile", *[F.coalesce(v, f"__{v}").alias(v) for v in values])


def tile_counts(metrics: DataFrame) -> DataFrame:
    """Clusters (code 102) and those passing the filter (103) of each tile."""
    code = lambda c: F.max(F.when(F.col("code") == c, F.round("value").cast("long")))
    return metrics.where(F.col("code").isin(102, 103)).groupBy("lane", "tile").agg(code(102).alias("clusters"), code(103).alias("pf_clusters"))


def lane_stats(tiles: DataFrame) -> DataFrame:
    """Mean and population deviation over a lane's tiles of clusters, PF clusters and PF %."""
    pct = F.when(F.col("clusters") > 0, 100.0 * F.col("pf_clusters") / F.nullif(F.col("clusters"), F.lit(0)))
    rows = tiles.withColumn("pf_pct", pct)
    made = [f(c).alias(f"{p}_{c}") for c in ("clusters", "pf_clusters", "pf_pct") for f, p in ((F.avg, "mean"), (F.stddev_pop, "sd"))]
    return rows.groupBy("lane").agg(F.count("*").alias("n_tiles"), *made)


def read_ranges(lengths: DataFrame) -> DataFrame:
    """First and last cycle of each read of a run from the read lengths (columns run, read, length).

    The window runs over the few reads of one run.
    """
    total = F.sum("length").over(Window.partitionBy("run").orderBy("read").rowsBetween(Window.unboundedPreceding, 0))
    return lengths.withColumn("last_cycle", total).withColumn("first_cycle", F.col("last_cycle") - F.col("length") + 1)


def cycle_errors(errors: DataFrame) -> DataFrame:
    """Mean and deviation over tiles by lane and cycle."""
    return errors.groupBy("lane", "cycle").agg(F.avg("error_rate").alias("mean_error"), F.stddev_pop("error_rate").alias("sd_error"))


def lane_read_errors(errors: DataFrame, ranges: DataFrame, least: int = 10) -> DataFrame:
    """The cycle means and deviations averaged over each read of more than `least` cycles."""
    reads = ranges.where(F.col("last_cycle") - F.col("first_cycle") + 1 > least).select("read", "first_cycle", "last_cycle")
    # Cycles of the few ranges as an equality key.
    cycles = reads.select("read", F.explode(F.sequence(F.col("first_cycle").cast("int"), F.col("last_cycle").cast("int"))).alias("cycle"))
    return cycle_errors(errors).join(cycles, "cycle").groupBy("lane", "read").agg(F.avg("mean_error").alias("mean_error"), F.avg("sd_error").alias("mean_sd"))


def key_cycles(errors: DataFrame, first: int, last: int) -> DataFrame:
    """A lane's mean error at the first, middle and last cycle of a read."""
    at = lambda c, name: F.max(F.when(F.col("cycle") == c, F.col("mean_error"))).alias(name)
    middle = first + (last - first) // 2
    return cycle_errors(errors.where(F.col("cycle").isin(first, middle, last))).groupBy("lane").agg(at(first, "first_error"), at(middle, "middle_error"), at(last, "last_error"))


def intensity_profile(extraction: DataFrame) -> DataFrame:
    """Mean focus and intensity by lane, cycle and base; missing tiles are skipped."""
    pairs = F.array(*[F.struct(F.lit(b.upper()).alias("base"), F.col(f"int_{b}").alias("intensity"), F.col(f"fwhm_{b}").alias("focus")) for b in BASES])
    return extraction.select("lane", "cycle", F.inline(pairs)).groupBy("lane", "cycle", "base").agg(F.avg("intensity").alias("mean_intensity"), F.avg("focus").alias("mean_focus"))


def upper_median(values: Column) -> Column:
    """The element at index n / 2 of the sorted values."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def tile_table(extraction: DataFrame, tiles: DataFrame, density_ratio: float = 1.0, late_cycle: int = 21) -> DataFrame:
    """Per tile clusters, PF, PF %, mean intensity of cycle 1 and of the 20th cycle after it, % kept, focus extremes and upper median.

    The values of a tile number four per cycle, so their array is small.
    """
    total = sum((F.col(f"int_{b}") for b in BASES[1:]), F.col(f"int_{BASES[0]}")) / 4.0
    focus = F.flatten(F.collect_list(F.filter(F.array(*[F.col(f"fwhm_{b}") for b in BASES]), lambda x: x.isNotNull())))
    at = lambda c: F.avg(F.when(F.col("cycle") == c, total))
    made = extraction.groupBy("lane", "tile").agg(at(1).alias("first_intensity"), at(late_cycle).alias("late_intensity"), focus.alias("focus"))
    table = tiles.join(made, ["lane", "tile"], "left")
    return table.select(
        "lane", "tile", (F.col("clusters") / density_ratio).alias("clusters"), (F.col("pf_clusters") / density_ratio).alias("pf_clusters"),
        F.try_divide(100.0 * F.col("pf_clusters"), F.col("clusters")).alias("pf_pct"), "first_intensity", "late_intensity",
        F.try_divide(100.0 * F.col("late_intensity"), F.col("first_intensity")).alias("kept_pct"),
        F.array_min("focus").alias("min_focus"), upper_median(F.col("focus")).alias("median_focus"), F.array_max("focus").alias("max_focus"),
    )


def index_of_calls(calls: DataFrame, first: int, length: int) -> DataFrame:
    """The index sequence of every cluster from its base calls; a cluster has `length` calls here."""
    used = calls.where(F.col("cycle").between(first, first + length - 1))
    parts = F.array_sort(F.collect_list(F.struct("cycle", "base")))
    return used.groupBy("lane", "tile", "cluster").agg(F.array_join(F.transform(parts, lambda x: x["base"]), "").alias("index"))


def control_fraction(indices: DataFrame, controls: list[str]) -> DataFrame:
    """Clusters with a control index, all clusters and % by lane and tile."""
    return indices.groupBy("lane", "tile").agg(F.count_if(F.col("index").isin(controls)).alias("n_control"), F.count("*").alias("n_clusters")).withColumn("control_pct", F.try_divide(100.0 * F.col("n_control"), F.col("n_clusters")))
