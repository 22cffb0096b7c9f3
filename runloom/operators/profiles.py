"""Profiles of reads: qualities, insert sizes, counts, composition, duplicates."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import quality, sequence


def quality_histogram(reads: DataFrame, read1: int, index1: int = 0, read2: int = 0) -> DataFrame:
    """Counts by cycle, base and quality; cycles run over read 1, index 1, read 2, index 2; N is left out.

    The cells of a batch of reads are counted by arrays, so that no row of a base is made and a task sends
    about one row per cycle, base and quality.
    """
    second = F.coalesce(F.col("second_mate"), F.lit(False))
    own = F.when(second, F.lit(read1 + index1)).otherwise(F.lit(0))
    cells = reads.select("seq", "qual", "xi", "yi", "xj", "yj", second.alias("second"), own.alias("own")).mapInArrow(functools.partial(_quality_cells, first_index=read1, second_index=read1 + index1 + read2), "cycle int, base string, q int, n long")
    return cells.groupBy("cycle", "base", "q").agg(F.sum("n").alias("n"))


#: Cycles up to which a task of quality_histogram holds its counts as an array; those of longer reads it sends batch by batch.
HELD_CYCLES = 4096


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text column's bytes, one a character (others than ASCII as 0x7f), the places of its values, and their lengths (0 for null)."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    if (data > 127).any():
        return _bytes(pc.replace_substring_regex(column, "[^\\x00-\\x7f]", "\x7f"))
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return data, at[:-1], np.diff(at)


def _quality_cells(batches: Iterator[pa.RecordBatch], first_index: int, second_index: int) -> Iterator[pa.RecordBatch]:
    letter = np.full(256, -1, np.int64)
    letter[np.frombuffer("".join(sequence.BASES).encode(), np.uint8)] = np.arange(4)
    held = np.zeros(0, np.int64)

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        base = pa.array(sequence.BASES).take(pa.array(keys // 51 % 4))
        return pa.RecordBatch.from_arrays([pa.array(keys // 204, pa.int32()), base, pa.array(keys % 51, pa.int32()), pa.array(n, pa.int64())], names=["cycle", "base", "q", "n"])

    for batch in batches:
        first = ~batch.column("second").to_numpy(zero_copy_only=False)
        own = batch.column("own").to_numpy().astype(np.int64)
        for seq, qual, offset, used in (("seq", "qual", own, None), ("xi", "yi", np.full(len(own), first_index), first), ("xj", "yj", np.full(len(own), second_index), first)):
            (bases, base_at, length), (quals, qual_at, most) = _bytes(batch.column(seq)), _bytes(batch.column(qual))
            # A base without a quality has none between 0 and 50.
            length = np.minimum(length, most)
            if used is not None:
                length = np.where(used, length, 0)
            i = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            base, q = letter[bases[np.repeat(base_at, length) + i]], quals[np.repeat(qual_at, length) + i].astype(np.int64) - 33
            good = (base >= 0) & (q >= 0) & (q <= 50)
            keys = ((np.repeat(offset, length) + i + 1) * 204 + base * 51 + q)[good]
            if not len(keys):
                continue
            if keys.max() < HELD_CYCLES * 204:
                n = np.bincount(keys, minlength=len(held))
                n[: len(held)] += held
                held = n
            else:
                yield rows(*np.unique(keys, return_counts=True))
    keys = np.flatnonzero(held)
    yield rows(keys, held[keys])


QUANTILES = [0.01, 0.05, 0.10, 0.25, 0.75, 0.90, 0.95, 0.99]


def quality_quantiles(histogram: DataFrame) -> DataFrame:
    """Mean, extremes and quantiles of quality by cycle and base, from the counts."""
    p = F.percentile("q", F.array(*map(F.lit, QUANTILES)), F.col("n"))
    made = histogram.groupBy("cycle", "base").agg((F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean_q"), F.min("q").alias("min_q"), F.max("q").alias("max_q"), p.alias("p"))
    return made.select("cycle", "base", "mean_q", "min_q", "max_q", *[F.get("p", F.lit(i)).alias(f"p{round(100 * x):02d}") for i, x in enumerate(QUANTILES)])


def insert_sizes(reads: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Reads by read group and insert size (read length if unpaired); groups of the header without any are listed with 0."""
    pair = F.col("mapped") & F.col("proper_pair") & F.col("first_mate") & (F.col("insert_size") > 1)
    size = F.when(~F.col("paired"), F.length("seq")).when(pair, F.col("insert_size"))
    counted = reads.where(F.col("rg").isNotNull()).select("rg", size.alias("size")).where("size IS NOT NULL").groupBy("rg", "size").agg(F.count("*").alias("n"))
    if groups is None:
        return counted
    return groups.select("rg").distinct().join(counted, "rg", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def reported_groups(sizes: DataFrame, least: int = 10) -> DataFrame:
    """Groups with more than `least` different sizes."""
    return sizes.groupBy("rg").agg(F.count_distinct("size").alias("n_sizes")).where(F.col("n_sizes") > least)


def cluster_count(reads: DataFrame) -> DataFrame:
    """A10: fragments: first mates and unpaired reads, with and without duplicates."""
    one = ~F.col("paired") | F.col("first_mate")
    return reads.agg(F.count_if(one).alias("n_fragments"), F.count_if(one & ~F.col("is_duplicate")).alias("n_without_duplicates"))


def reconcile(expected: DataFrame, datasets: DataFrame) -> DataFrame:
    """OK where a dataset's fragments equal the expected clusters (one row), else ERROR."""
    return datasets.crossJoin(expected.select("n_expected").limit(1)).withColumn("status", F.when(F.col("n") == F.col("n_expected"), "OK").otherwise("ERROR"))


def index_tally(reads: DataFrame, top: int | None = None, column: str = "xi") -> DataFrame:
    """Reads by index sequence; the top ones if asked."""
    counted = reads.groupBy(F.col(column).alias("index")).agg(F.count("*").alias("n"))
    return counted if top is None else counted.orderBy(F.desc("n"), "index").limit(top)


#: Hashes of places (or names) that are counted, and reads of one hash from which on its places are deep.
PLACE_HASHES, DEEP = 65_536, 1_000_000


def _crowded(hashed: DataFrame) -> list[int]:
    """Values of __hash that more than DEEP rows have."""
    return [r["__hash"] for r in hashed.groupBy("__hash").count().where(F.col("count") > DEEP).collect()]


def mate_pairs(reads: DataFrame) -> DataFrame:
    """First mates with their mates, and whether they are equally long; a name with both paired and unpaired reads raises.

    The reads are dealt out by name once, unpaired ones with them, and the mates and the check of a name are gathered there.
    Names of very many reads, found by counting hashes of names, are joined instead.
    """
    told = F.raise_error(F.concat(F.lit("paired and unpaired reads of one name: "), F.col("name"))).cast("boolean")
    shape = lambda met: met.withColumn("equal_length", F.length("seq1") == F.length("seq2"))
    dealt = reads.where("name IS NOT NULL").select("name", "paired", "first_mate", "second_mate", *[F.when(F.col("paired"), F.col(c)).alias(c) for c in ("seq", "qual")], F.pmod(F.xxhash64("name"), F.lit(PLACE_HASHES)).alias("__hash"))
    crowded = _crowded(dealt.where("paired").select("__hash"))
    side = lambda c: F.collect_list(F.when(F.col("paired") & F.col(c) & F.col("seq").isNotNull(), F.struct("seq", "qual")))
    few = dealt.where(~F.col("__hash").isin(crowded)) if crowded else dealt
    gathered = few.drop("__hash").repartition("name").groupBy("name").agg(F.min("paired").alias("least"), F.max("paired").alias("most"), side("first_mate").alias("one"), side("second_mate").alias("two"))
    kept = gathered.where(F.when(F.col("most") & ~F.col("least"), told).otherwise((F.size("one") > 0) & (F.size("two") > 0)))
    made = shape(kept.select("name", "two", F.inline("one").alias("seq1", "qual1")).select("name", "seq1", "qual1", F.inline("two").alias("seq2", "qual2")))
    if not crowded:
        return made
    many = dealt.where(F.col("__hash").isin(crowded))
    odd = many.groupBy("name").agg(F.min("paired").alias("least"), F.max("paired").alias("most")).where("most AND NOT least").select("name", F.lit(True).alias("mixed"))
    mates = lambda c, s: many.where("paired").where(c).select("name", F.col("seq").alias(f"seq{s}"), F.col("qual").alias(f"qual{s}"))
    met = mates("first_mate", 1).join(mates("second_mate", 2), "name", "full").join(odd, "name", "left")
    return made.unionByName(shape(met.where(F.when(F.col("mixed"), told).otherwise(F.col("seq1").isNotNull() & F.col("seq2").isNotNull())).drop("mixed")))


def unpaired_mates(reads: DataFrame) -> DataFrame:
    """Paired reads whose mate is missing."""
    a, b = reads.where("paired AND first_mate"), reads.where("paired AND second_mate")
    return a.join(b, "name", "left_anti").select("name", F.lit("second").alias("missing")).unionByName(b.join(a, "name", "left_anti").select("name", F.lit("first").alias("missing")))


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """C-3: of mapped reads at one place all but the one with the highest quality sum (ties: name) are duplicates.

    A place is the read group, reference (where there is one), position, strand and insert size.
    Reads are dealt out by place once, and a place's best is found in the same task.  Deep pile-ups, found by counting hashes of
    places, go another way: their best is a minimum that combines before the shuffle and is joined to them.
    """
    place = [c for c in ("rg", "ref", "pos", "reverse", "insert_size") if c != "ref" or "ref" in reads.columns]
    mapped = reads.where("mapped").select("name", "qual", *place, F.pmod(F.xxhash64(*place), F.lit(PLACE_HASHES)).alias("__hash"))
    crowded = _crowded(mapped)
    best, n = F.min(F.struct(-F.col("sum_q"), F.col("name"))), F.count("*")
    scored = lambda rows: rows.select("name", *place, quality.total().alias("sum_q"))
    shape = lambda rows: rows.select("name", "sum_q", "n_at_place", (F.col("name") != F.col("best")["name"]).alias("duplicate"))
    at = Window.partitionBy(*place)
    made = shape(scored(mapped.where(~F.col("__hash").isin(crowded)) if crowded else mapped).withColumns({"best": best.over(at), "n_at_place": n.over(at)}))
    if not crowded:
        return made
    deep = scored(mapped.where(F.col("__hash").isin(crowded)))
    known = deep.groupBy(*[F.col(c).alias(f"__{c}") for c in place]).agg(best.alias("best"), n.alias("n_at_place"))
    return made.unionByName(shape(deep.join(known, functools.reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place)))))


def coordinate_sort(reads: DataFrame, n: int | None = None) -> DataFrame:
    """C-4: range-partitioned by position and sorted within."""
    order = [c for c in ("ref", "pos") if c in reads.columns]
    dealt = reads.repartitionByRange(*order) if n is None else reads.repartitionByRange(n, *order)
    return dealt.sortWithinPartitions(*order)


def base_content(reads: DataFrame) -> DataFrame:
    """C-6: counts of A, C, G, T, N and GC % by position in the read."""
    cells = reads.where(F.length("seq") > 0).select(F.posexplode(F.split("seq", "")).alias("i", "base")).where("base <> ''")
    made = cells.groupBy((F.col("i") + 1).alias("cycle")).agg(*[F.count_if(F.col("base") == b).alias(f"n_{b.lower()}") for b in [*sequence.BASES, "N"]])
    gc = F.col("n_g") + F.col("n_c")
    return made.withColumn("gc_pct", sequence.ratio_percent(gc, F.col("n_a") + F.col("n_t")))


def gc_per_read(reads: DataFrame) -> DataFrame:
    """C-6: reads by GC % of their resolved bases, rounded down."""
    gc = F.floor(F.try_divide(100 * (sequence.count_of("seq", "G") + sequence.count_of("seq", "C")), sequence.resolved()))
    return reads.groupBy(gc.alias("gc_pct")).agg(F.count("*").alias("n"))


def quality_per_read(reads: DataFrame) -> DataFrame:
    """C-6: reads by mean quality, rounded down."""
    return reads.groupBy(F.floor(F.try_divide(quality.total(), F.length("qual"))).alias("mean_q")).agg(F.count("*").alias("n"))


def length_distribution(reads: DataFrame) -> DataFrame:
    """C-6."""
    return reads.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("n"))


def duplication_levels(reads: DataFrame) -> DataFrame:
    """C-6: how many sequences occur once, twice, ..."""
    return reads.groupBy("seq").agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("n_sequences"))


def kmers(reads: DataFrame, k: int = 5) -> DataFrame:
    """C-6: resolved k-mers and how often they occur."""
    parts = F.transform(F.sequence(F.lit(1), F.length("seq") - k + 1), lambda i: F.substring(F.col("seq"), i, F.lit(k)))
    return reads.where(F.length("seq") >= k).select(F.explode(parts).alias("kmer")).where(~F.col("kmer").contains("N")).groupBy("kmer").agg(F.count("*").alias("n"))


def density(values: DataFrame, column: str, most: float, bins: int = 50) -> DataFrame:
    """The density of a clipped metric in equal bins from 0 to `most`."""
    # A missing value falls into the last bin and is not counted there: a filter before it would make the metric anew.
    bin_of = F.least(F.lit(bins - 1), F.floor(sequence.clip(F.col(column), most) * (bins / most))).cast("int")
    binned = values.groupBy(bin_of.alias("bin")).agg(F.count(F.col(column)).alias("n")).where("n > 0")
    # As many rows as there are bins.
    total = F.sum("n").over(Window.partitionBy())
    return binned.select("bin", "n", (F.col("n") / total / (most / bins)).alias("density"))


def kernel_density(weighted: DataFrame, column: str, weight: str, grid: list[float], bandwidth: float = 1.0) -> DataFrame:
    """Weighted Gaussian density on a fixed grid of points (weights first summed per value)."""
    summed = weighted.groupBy(column).agg(F.sum(weight).alias("w"))
    points = F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("x")
    at = summed.select(column, "w", points)
    kernel = F.exp(-F.pow((F.col("x") - F.col(column)) / bandwidth, 2) / 2) / (bandwidth * 2.5066282746310002)
    return at.groupBy("x").agg((F.sum(F.col("w") * kernel) / F.sum("w")).alias("density"))


