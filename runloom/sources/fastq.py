"""S3, K3: FASTQ."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """S3: reads of four lines each; a first line without @, or a file whose lines are no multiple of four, raises.

    Files of any size are read in splits.  The lines of every split are counted first (one row a split), so that each split knows which of its
    lines make whole records: these are put together where they are read, and only the few lines of a record that two splits share are
    shuffled.  Lines that are empty count (a read can be empty).
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.rtrim(F.col("value"), F.lit("\r")).alias("value"))
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row a split; all files are numbered through, as each has a multiple of four lines.
    whole = Window.partitionBy("file")
    total = F.sum("n").over(whole)
    odd = F.raise_error(F.concat(F.lit("lines are no multiple of four in "), "file")).cast("long")
    splits = counts.withColumn("in_file", F.when(total % 4 != 0, odd).otherwise(F.coalesce(F.sum("n").over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    head = F.pmod(-F.col("in_file"), F.lit(4))
    splits = splits.withColumns({"head": F.least("n", head), "stop": F.greatest(head, F.col("n") - (F.col("in_file") + F.col("n")) % 4)})
    placed = lines.join(F.broadcast(splits), ["file", "block"]).withColumn("i", F.col("at") - F.col("first"))
    inner = (F.col("i") >= F.col("head")) & (F.col("i") < F.col("stop"))
    records = placed.where(inner).select("value").mapInArrow(_by_four, "id string, seq string, qual string")
    line = F.col("in_file") + F.col("i")
    part = lambda k, name: F.max(F.when(line % 4 == k, F.col("value"))).alias(name)
    shared_ones = placed.where(~inner).groupBy("file", F.floor(line / 4).alias("record")).agg(part(0, "id"), part(1, "seq"), part(3, "qual"))
    found = records.unionByName(shared_ones.select("id", "seq", "qual"))
    checked = F.when(F.col("id").startswith("@"), F.substr("id", F.lit(2))).otherwise(F.raise_error(F.concat(F.lit("not a FASTQ definition line: "), "id")))
    return found.select(checked.alias("id"), "seq", "qual")


def _by_four(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in their order, four to a record, as rows (id, seq, qual)."""
    rest = None
    for batch in batches:
        lines = batch.column(0)
        if rest is not None and len(rest):
            lines = pa.concat_arrays([rest, lines])
        n = len(lines) // 4 * 4
        at = np.arange(0, n, 4)
        if n:
            yield pa.RecordBatch.from_arrays([lines.take(pa.array(at + k)) for k in (0, 1, 3)], names=["id", "seq", "qual"])
        rest = lines.slice(n)


def write_fastq(reads: DataFrame, path: str, suffix: str = "") -> None:
    """K3: one side of a (pair of) FASTQ from id, seq, qual."""
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), F.col("id"), F.lit(suffix)), "seq", F.lit("+"), "qual").alias("value")).write.text(path)


def write_fastq_pair(pairs: DataFrame, path: str) -> None:
    """K3: both sides of a pair in one pass, from id, seq1, qual1, seq2, qual2: folders side=1 and side=2; a side that is null is left out."""
    entry = lambda k: F.struct(F.lit(k).alias("side"), F.concat_ws("\n", F.concat(F.lit("@"), F.col("id"), F.lit(f"/{k}")), f"seq{k}", F.lit("+"), f"qual{k}").alias("value"), F.col(f"seq{k}").isNotNull().alias("there"))
    pairs.select(F.inline(F.array(entry(1), entry(2)))).where("there").select("side", "value").write.partitionBy("side").text(path)
