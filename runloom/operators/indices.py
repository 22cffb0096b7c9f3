"""Index sheets, index dictionaries and control reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence


def lookup(sheet: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ids to sequences; p7 is required (rows without stay, with a null), p5 optional."""
    kind = lambda k: dictionary.where(F.col("kind") == k).dropDuplicates(["id"]).select(F.col("id").alias(k), F.col("seq").alias(f"{k}_seq"))
    return sheet.join(kind("p7"), "p7", "left").join(kind("p5"), "p5", "left").select("name", "p7", "p5", "p7_seq", "p5_seq")


def invalid(sheet: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Problems of a sheet: (name, problem, value): unknown ids, illegal names, ids that the dictionary has twice."""
    found = []
    for k in ("p7", "p5"):
        ids = dictionary.where(F.col("kind") == k).select(F.col("id").alias(k))
        found.append(sheet.where(F.col(k).isNotNull()).join(ids, k, "left_anti").select("name", F.lit(f"unknown {k}").alias("problem"), F.col(k).alias("value")))
    found.append(sheet.where("p7 IS NULL").select("name", F.lit("missing p7").alias("problem"), F.lit(None).cast("string").alias("value")))
    found.append(sheet.where(~F.col("name").rlike("^[A-Za-z0-9_.-]+$")).select("name", F.lit("illegal name").alias("problem"), F.col("name").alias("value")))
    twice = dictionary.groupBy("kind", "id").count().where("count > 1")
    found.append(twice.select(F.lit(None).cast("string").alias("name"), F.concat(F.lit("duplicate "), F.col("kind")).alias("problem"), F.col("id").alias("value")))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def sheet_problems(lines: DataFrame, double: bool) -> DataFrame:
    """J2 on the lines of a sheet as entered (line from 0, value): (line, problem): wrong numbers of fields, wrong header."""
    fields = F.split("value", "\t")
    n = 3 if double else 2
    heads = ["#index", "p7", "p5"][:n]
    found = [F.when(F.size(fields) != n, F.lit(f"not {n} fields")), *[F.when((F.col("line") == 0) & F.coalesce(F.get(fields, F.lit(i)) != h, F.lit(True)), F.lit(f"header field {i + 1} is not {h}")) for i, h in enumerate(heads)]]
    return lines.select("line", F.explode(F.array_compact(F.array(*found))).alias("problem"))


def with_controls(sheet: DataFrame, controls: DataFrame) -> DataFrame:
    """The sheet and those control rows (name, p7, p5) whose p7 it lacks."""
    return sheet.select("name", "p7", "p5").unionByName(controls.join(sheet.select("p7"), "p7", "left_anti").select("name", "p7", "p5"))


def control_sequences(spark, length: int) -> DataFrame:
    """One control per base: the base repeated."""
    return spark.createDataFrame([(b,) for b in sequence.BASES], "base string").select(F.concat(F.lit("control"), "base").alias("name"), F.repeat("base", F.lit(length)).alias("p7"), F.lit(None).cast("string").alias("p5"))


def control_reads(reads: DataFrame, indices: list[str] | DataFrame, strict: bool = False) -> DataFrame:
    """P10: reads whose first index is one of the list, or of the column `seq` of a table; strict: a missing index raises."""
    # One expression for test and match: a filter of its own would be skipped for rows that cannot match.
    index = F.coalesce("xi", F.raise_error(F.lit("a read has no index")).cast("string")) if strict else F.col("xi")
    if isinstance(indices, DataFrame):
        return reads.join(indices.select(F.col("seq").alias("__seq")), index == F.col("__seq"), "left_semi")
    return reads.where(index.isin(indices))


def control_reads_by_cycle(fastq: DataFrame, index: str, index_start: int, read1: tuple[int, int], read2: tuple[int, int] | None = None) -> DataFrame:
    """FASTQ reads with the index at a cycle (from 1), cut into read 1 and read 2 by (start, length)."""
    part = lambda c, r: F.substring(F.col(c), F.lit(r[0]), F.lit(r[1]))
    found = fastq.where(F.substring("seq", index_start, len(index)) == index)
    out = found.select("id", part("seq", read1).alias("seq1"), part("qual", read1).alias("qual1"), "seq", "qual")
    if read2 is not None:
        out = out.withColumns({"seq2": part("seq", read2), "qual2": part("qual", read2)})
    return out.drop("seq", "qual")


def exclude_controls(table: DataFrame, column: str = "name", unknown: bool = True) -> DataFrame:
    """Without controls (and unassigned)."""
    return table.where(~sequence.control_name(F.col(column), unknown))
