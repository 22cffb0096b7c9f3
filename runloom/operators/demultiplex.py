"""C-1: assigning reads to samples by the likelihood of their indices.

No golden output exists for this operator; the score is our own: the log10 probability of
the read's index bases given a sample's, 1 - e for a match and e / 3 for a mismatch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.characters import codes

#: A sheet is a lab table of some hundred rows; more than this is refused instead of broadcast.
MOST_SAMPLES = 10_000


def _score(read: Column, qual: Column, sample: Column) -> Column:
    """Sum over the bases both have."""

    def one(i: Column) -> Column:
        e = F.least(F.lit(0.75), F.pow(F.lit(10.0), -F.greatest(F.ascii(F.substring(qual, i, F.lit(1))) - 33, F.lit(2)) / 10.0))
        same = F.substring(read, i, F.lit(1)) == F.substring(sample, i, F.lit(1))
        return F.when(same, F.log10(1 - e)).otherwise(F.log10(e / 3))

    n = F.least(F.length(read), F.length(sample), F.length(qual))
    return F.coalesce(F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, i: s + one(i))), F.lit(0.0))


#: Pairs of readings and samples that a task compares at once.
_PAIRS = 500_000


def _hashed(text: np.ndarray) -> np.ndarray:
    """Equal rows have equal numbers."""
    h = np.zeros(len(text), np.uint64)
    for c in text.T:
        h = (h + c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h


def _close(asked: np.ndarray, known: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two tables of characters with at most `most` mismatches.

    With so few mismatches one of most + 1 stretches is equal: the rows are looked up by the contents of each
    stretch, and a pair counts at its first equal one.
    """
    cut = [asked.shape[1] * k // (most + 1) for k in range(most + 2)]
    for k in range(most + 1):
        of_known = _hashed(known[:, cut[k] : cut[k + 1]])
        order = np.argsort(of_known, kind="stable")
        h = _hashed(asked[:, cut[k] : cut[k + 1]])
        first, last = np.searchsorted(of_known[order], h, "left"), np.searchsorted(of_known[order], h, "right")
        rows = np.flatnonzero(last > first)
        upto = np.cumsum((last - first)[rows])
        for part in np.split(rows, np.unique(np.searchsorted(upto, np.arange(_PAIRS, upto[-1] if len(upto) else 0, _PAIRS)))):
            n = (last - first)[part]
            row, sample = np.repeat(part, n), order[np.arange(n.sum()) + np.repeat(first[part] - (np.cumsum(n) - n), n)]
            differs = asked[row] != known[sample]
            good = differs.sum(1) <= most
            good &= ~differs[:, cut[k] : cut[k + 1]].any(1)
            for j in range(k):
                good &= differs[:, cut[j] : cut[j + 1]].any(1)
            yield row[good], sample[good]


def _near(samples: list[tuple[str, str, str | None]], most: int) -> Callable[..., Column]:
    """A function of the columns xi and xj: the samples (sample, s7, s5) with at most `most` mismatches over the bases both have, found within the batch by arrays."""
    fields = [("sample", pa.string()), ("s7", pa.string()), ("s5", pa.string())]
    table = pa.StructArray.from_arrays([pa.array([x[i] for x in samples], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])
    shapes: dict[tuple[int, int], list[int]] = {}
    for number, (_, s7, s5) in enumerate(samples):
        shapes.setdefault((len(s7), len(s5 or "")), []).append(number)
    known = {(l7, l5): (np.array(numbers), np.array([[ord(c) for c in samples[i][1] + (samples[i][2] or "")] for i in numbers], np.uint32).reshape(len(numbers), l7 + l5)) for (l7, l5), numbers in shapes.items()}

    # Not deterministic for Spark, so that no filter makes the search anew.
    def near(xi: pa.Array, xj: pa.Array) -> pa.Array:
        (data7, at7, length7), (data5, at5, length5) = codes(xi), codes(xj)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for (l7, l5), (numbers, texts) in known.items():
            n7, n5 = np.minimum(length7, l7), np.minimum(length5, l5)
            shape = n7 * (l5 + 1) + n5
            for both in np.unique(shape):
                (w7, w5), rows = divmod(int(both), l5 + 1), np.flatnonzero(shape == both)
                asked = np.concatenate([data7[at7[rows, None] + np.arange(w7)], data5[at5[rows, None] + np.arange(w5)]], 1)
                found += [(rows[r], numbers[s]) for r, s in _close(asked, np.concatenate([texts[:, :w7], texts[:, l7 : l7 + w5]], 1), most)]
        row, number = np.concatenate([r for r, _ in found]), np.concatenate([s for _, s in found])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(xi)))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), table.take(pa.array(number[np.argsort(row, kind="stable")])))

    kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n, _ in fields]))
    return F.arrow_udf(near, kind).asNondeterministic()


def candidates(readings: DataFrame, samples: DataFrame, most: int) -> DataFrame:
    """Pairs of readings (xi, yi, xj, yj) and samples (sample, s7, s5; as many as a sheet has) with at most `most` mismatches over the bases both have."""
    found = readings.withColumn("__near", _near(_listed(samples.select("sample", "s7", "s5")), most)(F.col("xi"), F.col("xj")))
    return found.select(*readings.columns, F.inline("__near"))


def _listed(sheet: DataFrame) -> list[tuple[str, str, str | None]]:
    rows = [tuple(r) for r in sheet.limit(MOST_SAMPLES + 1).collect()]
    if len(rows) > MOST_SAMPLES:
        raise ValueError(f"an index sheet has at most {MOST_SAMPLES} rows")
    return [r for r in rows if r[1] is not None]


def assign(reads: DataFrame, sheet: DataFrame, max_mismatches: int = 2, least_quality: float = 10.0, least_ratio: float = 1.0, fail: bool = True) -> DataFrame:
    """Reads with sample, second_sample, quality, ratio and status (assigned, conflict, poor, unknown).

    Samples within `max_mismatches` are candidates; they are found and scored where the reads are, and no read is
    shuffled.  quality is -10 log10 of the probability that the best is wrong among them, ratio the
    difference to the second in log10.  With fail, reads not assigned are failed.
    """
    near = _near(_listed(sheet.select("name", "p7_seq", "p5_seq")), max_mismatches)(F.col("xi"), F.col("xj"))
    # A reading without any base says nothing of its sample.
    read = F.coalesce(F.length("xi"), F.lit(0)) + F.coalesce(F.length("xj"), F.lit(0)) > 0

    def scored(s: Column) -> Column:
        score = _score(F.col("xi"), F.col("yi"), s["s7"]) + F.when(s["s5"].isNull(), 0.0).otherwise(_score(F.col("xj"), F.col("yj"), s["s5"]))
        return F.struct(F.round(score, 9).alias("score"), s["sample"].alias("sample"))

    out = reads.withColumn("__near", near)
    out = out.withColumn("__top", F.when(read & (F.size("__near") > 0), F.sort_array(F.transform("__near", scored), asc=False)))
    best, second = F.get("__top", F.lit(0)), F.get("__top", F.lit(1))
    total = F.aggregate("__top", F.lit(0.0), lambda t, x: t + F.pow(F.lit(10.0), x["score"]))
    wrong = F.greatest(F.lit(1e-12), 1 - F.pow(F.lit(10.0), best["score"]) / total)
    quality = F.when(best.isNotNull(), F.when(second.isNull(), 80.0).otherwise(-10 * F.log10(wrong)))
    out = out.withColumns({"sample": best["sample"], "second_sample": second["sample"], "quality": quality, "ratio": best["score"] - second["score"]}).drop("__near", "__top")
    status = F.when(F.col("sample").isNull(), "unknown").when(F.col("ratio") < least_ratio, "conflict").when(F.col("quality") < least_quality, "poor").otherwise("assigned")
    out = out.withColumn("assignment", status)
    return out.withColumn("failed_qc", F.col("failed_qc") | (F.col("assignment") != "assigned")) if fail else out


def unassigned(assigned: DataFrame) -> DataFrame:
    """The tally of index readings whose reads were not assigned, with the reason and the nearest samples."""
    rest = assigned.where("assignment <> 'assigned'")
    return rest.groupBy("xi", "xj", "assignment").agg(F.count("*").alias("n"), F.min("sample").alias("sample"), F.min("second_sample").alias("second_sample"))


def distributions(assigned: DataFrame, most: float = 80.0) -> DataFrame:
    """Reads by assignment quality and by ratio of best to second, both rounded down and clipped; kind tells which.  Without a second sample there is no ratio."""
    whole = lambda c: F.floor(F.least(F.lit(most), F.col(c))).cast("long")
    each = assigned.where("sample IS NOT NULL").select(F.inline(F.array(F.struct(F.lit("quality").alias("kind"), whole("quality").alias("value")), F.struct(F.lit("ratio").alias("kind"), F.when(F.col("second_sample").isNotNull(), whole("ratio")).alias("value")))))
    return each.where("value IS NOT NULL").groupBy("kind", "value").agg(F.count("*").alias("n"))


def summary(assigned: DataFrame) -> DataFrame:
    """Reads by sample and status."""
    return assigned.groupBy(F.coalesce("sample", F.lit("unknown")).alias("sample"), "assignment").agg(F.count("*").alias("n"))
