"""Operator 3: token counts of whole texts; huge ones in overlapping chunks that are spliced where they agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, common

SLICE_BYTES = 1 << 20
#: A boundary counts only if so many bytes of the chunk follow: more than the pattern or a special string looks ahead.
MARGIN = 32


def _whole(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Counts of texts that are encoded in one piece; nothing is shuffled."""
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL("n_bytes long, n_tokens long").fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for part in common.parts(batches, 1, SLICE_BYTES):
            texts = common.to_bytes(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(encoder.counts(texts))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(count, schema)


def _chunks(huge: DataFrame, id_col: str, text_col: str, chunk: int, overlap: int) -> DataFrame:
    """(id, uid, k, last, from, data): chunk k with `overlap` bytes of the next one."""
    schema = T.StructType([huge.schema[id_col], *T.StructType.fromDDL("uid string, k long, last boolean, at long, data binary").fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py().encode()

                def lead(i: int, text: bytes = text) -> int:
                    while 0 < i < len(text) and text[i] & 0xC0 == 0x80:
                        i -= 1
                    return min(i, len(text))

                # A rest no longer than the overlap belongs to the chunk before.
                starts = [lead(i) for i in range(0, max(1, len(text) - overlap), chunk)]
                ends = [*(lead(s + overlap) for s in starts[1:]), len(text)]
                n = len(starts)
                for a in range(0, n, 64):
                    b = min(n, a + 64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([row] * (b - a))), batch.column(1).take(pa.array([row] * (b - a))), pa.array(range(a, b), pa.int64()), pa.array([i == n - 1 for i in range(a, b)]), pa.array(starts[a:b], pa.int64()), pa.array([text[x:y] for x, y in zip(starts[a:b], ends[a:b], strict=True)], pa.binary())],
                        names=schema.names,
                    )

    return huge.select(id_col, "uid", text_col).mapInArrow(cut, schema)


def _encoded(chunks: DataFrame, id_col: str, path: str, overlap: int) -> DataFrame:
    """Per chunk: its tokens, and the pre-token starts (offset in the document -> tokens before) in both overlaps."""
    schema = T.StructType([chunks.schema[id_col], *T.StructType.fromDDL("uid string, k long, last boolean, total long, head map<long,long>, tail map<long,long>").fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for batch in batches:
            out: list[list] = [[], [], []]
            for at, data, last in zip(batch.column("at").to_pylist(), batch.column("data").to_pylist(), batch.column("last").to_pylist(), strict=True):
                starts, n = encoder.sizes([data])
                before = np.cumsum(n)
                out[0].append(int(before[-1]) if len(before) else 0)
                before -= n
                head = starts < overlap
                tail = (starts >= len(data) - overlap - 4) & (starts <= len(data) - MARGIN) & (not last)
                for k, which in ((1, head), (2, tail)):
                    out[k].append(list(zip((starts[which] + at).tolist(), before[which].tolist(), strict=True)))
            kind = pa.map_(pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out[0], pa.int64()), pa.array(out[1], kind), pa.array(out[2], kind)], names=schema.names)

    return chunks.mapInArrow(encode, schema)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, chunk: int = 32 << 10, overlap: int = 256) -> DataFrame:
    """Token counts as the tokenizers library gives them, without added tokens.

    Texts of more than `chunk` bytes are cut into chunks that overlap by `overlap`
    bytes and encoded apart, over all tasks.  Two neighbours are spliced at the first
    offset in their overlap at which both have a pre-token start.  That is proven to be a boundary of the
    whole text: pre-tokens are matched from left to right, and the match at an
    offset depends on the text from there on and at most MARGIN bytes past its end.  So
    the left chunk, itself right from its own splice on, is right there, and the right
    chunk is from there on.  Documents with a pair of chunks that share no start are
    done anew with eight times the overlap, until one chunk holds all if need be.

    Returns id, n_bytes, n_tokens, over_limit, one row for each input row.  Null
    text counts as empty.  Equal rows are allowed (chunks are known by id and a digest
    of the text).  Other input columns are not returned.
    """
    rows = docs.select(id_col, text_col)
    small = _whole(rows.where(F.coalesce(F.octet_length(text_col), F.lit(0)) <= chunk), id_col, text_col, path)
    huge = rows.where(F.octet_length(text_col) > chunk).withColumn("uid", F.sha2(text_col, 256))
    spark = docs.sparkSession
    done, todo = None, huge
    while True:
        cut = _chunks(todo, id_col, text_col, chunk, overlap).repartition(common.partitions(spark), "uid", "k")
        parts = _encoded(cut, id_col, path, overlap).dropDuplicates([id_col, "uid", "k"])
        following = F.lead("head").over(Window.partitionBy(id_col, "uid").orderBy("k"))
        shared = F.array_sort(F.array_intersect(F.map_keys("tail"), F.map_keys("next")))
        spliced = parts.withColumn("next", following).withColumn("cut", F.get(shared, F.lit(0)))
        own = F.when(F.col("last"), F.col("total")).otherwise(F.element_at("tail", F.col("cut")) - F.element_at("next", F.col("cut")))
        counted = common.checkpoint(spliced.groupBy(id_col, "uid").agg(F.sum(own).alias("n_tokens"), F.max(F.when(own.isNull(), 1).otherwise(0)).alias("again")))
        fine = counted.where("again = 0")
        done = fine if done is None else done.unionByName(fine)
        if counted.where("again = 1").isEmpty():
            break
        overlap *= 8
        chunk = max(chunk, 2 * overlap)
        known = counted.where("again = 1").select(F.col(id_col).alias("__id"), F.col("uid").alias("__uid"))
        todo = todo.join(known, todo[id_col].eqNullSafe(known["__id"]) & (todo["uid"] == known["__uid"]), "left_semi")
    done = done.select(F.col(id_col).alias("__id"), F.col("uid").alias("__uid"), "n_tokens")
    lengths = huge.select(id_col, "uid", F.octet_length(text_col).cast("long").alias("n_bytes"))
    large = lengths.join(done, lengths[id_col].eqNullSafe(done["__id"]) & (lengths["uid"] == done["__uid"])).select(id_col, "n_bytes", "n_tokens")
    return small.unionByName(large).withColumn("over_limit", F.col("n_tokens") > limit)
