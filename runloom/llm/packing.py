"""Operator 5: packing token pieces into fixed-length sequences by the length histogram."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, common

SLICE_BYTES = 1 << 20


def pieces(docs: DataFrame, path: str, id_col: str, text_col: str, size: int, end_id: int, with_ids: bool) -> DataFrame:
    """The documents' ids, an end id behind each, cut into pieces of `size` and a rest."""
    schema = T.StructType([docs.schema[id_col]] + T.StructType.fromDDL("start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids).fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for part in common.parts(batches, 1, SLICE_BYTES):
            ids, n = encoder.encode(common.to_bytes(part.column(1)))
            limits = np.cumsum(n + 1)
            all_ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
            count = -(-(n + 1) // size)
            doc = np.repeat(np.arange(len(n)), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * size
            length = np.minimum(size, (n + 1)[doc] - start)
            at = (limits - n - 1)[doc] + start
            raw = all_ids.tobytes()
            crc = [zlib.crc32(raw[4 * x : 4 * (x + y)]) for x, y in zip(at.tolist(), length.tolist(), strict=True)]
            out = [part.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array((n + 1)[doc])]
            if with_ids:
                out.append(pa.ListArray.from_arrays(np.append(at, len(all_ids)).astype(np.int32), all_ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def shortest_pack_first(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns for a length histogram: (sequences, [(length, how many of it)]).

    Lengths are placed longest first, each into the packs with most room, all packs of
    a pattern at once; a length that fits nowhere opens packs of its own.  A step
    splits at most one pattern and opens at most one, so there are at most two
    patterns for each length, whatever the number of documents.
    """
    heap: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # (-room, order, packs, lengths)
    order = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if heap and -heap[0][0] >= length:
                room, _, packs, inside = heapq.heappop(heap)
                room = -room
            else:
                # As many packs as whole fills of this length need, with the rest in one more.
                room, packs, inside = size, -(-left // (size // length)), []
            # Filling a pack wholly with this length at once is the same as one by one.
            each = 1
            if not inside:
                each = size // length
                if left < each * packs and left // each < packs:
                    packs = left // each or 1
                    each = min(each, left)
            take = min(packs, left // each)
            if take < packs and inside:
                order += 1
                heapq.heappush(heap, (-room, order, packs - take, inside))
            merged = [*inside]
            if merged and merged[-1][0] == length:
                merged[-1] = (length, merged[-1][1] + each)
            else:
                merged.append((length, each))
            left -= take * each
            order += 1
            heapq.heappush(heap, (each * length - room, order, take, merged))
    return [(packs, inside) for _, _, packs, inside in sorted(heap, key=lambda x: x[1])]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pack the documents into sequences of at most `size` tokens.

    Ids come from the tokenizer file at `path`, without special tokens, and `end_id` behind each
    document.  Documents are cut into pieces of `size` ids and a rest.  The histogram
    of piece lengths (at most `size` rows, the only thing collected) is packed on the driver by
    shortest-pack-first; a piece then finds its slot from its rank among the pieces of its
    length.  Ranks come from windows over (length, salt) plus the salts' running totals,
    so one common length is spread over many tasks.

    Returns one row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and ids if asked.  Null and empty texts are one piece with the end id.  Rows with equal ids are packed
    each for itself.  Other input columns are not returned.
    """
    spark = docs.sparkSession
    cut = common.table(pieces(docs, path, id_col, text_col, size, end_id, with_ids))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    patterns = shortest_pack_first(counts, size)

    # Slots by length: rank interval starts, and of each the pattern's first sequence, how many it takes, offset.
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first_sequence = 0
    for packs, inside in patterns:
        offset = 0
        for length, each in inside:
            slots.setdefault(length, []).append((used.get(length, 0), first_sequence, each, offset))
            used[length] = used.get(length, 0) + packs * each
            offset += length * each
        first_sequence += packs
    arrays = {k: np.array(v, dtype=np.int64).T for k, v in slots.items()}

    salts = 4 * common.partitions(spark)
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(salts)))
    before = (
        salted.groupBy("length", "__salt").count()
        .withColumn("__before", F.sum("count").over(Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "__salt", F.coalesce("__before", F.lit(0)).alias("__before"))
    )
    within = Window.partitionBy("length", "__salt").orderBy(id_col, "start", "ids_crc32")
    ranked = salted.withColumn("__row", F.row_number().over(within)).join(before, ["length", "__salt"]).withColumn("__rank", F.col("__before") + F.col("__row") - 1).drop("__row", "__before", "__salt")
    columns = [c for c in cut.columns]
    ranked = ranked.select(*columns, "__rank")
    schema = T.StructType([*cut.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(zero_copy_only=False), batch.column("__rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                starts, first, each, off = arrays[x]
                k = np.searchsorted(starts, rank[at], side="right") - 1
                i = rank[at] - starts[k]
                sequence[at] = first[k] + i // each[k]
                offset[at] = off[k] + i % each[k] * x
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(place, schema)
