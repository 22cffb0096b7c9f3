"""Exchange of packed hash sets: which of a chunk's hashes does the rest of the corpus share?

Documents are dealt into chunks of some megabytes by a hash.  A chunk
sends its sorted unique keys, cut into ranges ("buckets") of the hash space, as one
binary row per bucket; a bucket's task merges what all chunks sent and answers each
row with a bitmap over its keys.  A row thus carries thousands of keys at 4 to 6
bytes each instead of one at over 30, and a key with any number of copies comes at
most once from a chunk, so no key can make a bucket large.  Chunks and buckets have
a bounded size; their numbers grow with the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Keys are 48-bit.  Beside them a row may carry 48 further bits, and 2 flags, for each.
KEY_BITS = 48
SENT = "phase int, bucket int, chunk long, n long, keys binary, rest binary, flags binary"
SENT_ARROW = pa.schema([("phase", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("rest", pa.binary()), ("flags", pa.binary())])
ANSWER = "phase int, bucket int, chunk long, bits binary"
ANSWER_ARROW = pa.schema([("phase", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("bits", pa.binary())])


def deal(docs: DataFrame, by: list[Column], text_col: str, chunk_bytes: int, keys_per_byte: float, bucket_keys: int) -> tuple[DataFrame, str, int]:
    """(docs with a chunk number, dealt out by it; the name of its column; log2 of the number of buckets).

    Rows with equal values of `by` meet in one chunk.
    """
    spark = docs.sparkSession
    size = common.text_bytes(docs, text_col)
    chunks = max(-(-size // chunk_bytes), 3 * common.partitions(spark))
    bits = int(max(4, np.ceil(np.log2(max(1, size * keys_per_byte / bucket_keys)))))
    chunk = common.fresh("__chunk", docs.columns)
    dealt = docs.withColumn(chunk, F.pmod(F.xxhash64(*by), F.lit(chunks)))
    return dealt.repartition(common.partitions(spark), chunk), chunk, bits


def planes(values: np.ndarray) -> bytes:
    """The used low bytes of uint64 values, byte by byte: one count byte, then the planes."""
    if not len(values):
        return b"\0"
    width = (int(values.max()).bit_length() + 7) // 8
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    width = data[0]
    if n and width:
        out[:, :width] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, n).T
    return out.view("<u8").ravel()


def to_key(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


def send(phase: int, chunk: int, keys: np.ndarray, bits: int, flags: np.ndarray | None = None, rest: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows for sorted keys; flags are 2-bit values, rest 48-bit ones."""
    cuts = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - bits))
    rows: list[list] = [[], [], [], []]
    used = np.flatnonzero(np.diff(cuts))
    for k in used.tolist():
        a, b = cuts[k], cuts[k + 1]
        part = keys[a:b]
        rows[0].append(int(b - a))
        rows[1].append(planes(np.concatenate([part[:1], np.diff(part)])))
        rows[2].append(None if rest is None else planes(rest[a:b]))
        rows[3].append(None if flags is None else pack2(flags[a:b]))
    m = len(used)
    return pa.RecordBatch.from_arrays([pa.array(np.full(m, phase, np.int32)), pa.array(used.astype(np.int32)), pa.array(np.full(m, chunk, np.int64)), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.binary())], schema=SENT_ARROW)


def pack2(flags: np.ndarray) -> bytes:
    return np.packbits(np.stack([flags & 1, flags >> 1], 1).ravel().astype(np.uint8)).tobytes()


def unpack2(data: bytes, n: int) -> np.ndarray:
    two = np.unpackbits(np.frombuffer(data, np.uint8), count=2 * n).reshape(-1, 2)
    return two[:, 0] | (two[:, 1] << 1)


def received(t: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """(row, keys, flags, rest) for every row of a bucket."""
    for i in range(t.num_rows):
        n = t["n"][i].as_py()
        keys = np.cumsum(unplanes(t["keys"][i].as_py(), n), dtype=np.uint64)
        flags, rest = t["flags"][i].as_py(), t["rest"][i].as_py()
        yield i, keys, None if flags is None else unpack2(flags, n), None if rest is None else unplanes(rest, n)


def answers(sent: DataFrame, judge: Callable[[pa.Table], list[np.ndarray]]) -> DataFrame:
    """judge gets a bucket's rows and gives a boolean array over the keys of each."""

    def bucket(t):
        bits = [np.packbits(x).tobytes() for x in judge(t)]
        return pa.Table.from_arrays([t["phase"], t["bucket"], t["chunk"], pa.array(bits, pa.binary())], schema=ANSWER_ARROW)

    return sent.groupBy("bucket").applyInArrow(bucket, ANSWER)


def said(t: pa.Table, phase: int, keys: np.ndarray, bits: int) -> np.ndarray:
    """The boolean answers of one phase over a chunk's sorted keys."""
    out = np.zeros(len(keys), dtype=bool)
    cuts = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - bits))
    for p, k, data in zip(t["phase"].to_pylist(), t["bucket"].to_pylist(), t["bits"].to_pylist(), strict=True):
        if p == phase:
            a, b = cuts[k], cuts[k + 1]
            out[a:b] = np.unpackbits(np.frombuffer(data, np.uint8), count=int(b - a)).astype(bool)
    return out


def member(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x in sorted_keys, elementwise."""
    if not len(sorted_keys):
        return np.zeros(len(x), dtype=bool)
    at = np.searchsorted(sorted_keys, x)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == x
