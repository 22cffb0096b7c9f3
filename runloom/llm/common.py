"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: \x20 and \x09-\x0D.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd multipliers and starting values of the hashes; those of different seeds are independent.
SEEDS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
WINDOW_SEEDS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
#: Spans of more bytes than this are hashed one by one.
LONG_SPAN = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A temporary folder is used where that is unset and all work is done on this machine (local tests);
    on a cluster that raises, since the executors could not see such a folder.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that the executors share")
        known = tempfile.mkdtemp(prefix="runloom-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(known)
    return known.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame) -> DataFrame:
    """Write df as Parquet under the shared checkpoint folder and read it back.

    Columnar and compressed, for intermediate results that are read several times.
    """
    path = f"{shared_dir(df.sparkSession)}/runloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """The name, with as many underscores behind it as keep it apart from those taken."""
    while name.lower() in (x.lower() for x in taken):
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts: one aggregate scan of one column."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def slices(lengths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive row ranges of about `most` bytes; a longer row stands alone."""
    out, start, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            out.append((start, i))
            start, total = i, 0
        total += n
    if start < len(lengths):
        out.append((start, len(lengths)))
    return out


def parts(batches, text: int, most: int = 1 << 20):
    """The batches cut into parts of about `most` bytes of the text column, so that little is unpacked at a time."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(lengths, most):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def to_bytes(column) -> list[bytes]:
    """UTF-8 of a string column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, a bijection."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of the bytes of every span [start, end).

    Eight bytes at a time go through the finaliser, over all spans at once; spans of more than
    LONG_SPAN bytes are hashed by XXH3.  Spans of the same length up to 8 bytes never collide.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))
    mask = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    start = mix(np.arange(LONG_SPAN + 2, dtype=np.uint64) * np.uint64(WINDOW_SEEDS[0]) + np.uint64(seed))
    out = mix(start[np.minimum(size, LONG_SPAN + 1)] ^ ((eight[starts] & mask[np.minimum(size, 8)]) * np.uint64(seed)))
    at = np.flatnonzero((size > 8) & (size <= LONG_SPAN))
    for k in range(8, LONG_SPAN, 8):
        if not len(at):
            break
        left = size[at] - k
        out[at] = mix(out[at] ^ ((eight[starts[at] + k] & mask[np.minimum(left, 8)]) * np.uint64(seed)))
        at = at[left > 8]
    long = np.flatnonzero(size > LONG_SPAN)
    if len(long):
        data = memoryview(np.ascontiguousarray(buf))
        digest = xxhash.xxh3_64_intdigest
        out[long] = np.array([digest(data[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)], np.uint64)
    return out


def window_hashes(items: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of every n consecutive items (len(items) - n + 1 of them).

    Hashes of 1, 2, 4, ... items are joined in pairs through the finaliser; a window is joined from
    those of the powers of two that make up n.
    """
    size = len(items) - n + 1
    if size < 1:
        return np.zeros(0, dtype=np.uint64)

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        b = b * np.uint64(seed)
        b ^= b >> np.uint64(32)
        b += a
        return mix(b)

    out, done, power, width = None, 0, items, 1
    while True:
        if n & width:
            part = power[done : done + size]
            out = part if out is None else join(out, part)
            done += width
        if done == n:
            return out.copy() if out is items else out
        power = join(power[:-width], power[width:])
        width *= 2


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, runs of bytes that are not ASCII white space."""
    edge = np.zeros(len(buf) + 2, dtype=np.int8)
    edge[1:-1] = ~IS_SPACE[buf]
    step = np.diff(edge)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) pairs, node <> root, that join the same nodes as the pairs (a, b)."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[at], nodes[label[at]]


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: (node, component = smallest node).

    Alternating large-star and small-star rounds (Kiveris et al., 2014).  Which nodes have to be moved, and to
    what, is aggregated first, with partial aggregates, and checkpointed as a table of its own; the edges are
    joined to that.  So a finished star, whose root has all the edges, moves nothing, and a node with very many
    edges leaves a plain join whose large partitions Spark can split.  Only whether anything moves
    reaches the driver.  Null ends and loops are ignored.
    """
    links = checkpoint(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct()
    )
    for _ in range(most_rounds):
        # Large star: the edges of a node with a smaller neighbour go to the smallest one.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = checkpoint(both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")).where("m < u AND most > u").select(F.col("u").alias("v"), "m"))
        settled = moved.isEmpty()
        if not settled:
            links = checkpoint(links.join(moved, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct())
        # Small star: the smaller neighbours of a node go to the smallest one of them.
        lower = checkpoint(links.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")).where("m < most").select("u", "m"))
        if not lower.isEmpty():
            stays = F.col("m").isNull() | (F.col("v") == F.col("m"))
            links = checkpoint(links.join(lower, "u", "left").select(F.when(stays, F.col("u")).otherwise(F.col("v")).alias("u"), F.coalesce("m", "v").alias("v")).distinct())
        elif settled:
            break
    else:
        raise RuntimeError(f"components: not settled after {most_rounds} rounds")
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
