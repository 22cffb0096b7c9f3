"""Operator 6: SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SLICE_BYTES = 1 << 20
BITS = 64
#: Members of a signature above which it is cut finer.
BLOCK = 4096
#: Rows (of 8 bytes) up to which the list of such signatures is broadcast.
MOST_BROADCAST = 50_000


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """The majority of XXH64 bits over the text's word shingles (A-Z lower-cased)."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum([len(x) + 1 for x in parts]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], dtype=">u8")
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = 4) -> DataFrame:
    """(id, fp): the fingerprint as a signed long; null text has none of the words and so fingerprint 0."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.parts(batches, 1, SLICE_BYTES):
            fp = np.array([fingerprint(x, words) for x in common.to_bytes(part.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def segments(distance: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(low bit, width) of distance // 2 + 1 segments: of these one holds at most one of the differing bits."""
    n = distance // 2 + 1
    cuts = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _variants(value: Column, distance: int, bits: int) -> list[tuple[int, int, Column]]:
    """(low bit, width, signature) for every segment and wildcard bit: the segment with that bit deleted, tagged by the bit's place."""
    cut = segments(distance, bits)
    width = max(w for _, w in cut)
    out = []
    for low, w in cut:
        segment = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << w) - 1))
        for i in range(w):
            out.append((low, w, segment.bitwiseAND(F.lit(((1 << w) - 1) & ~(1 << i))).bitwiseOR(F.lit((low + i) << width))))
    return out


def signatures(fps: DataFrame, distance: int) -> DataFrame:
    """(key, fp, node): one row per fingerprint and signature."""
    return fps.select(F.explode(F.array(*[x for _, _, x in _variants(F.col("fp"), distance, BITS)])).alias("key"), "fp", "node")


def finer_signatures(crowded: DataFrame, distance: int) -> DataFrame:
    """(key, fp, node): each row of a signature under every signature, made in the same way, of the bits outside its segment."""
    tag = F.shiftright("key", max(w for _, w in segments(distance)))
    made = None
    for low, w in segments(distance):
        rest = F.col("fp").bitwiseAND(F.lit((1 << low) - 1)).bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", low + w), low)) if low + w < BITS else F.col("fp").bitwiseAND(F.lit((1 << low) - 1))
        wider = [F.shiftleft("key", 24).bitwiseOR(x) for _, _, x in _variants(rest, distance, BITS - w)]
        part = crowded.where((tag >= low) & (tag < low + w)).select(F.explode(F.array(*wider)).alias("key"), "fp", "node")
        made = part if made is None else made.unionByName(part)
    return made


def _links(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among fp, as index pairs.

    Breadth-first with the set of those not yet reached, so that a dense group costs
    few comparisons and gives one link less than it has members.
    """
    a, b = [], []
    rest = np.arange(len(fp))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(fp[rest] ^ fp[x]) <= distance
            if near.any():
                found = rest[near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found.tolist())
                rest = rest[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _compare(key: np.ndarray, fp: np.ndarray, node: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows with equal keys; keys are sorted."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    a, b = [], []
    small = np.repeat(size <= 8, size)
    for lag in range(1, 8):
        at = np.flatnonzero(small[:-lag] & (key[:-lag] == key[lag:])) if len(key) > lag else np.zeros(0, np.int64)
        at = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= distance]
        a.append(node[at])
        b.append(node[at + lag])
    for s, n in zip(first[size > 8].tolist(), size[size > 8].tolist(), strict=True):
        x, y = _links(fp[s : s + n], distance)
        a.append(node[s + x])
        b.append(node[s + y])
    return np.concatenate(a), np.concatenate(b)


def _compared(rows: DataFrame, distance: int, most: int | None) -> DataFrame:
    """(a, b): a forest of the links among rows (key, fp, node) of equal key; for a key of more than `most` rows (key, null).

    Rows are dealt and sorted by key and compared as runs stream by; of a key with too many nothing is kept.
    """
    dealt = rows.repartition(common.partitions(rows.sparkSession), "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        crowded: int | None = None  # the key whose rows are passed over
        for batch in _with_end(batches):
            if batch is None:
                rows, kept = kept, None
            else:
                rows = [np.concatenate([x, y.to_numpy().view(x.dtype)]) for x, y in zip(kept, batch.columns, strict=True)]
                if crowded is not None:
                    rows = [x[np.searchsorted(rows[0], crowded, side="right") :] for x in rows]
                # The last run may go on in the next batch.
                stop = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
                rows, kept = [x[:stop] for x in rows], [x[stop:] for x in rows]
            over = []
            if most is not None:
                keys, n = np.unique(rows[0], return_counts=True)
                over += keys[n > most].tolist()
                if over:
                    fine = ~np.isin(rows[0], over)
                    rows = [x[fine] for x in rows]
                if kept is not None and len(kept[0]) > most:
                    crowded = int(kept[0][0])
                    over.append(crowded)
                    kept = [x[:0] for x in kept]
            a, b = common.contract(*_compare(*rows, distance)) if len(rows[0]) else (rows[0], rows[2])
            if len(a) or over:
                yield pa.RecordBatch.from_arrays([pa.array(np.append(a, np.array(over, np.int64))), pa.array([*b.tolist(), *[None] * len(over)], pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _crowd(rows: DataFrame, found: DataFrame) -> DataFrame | None:
    """The rows of the keys that were passed over; None if there are none."""
    keys = found.where("b IS NULL").select(F.col("a").alias("key"))
    n = keys.count()
    if not n:
        return None
    return rows.join(F.broadcast(keys) if n <= MOST_BROADCAST else keys, "key", "left_semi")


def links(fps: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that join every pair of distinct fingerprints within `distance` bits, maybe over others.

    fps: (fp, node), fingerprints distinct.  Fingerprints of one signature are compared.  A signature with more
    than BLOCK members is cut finer, by signatures of the bits outside its segment; if such a one still has more,
    its members are cut into blocks by a hash of the fingerprint, and every pair of blocks is compared for itself.
    """
    if distance < 2:
        raise ValueError("a distance of 2 bits or more")
    fps = fps.repartition(common.partitions(fps.sparkSession), "fp")
    rows = signatures(fps, distance)
    found = common.table(_compared(rows, distance, BLOCK))
    made = found
    crowd = _crowd(rows, found)
    if crowd is not None:
        rows = finer_signatures(crowd, distance)
        found = common.table(_compared(rows, distance, BLOCK))
        made = made.unionByName(found)
        crowd = _crowd(rows, found)
    if crowd is not None:
        crowd = common.table(crowd)
        sized = crowd.groupBy("key").agg(F.ceil(F.count("*") / (BLOCK // 2)).cast("int").alias("blocks"))
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.xxhash64("key", F.least(own, j), F.greatest(own, j)))
        blocks = crowd.join(sized, "key").select(F.explode(pairs).alias("key"), "fp", "node")
        made = made.unionByName(_compared(blocks, distance, None))
    return made.where("b IS NOT NULL")


def _with_end(batches):
    yield from (x for x in batches if x.num_rows)
    yield None


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, words: int = 4) -> DataFrame:
    """Fingerprint and component of every document.

    Fingerprints that differ in at most `distance` bits are linked.  They are cut into
    distance // 2 + 1 segments, of which one has at most one of the differing bits, and each
    segment is indexed once for each of its bits with that bit deleted: linked fingerprints
    share such a signature, and every shared signature is verified.  Only distinct
    fingerprints are compared, each under the smallest id that has it; copies are joined
    by equality.

    Returns id, fingerprint (16 hex digits), component_id (smallest id reachable), one row for each
    input row.  Null, empty and blank texts have fingerprint 0 and link like any other; a text of any length is
    hashed whole, in one task.  A row with a null id gets its fingerprint and the component of that fingerprint's
    other documents, or null.  Other input columns are not returned.
    """
    prints = common.table(fingerprints(docs, id_col, text_col, words))
    nodes = prints.where(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).cast("long").alias("node"))
    joined = common.components(links(nodes, distance))
    found = nodes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(found, "fp", "left").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4) -> DataFrame:
    """The input rows of one document per component: the smallest id (all rows that have it but one go).

    Of rows with the same id the one with the smallest text stays (null before others; the other columns decide ties).
    Rows with a null id have no group and all stay.
    """
    groups = near_duplicates(docs, id_col, text_col, distance)
    mine, n = common.fresh("__id", docs.columns), common.fresh("__n", docs.columns)
    stay = common.table(groups.where(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias(mine)).agg(F.count("*").alias(n)))
    chosen = docs.join(stay, F.col(id_col) == F.col(mine)).drop(mine)
    kept = chosen.where(F.col(n) == 1).drop(n)
    if not stay.where(F.col(n) > 1).isEmpty():
        whole = F.struct(*[F.col(c) for c in docs.columns])
        order = F.struct(F.col(text_col).isNotNull(), F.col(text_col), F.to_json(whole))
        kept = kept.unionByName(chosen.where(F.col(n) > 1).groupBy(F.col(id_col).alias(mine)).agg(F.min_by(whole, order).alias(n)).select(f"{n}.*"))
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


def brute_force(rows: list[tuple[int, str | None]], distance: int = 4) -> dict[int, tuple[str, int]]:
    """All pairs of documents, for tests."""
    fp = {i: fingerprint((t or "").encode()) for i, t in rows}
    ids = sorted(fp)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array([fp[i] for i in ids], dtype=np.uint64)
    for k, i in enumerate(ids):
        for m in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= distance):
            x, y = find(i), find(ids[k + 1 + int(m)])
            root[max(x, y)] = min(x, y)
    return {i: (f"{fp[i]:016x}", find(i)) for i in ids}
