"""Operator 7: lines repeated over documents, by once-seen and twice-seen Bloom filters."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, packed

SLICE_BYTES = 1 << 19
CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 1_000_000
#: Bits of each of a bucket's two filters, and hash functions.  Fixed: buckets have a bounded
#: number of keys (about BUCKET_KEYS), so this is 16 bits a key or more.
BLOOM_BITS = 1 << 24
BLOOM_HASHES = 4
#: Stands for a null id: such documents are one document, and never the one that keeps a line.
NO_ID = -(1 << 63)


class _Lines:
    """Lines of a chunk's texts: limits in one buffer per slice, key hashes, lengths, documents."""

    def __init__(self, texts: list[bytes], least: int):
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        doc, hashes, long, self.n_lines, self.keys = [], [], [], np.zeros(len(texts), np.int64), []
        for a, b in common.slices(lengths, SLICE_BYTES):
            buf = common.LOWER[np.frombuffer(b"\n".join(texts[a:b]) + b"\n", dtype=np.uint8)]
            ends = np.flatnonzero(buf == 10)
            starts = np.concatenate([[0], ends[:-1] + 1])
            d = np.searchsorted(np.cumsum(lengths[a:b] + 1), starts, side="right")
            self.n_lines[a:b] = np.bincount(d, minlength=b - a)
            solid = np.append(np.flatnonzero(~common.IS_SPACE[buf]), len(buf))
            first = np.minimum(solid[np.searchsorted(solid, starts)], ends)
            last = np.searchsorted(solid, ends) - 1
            stop = np.where(first < ends, solid[np.maximum(last, 0)] + 1, first)
            points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
            ok = points[stop] - points[first] >= least
            h = np.zeros(len(starts), np.uint64)
            h[ok] = common.span_hashes(buf, first[ok], stop[ok], common.SEEDS[0])
            doc.append(d + a)
            hashes.append(h)
            long.append(ok)
            self.keys.append((buf, first, stop))
        self.doc = np.concatenate(doc) if doc else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.long = np.concatenate(long) if long else np.zeros(0, bool)

    def key(self, line: int) -> bytes:
        for buf, first, stop in self.keys:
            if line < len(first):
                return buf[first[line] : stop[line]].tobytes()
            line -= len(first)
        raise IndexError(line)


def _per_key(c: _Lines, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted unique hashes of the long lines: of each a line, its documents with ids, 1 if one has none, the largest id."""
    at = np.flatnonzero(c.long)
    h, d = c.hashes[at], ids[c.doc[at]]
    order = np.lexsort((d, h))
    h, d, at = h[order], d[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    fresh = new.copy()
    fresh[1:] |= d[1:] != d[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return h, first, first, first, first
    last = np.append(first[1:], len(h)) - 1
    none = (d[first] == NO_ID).astype(np.int64)
    return h[first], at[first], np.add.reduceat(fresh.astype(np.int64), first) - none, none, d[last]


def _places(keys: np.ndarray) -> np.ndarray:
    a, b = common.mix(keys), common.mix(keys ^ np.uint64(common.SEEDS[1])) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) & np.uint64(BLOOM_BITS - 1) for i in range(BLOOM_HASHES)]).astype(np.int64)


def _twice_seen(t: pa.Table) -> list[np.ndarray]:
    """Which keys of each row the bucket's twice-seen filter holds (flag 1: two documents of one chunk)."""
    once, twice = np.zeros(BLOOM_BITS, bool), np.zeros(BLOOM_BITS, bool)
    rows = []
    for _, keys, flags, _ in packed.received(t):
        at = _places(keys)
        again = once[at].all(0) | (flags > 0)
        once[at.ravel()] = True
        twice[at[:, again].ravel()] = True
        rows.append(keys)
    return [twice[_places(keys)].all(0) for keys in rows]


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """Drop lines whose key is in `least_docs` documents or more, but for the largest id's.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased;
    only keys of `least_chars` code points or more count.  Documents are dealt into
    chunks; each chunk's key hashes go, packed, to hash ranges whose tasks hold a
    once-seen and a twice-seen Bloom filter of fixed size and answer with bitmaps.
    Only the twice-seen keys then shuffle as rows, already counted per chunk, for the
    exact count of documents and the largest id; the filters have no false negatives,
    so nothing is missed, and the keys themselves are compared, so nothing is added.

    Returns the input columns with text replaced by the kept lines, n_lines and
    n_dropped.  Null and empty texts are one empty line and stay as they are.  Rows with
    the same id are one document, and work on them meets in one task.  Null ids count as one document, which never
    keeps a repeated line; such rows are dealt out by their texts.  A text of any length is worked on whole, in one
    task.  Within a chunk lines are told apart by a 64-bit hash.  Input columns named like an output are replaced.
    """
    rows = docs.drop("n_lines", "n_dropped")
    by = [F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col))]
    dealt, chunk, bits = packed.deal(rows, by, text_col, CHUNK_BYTES, 0.02, BUCKET_KEYS)

    def ids_of(t: pa.Table) -> np.ndarray:
        return np.array([NO_ID if x is None else x for x in t[id_col].to_pylist()], dtype=np.int64)

    def collapse(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = packed.to_key(h)
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
        return keys[first], (np.add.reduceat(n, first) > 1).astype(np.uint8) if len(first) else n.astype(np.uint8)

    def scan(key, t):
        h, _, n, none, _ = _per_key(_Lines(common.to_bytes(t[text_col]), least_chars), ids_of(t))
        keys, flags = collapse(h, n + none)
        return pa.Table.from_batches([packed.send(1, key[0].as_py(), keys, bits, flags)], schema=packed.SENT_ARROW)

    def suspects(key, t, told):
        c = _Lines(common.to_bytes(t[text_col]), least_chars)
        h, at, n, none, most = _per_key(c, ids_of(t))
        keys, _ = collapse(h, n)
        good = np.flatnonzero(packed.member(keys[packed.said(told, 1, keys, bits)], packed.to_key(h)))
        lines = [c.key(int(i)) for i in at[good]]
        return pa.table({"chunk": np.full(len(good), key[0].as_py(), np.int64), "h": h[good].view(np.int64), "line": pa.array(lines, pa.binary()), "n": n[good], "none": none[good], "most": most[good]})

    def cut(key, t, hot):
        texts, ids = common.to_bytes(t[text_col]), ids_of(t)
        c = _Lines(texts, least_chars)
        h = hot["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, keeper = h[order], hot["most"].to_numpy()[order]
        gone = np.zeros(len(c.doc), bool)
        if len(h):
            at = np.minimum(np.searchsorted(h, c.hashes), len(h) - 1)
            gone = c.long & (h[at] == c.hashes) & (keeper[at] != ids[c.doc])
        lost = np.bincount(c.doc[gone], minlength=len(texts))
        ends = np.cumsum(c.n_lines)
        kept = t[text_col].to_pylist()
        for i in np.flatnonzero(lost).tolist():
            stay = ~gone[ends[i] - c.n_lines[i] : ends[i]]
            kept[i] = b"\n".join(x for x, keep in zip(texts[i].split(b"\n"), stay.tolist(), strict=True) if keep).decode()
        out = t.drop_columns([chunk])
        out = out.set_column(out.column_names.index(text_col), text_col, pa.array(kept, t[text_col].type))
        return out.append_column("n_lines", pa.array(c.n_lines)).append_column("n_dropped", pa.array(lost))

    by_chunk = dealt.groupBy(chunk)
    told = packed.answers(by_chunk.applyInArrow(scan, packed.SENT), _twice_seen)
    found = common.table(by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(suspects, "chunk long, h long, line binary, n long, none long, most long"))
    repeated = found.groupBy("line").agg((F.sum("n") + F.max("none")).alias("n"), F.max("most").alias("keeper")).where(F.col("n") >= least_docs)
    hot = found.select("chunk", "h", "line").join(repeated, "line").select("chunk", "h", F.col("keeper").alias("most"))
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL("n_lines long, n_dropped long").fields)
    return by_chunk.cogroup(hot.groupBy("chunk")).applyInArrow(cut, schema)


def digest(done: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines, n_dropped, SHA-256 of the kept text."""
    return done.select(id_col, "n_lines", "n_dropped", F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], least_chars: int = 40, least_docs: int = 5) -> dict[int, tuple[int, int, str]]:
    """The same by plain dictionaries, for tests (unique ids)."""
    space = b" \t\n\v\f\r"
    key = lambda line: line.strip(space).lower()
    lines = {i: (t or "").encode().split(b"\n") for i, t in rows}
    where: dict[bytes, set] = {}
    for i, xs in lines.items():
        for x in xs:
            where.setdefault(key(x), set()).add(i)
    gone = lambda i, x: len(key(x).decode()) >= least_chars and len(where[key(x)]) >= least_docs and i != max(where[key(x)])
    out = {}
    for i, xs in lines.items():
        kept = [x for x in xs if not gone(i, x)]
        out[i] = (len(xs), len(xs) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest())
    return out
