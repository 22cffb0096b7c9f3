"""Operator 1: exact repeats of at least `window` words, by fixed-block anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, packed

#: Text of a chunk that is hashed at a time, and of a chunk.
SLICE_BYTES = 1 << 19
CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 2_000_000
REST_BITS = np.uint64(16)


class _Chunk:
    """Words of a chunk's texts: their hashes (a row of them per seed) and document limits."""

    def __init__(self, texts: list[bytes], seeds: int):
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        hashes: list[list[np.ndarray]] = [[] for _ in range(seeds)]
        counts = []
        for a, b in common.slices(lengths, SLICE_BYTES):
            buf = np.frombuffer(b"\n".join(texts[a:b]), dtype=np.uint8)
            starts, ends = common.word_spans(buf)
            limits = np.cumsum(lengths[a:b] + 1)
            counts.append(np.diff(np.searchsorted(starts, limits), prepend=0))
            for k in range(seeds):
                hashes[k].append(common.span_hashes(buf, starts, ends, common.SEEDS[k]))
        self.hashes = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in hashes]
        self.n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.ends = np.cumsum(self.n_words)
        self.starts = self.ends - self.n_words

    def inside(self, n: int) -> np.ndarray:
        """Positions at which n words of one document start."""
        size = max(0, int(self.n_words.sum()) - n + 1)
        edge = np.zeros(size + 1, dtype=np.int64)
        long = self.n_words >= n
        np.add.at(edge, self.starts[long], 1)
        np.add.at(edge, self.ends[long] - n + 1, -1)
        return np.cumsum(edge)[:size].astype(bool)

    def offsets(self) -> np.ndarray:
        return np.arange(int(self.n_words.sum())) - np.repeat(self.starts, self.n_words)


def _probes(c: _Chunk, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rolling windows: (key of each position, whether it exists; sorted unique keys, their flags).

    Flag 1: the key occurs more than once in this chunk.  Flag 2: it is a reference block.
    """
    ok = c.inside(block)
    keys = packed.to_key(common.window_hashes(c.hashes[0], block, common.WINDOW_SEEDS[0]))
    unique, counts = np.unique(keys[ok], return_counts=True)
    flags = (counts > 1).astype(np.uint8)
    blocks = np.unique(keys[ok & (c.offsets()[: len(keys)] % block == 0)])
    flags[np.searchsorted(unique, blocks)] |= 2
    return keys, ok, unique, flags


def _anchored(c: _Chunk, keys: np.ndarray, ok: np.ndarray, hits: np.ndarray, block: int, window: int) -> np.ndarray:
    """Positions of the windows that hold an anchor hit."""
    hit = ok & packed.member(hits, keys)
    count = np.concatenate([[0], np.cumsum(hit)])
    inside = c.inside(window)
    span = window - block + 1
    at = np.flatnonzero(inside)
    return at[count[at + span] > count[at]]


def _candidates(c: _Chunk, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, keys, rest) of the candidate windows, sorted by both."""
    if not len(at):
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none
    keys = packed.to_key(common.window_hashes(c.hashes[0], window, common.WINDOW_SEEDS[0])[at])
    rest = common.window_hashes(c.hashes[1], window, common.WINDOW_SEEDS[1])[at] >> REST_BITS
    order = np.lexsort((rest, keys))
    return order, keys[order], rest[order]


def _runs(*sorted_arrays: np.ndarray) -> np.ndarray:
    """Number of the run of equal tuples that each row of sorted arrays belongs to."""
    new = np.zeros(len(sorted_arrays[0]), dtype=np.int64)
    for x in sorted_arrays:
        new[1:] |= x[1:] != x[:-1]
    return np.cumsum(new)


def _judge_blocks(t: pa.Table) -> list[np.ndarray]:
    """A key is a hit if some block has it and it occurs twice or more."""
    rows = list(packed.received(t))
    keys = np.concatenate([x[1] for x in rows])
    flags = np.concatenate([x[2] for x in rows])
    order = np.argsort(keys, kind="stable")
    run = _runs(keys[order])
    n = np.bincount(run, weights=1 + (flags[order] & 1))
    good = (n > 1) & (np.bincount(run, weights=flags[order] >> 1) > 0)
    out = np.empty(len(keys), dtype=bool)
    out[order] = good[run]
    return np.split(out, np.cumsum([len(x[1]) for x in rows])[:-1])


def _judge_windows(t: pa.Table) -> list[np.ndarray]:
    """A window repeats if both of its hashes occur twice or more."""
    rows = list(packed.received(t))
    keys, rest = np.concatenate([x[1] for x in rows]), np.concatenate([x[3] for x in rows])
    flags = np.concatenate([x[2] for x in rows])
    order = np.lexsort((rest, keys))
    run = _runs(keys[order], rest[order])
    good = np.bincount(run, weights=1 + (flags[order] & 1)) > 1
    out = np.empty(len(keys), dtype=bool)
    out[order] = good[run]
    return np.split(out, np.cumsum([len(x[1]) for x in rows])[:-1])


def _covered(c: _Chunk, at: np.ndarray, window: int) -> np.ndarray:
    """Words under a window that starts at one of `at`."""
    edge = np.zeros(int(c.n_words.sum()) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge)[:-1] > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Remove every word covered by a window of `window` words that also starts elsewhere.

    Words are runs of characters other than ASCII white space.  Blocks of
    (window + 1) // 2 words at multiples of that length are the index; every rolling
    window of that length probes it, so a repeat of `window` words always holds a whole
    block of its other copy.  A hit is extended to the windows that hold it; those
    whose full word sequences occur again are the repeats, and runs of them the
    maximal exact repeats.  Sequences are told apart by 96 bits, 48 of each of two 64-bit hashes that share
    neither words' nor windows' values.  All passes read the same dealt-out documents, exchanging
    only packed hashes and bitmaps (see packed.py).

    Returns the input columns with text replaced by the kept words (joined by one
    space), and n_words, n_removed, spans (start word and length of each removed
    stretch).  Where nothing is removed the text stays as it is; null text stays null with 0 words;
    repeated rows are each other's copies and both lose their windows.  Rows with null or repeated ids are
    documents like any other.  A text of any length is worked on whole, in one task.  Input columns
    named like an output are replaced.
    """
    block = (window + 1) // 2
    made = ["n_words", "n_removed", "spans"]
    rows = docs.drop(*made)
    dealt, chunk, bits = packed.deal(rows, [F.col(id_col), F.col(text_col)], text_col, CHUNK_BYTES, 0.2, BUCKET_KEYS)

    def probe(key, t):
        c = _Chunk(common.to_bytes(t[text_col]), 1)
        _, _, unique, flags = _probes(c, block)
        return pa.Table.from_batches([packed.send(1, key[0].as_py(), unique, bits, flags)])

    def extend(key, t, told):
        c = _Chunk(common.to_bytes(t[text_col]), 2)
        keys, ok, unique, _ = _probes(c, block)
        at = _anchored(c, keys, ok, unique[packed.said(told, 1, unique, bits)], block, window)
        _, keys, rest = _candidates(c, at, window)
        if not len(keys):
            return packed.SENT_ARROW.empty_table()
        run = _runs(keys, rest)
        first = np.flatnonzero(np.diff(run, prepend=-1))
        flags = (np.bincount(run) > 1).astype(np.uint8)
        return pa.Table.from_batches([packed.send(2, key[0].as_py(), keys[first], bits, flags, rest[first])])

    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL("n_words long, n_removed long, spans array<struct<start:long,length:long>>").fields)

    def cut(key, t, told):
        texts = common.to_bytes(t[text_col])
        c = _Chunk(texts, 2)
        keys, ok, unique, _ = _probes(c, block)
        at = _anchored(c, keys, ok, unique[packed.said(told, 1, unique, bits)], block, window)
        order, keys, rest = _candidates(c, at, window)
        run = _runs(keys, rest) if len(keys) else np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(run, prepend=-1)) if len(keys) else run
        again = packed.said(told, 2, keys[first], bits)
        gone = _covered(c, at[order[again[run]]] if len(keys) else at, window)
        total = np.concatenate([[0], np.cumsum(gone)])
        lost = total[c.ends] - total[c.starts]
        kept, spans = [], []
        raw = t[text_col].to_pylist()
        for i, text in enumerate(texts):
            if not lost[i]:
                kept.append(raw[i])
                spans.append([])
                continue
            mine = gone[c.starts[i] : c.ends[i]]
            words = np.array(text.split(), dtype=object)
            kept.append(b" ".join(words[~mine].tolist()).decode())
            step = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
            spans.append([{"start": a, "length": b - a} for a, b in step.reshape(-1, 2).tolist()])
        out = t.drop_columns([chunk])
        out = out.set_column(out.column_names.index(text_col), text_col, pa.array(kept, t[text_col].type))
        return out.append_column("n_words", pa.array(c.n_words)).append_column("n_removed", pa.array(lost)).append_column("spans", pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))))

    by_chunk = lambda df: df.groupBy(chunk)
    told_1 = packed.answers(by_chunk(dealt).applyInArrow(probe, packed.SENT), _judge_blocks)
    sent_2 = by_chunk(dealt).cogroup(told_1.groupBy("chunk")).applyInArrow(extend, packed.SENT)
    told_2 = packed.answers(sent_2, _judge_windows)
    both = told_1.unionByName(told_2)
    return by_chunk(dealt).cogroup(both.groupBy("chunk")).applyInArrow(cut, schema)


def digest(done: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_removed, SHA-256 of the kept words joined by one space."""
    words = F.filter(F.split(F.coalesce(text_col, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return done.select(id_col, "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], window: int = 35) -> dict[int, tuple[int, int, str]]:
    """The same by a dictionary of all windows, for tests."""
    words = {i: (t or "").encode().split() for i, t in rows}
    seen: dict[tuple, int] = {}
    for w in words.values():
        for p in range(len(w) - window + 1):
            seen[tuple(w[p : p + window])] = seen.get(tuple(w[p : p + window]), 0) + 1
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone.update(range(p, p + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out
