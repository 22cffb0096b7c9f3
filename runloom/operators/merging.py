"""C-2: key removal, chimera flag, adapter trimming and merging of overlapping mates.

No golden output exists; the rule is our own: the insert length at which read 1 and the
reverse complement of read 2 agree on most bases less twice the disagreements.  Where either
read has an N a position counts neither as agreement nor as disagreement, nor towards the least overlap; in
a merged read any base wins over an N, whatever the qualities.  In adapters an N of the read disagrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = ord("N")
MERGED = "name string, status string, seq string, qual string, seq2 string, qual2 string, insert_length int"


TURN = np.arange(256, dtype=np.uint8)
TURN[[*b"ACGTN"]] = [*b"TGCAN"]


def _codes(texts: list[str], n: int) -> np.ndarray:
    """Texts of n characters as rows; qualities that are too short count as the lowest."""
    return np.frombuffer("".join(x[:n].ljust(n, "!") for x in texts).encode("latin-1"), np.uint8).reshape(len(texts), n)


def insert_lengths(a: np.ndarray, b: np.ndarray, least: int, most_mismatch: float) -> np.ndarray:
    """The insert length of each pair (rows of read 1 and of read 2 reverse-complemented), 0 if none fits."""
    n1, n2 = a.shape[1], b.shape[1]
    best, found = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for length in range(least, n1 + n2 - least + 1):
        # Read 1 covers [0, n1) of the insert, read 2 ends at its end.
        start = length - n2
        low, high = max(0, start), min(n1, length)
        if high - low < least:
            continue
        x, y = a[:, low:high], b[:, low - start : high - start]
        known = (x != UNKNOWN) & (y != UNKNOWN)
        n = np.count_nonzero(known, axis=1)
        wrong = np.count_nonzero(known & (x != y), axis=1)
        score = n - 3 * wrong
        better = (n >= least) & (wrong <= most_mismatch * n) & (score > best)
        best[better], found[better] = score[better], length
    return found


def merged(a: np.ndarray, qa: np.ndarray, b: np.ndarray, qb: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bases, qualities) of pairs of one insert length; the better base wins where they overlap."""

    def place(x: np.ndarray, start: int) -> np.ndarray:
        out = np.zeros((len(x), length), np.uint8)
        low, high = max(0, start), min(length, start + x.shape[1])
        out[:, low:high] = x[:, low - start : high - start]
        return out

    one, two, q1, q2 = place(a, 0), place(b, length - b.shape[1]), place(qa, 0), place(qb, length - b.shape[1])
    # Where only one read reaches the other has base 0; a known base goes before N, then the better quality, then the larger letter.
    rank = lambda base, q: (base > 0) * np.int32(1 << 20) + ((base != UNKNOWN) & (base > 0)) * np.int32(1 << 19) + q.astype(np.int32) * 256 + base
    first = rank(one, q1) >= rank(two, q2)
    quals = np.where(first, q1, q2)
    return np.where(first, one, two), np.where(one == two, np.maximum(q1, q2), quals)


def merge_pairs(seq1: list[str], qual1: list[str], seq2: list[str], qual2: list[str], least: int, most_mismatch: float) -> list[tuple[str, str, int] | None]:
    """(sequence, qualities, insert length) of each pair that merges; pairs of equal lengths are compared as arrays."""
    out: list[tuple[str, str, int] | None] = [None] * len(seq1)
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, (x, y) in enumerate(zip(seq1, seq2, strict=True)):
        kinds.setdefault((len(x), len(y)), []).append(i)
    for (n1, n2), rows in kinds.items():
        of = lambda texts, n, rows=rows: _codes([texts[i] for i in rows], n)
        a, qa, b, qb = of(seq1, n1), of(qual1, n1), TURN[of(seq2, n2)[:, ::-1]], of(qual2, n2)[:, ::-1]
        found = insert_lengths(a, b, least, most_mismatch)
        for length in np.unique(found[found > 0]).tolist():
            at = np.flatnonzero(found == length)
            bases, quals = merged(a[at], qa[at], b[at], qb[at], length)
            seq, qual = bases.tobytes().decode("latin-1"), quals.tobytes().decode("latin-1")
            for k, i in enumerate(at.tolist()):
                out[rows[i]] = (seq[k * length : (k + 1) * length], qual[k * length : (k + 1) * length], length)
    return out


def adapter_start(seq: str, adapter: str, least: int = 5, most_mismatch: float = 0.2) -> int:
    """Where the adapter (I stands for any base) begins in a read, or the read's length."""
    for i in range(len(seq) - least + 1):
        part = adapter[: len(seq) - i]
        wrong = sum(x != y and y != "I" for x, y in zip(seq[i:], part, strict=False))
        if len(part) >= least and wrong <= most_mismatch * len(part):
            return i
    return len(seq)


def trim_and_merge(pairs: DataFrame, adapter: str, key1: str = "", key2: str = "", chimeras: list[str] | None = None, least: int = 11, most_mismatch: float = 0.1) -> DataFrame:
    """One row per pair (name, seq1, qual1, seq2, qual2; no seq2: single reads) with its status.

    status: no_key (a read lacks its key), chimera (it starts with a known chimera), merged, trimmed (adapter cut
    off a single read), empty (nothing but adapter), unmerged.  Pairs are independent: nothing is shuffled.
    """
    known = tuple(chimeras or [])

    def one(name, seq1, qual1, seq2, qual2):
        """The row, or the trimmed pair that is to be compared."""
        if not seq1.startswith(key1) or (seq2 is not None and not seq2.startswith(key2)):
            return name, "no_key", seq1, qual1, seq2, qual2, None
        seq1, qual1 = seq1[len(key1) :], qual1[len(key1) :]
        if known and seq1.startswith(known):
            return name, "chimera", seq1, qual1, seq2, qual2, None
        if seq2 is None:
            at = adapter_start(seq1, adapter)
            return name, "empty" if not at else "trimmed" if at < len(seq1) else "unmerged", seq1[:at], qual1[:at], None, None, at if at < len(seq1) else None
        return name, "pair", seq1, qual1, seq2[len(key2) :], (qual2 or "")[len(key2) :], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            at = [i for i, r in enumerate(rows) if r[1] == "pair"]
            made = merge_pairs(*([rows[i][k] for i in at] for k in (2, 3, 4, 5)), least, most_mismatch)
            for i, m in zip(at, made, strict=True):
                name, _, *pair, _ = rows[i]
                rows[i] = (name, "merged", m[0], m[1], None, None, m[2]) if m else (name, "unmerged", *pair, None)
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 6 else pa.string()) for k, c in enumerate(columns)], names=[x.split()[0] for x in MERGED.split(", ")])

    return pairs.where("seq1 IS NOT NULL AND qual1 IS NOT NULL").select("name", "seq1", "qual1", "seq2", "qual2").mapInArrow(run, MERGED)


def merge_log(merged: DataFrame) -> DataFrame:
    """Pairs by status."""
    return merged.groupBy("status").agg(F.count("*").alias("n"), F.avg("insert_length").alias("mean_length"))
