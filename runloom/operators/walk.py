"""P13-P16 over whole Arrow batches: CIGAR and MD tokenised and walked at once for all reads of a batch."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
#: CIGAR letters that take read bases, and those that have columns in MD; = and X are M.
_MATCH = np.zeros(256, bool)
_MATCH[[*b"M=X"]] = True
_READ = _MATCH.copy()
_READ[[*b"IS"]] = True
_OP = np.arange(256, dtype=np.uint8)
_OP[[*b"=X"]] = ord("M")
COMPLEMENT = np.arange(256, dtype=np.uint8)
COMPLEMENT[[*b"ACGT"]] = [*b"TGCA"]
SAME = ord("=")


class Bases(NamedTuple):
    """One entry for each base of the reads that fit: the read's row, its place in the read, operation, base, quality, reference base (0: none) and position."""

    row: np.ndarray
    i: np.ndarray
    op: np.ndarray
    base: np.ndarray
    q: np.ndarray
    ref: np.ndarray
    ref_pos: np.ndarray
    length: np.ndarray


def text(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows, which rows are not null) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.ones(len(column), bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0], valid


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The decimal number in each span of digits; 0 for an empty one."""
    out, size = np.zeros(len(starts), np.int64), ends - starts
    for k in range(min(int(size.max(initial=0)), 18)):
        at = np.flatnonzero(size > k)
        out[at] += (data[ends[at] - 1 - k].astype(np.int64) - 48) * 10**k
    return out


def _before(n: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Running sums of n before each entry, within its row; first: each row's first entry."""
    total = np.concatenate([[0], np.cumsum(n)])
    return total[:-1] - total[first[rows]]


def _within(n: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, one after another."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def walk(batch: pa.RecordBatch) -> tuple[Bases, np.ndarray]:
    """(bases of the reads that fit, which rows fit) of columns seq, qual, pos, cigar, md.

    A read fits if its CIGAR covers its bases, MD the M bases, qualities and bases are equally many and
    no deletion of MD lies inside a stretch of M.  Missing CIGAR or MD do not fit.
    """
    n_rows = batch.num_rows
    seq, seq_at, seq_ok = text(batch.column("seq"))
    qual, qual_at, _ = text(batch.column("qual"))
    length = np.diff(seq_at)
    pos = np.nan_to_num(batch.column("pos").to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    has_pos = batch.column("pos").is_valid().to_numpy(zero_copy_only=False)

    cigar, cigar_at, cigar_ok = text(batch.column("cigar"))
    letter = np.flatnonzero(~_DIGIT[cigar])
    row = np.searchsorted(cigar_at, letter, side="right") - 1
    begin = np.maximum(np.concatenate([[0], letter[:-1] + 1])[: len(letter)], cigar_at[row])
    n, op = _numbers(cigar, begin, letter), cigar[letter]
    first = np.searchsorted(row, np.arange(n_rows))
    read_n, match_n = np.where(_READ[op], n, 0), np.where(_MATCH[op], n, 0)
    read_before, match_before = _before(read_n, first, row), _before(match_n, first, row)

    md, md_at, md_ok = text(batch.column("md"))
    digit, is_letter = _DIGIT[md], _LETTER[md]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], digit, [False]]).astype(np.int8)))
    # Runs of digits end where a row ends.
    cut = md_at[1:-1]
    inside = cut[(cut > 0) & (cut < len(md))]
    inside = np.unique(inside[digit[inside - 1] & digit[inside]]) if len(inside) else inside
    edge = np.sort(np.concatenate([edge, inside, inside]))
    number_start, number_end = edge[0::2], edge[1::2]
    mark = np.maximum.accumulate(np.where(is_letter, -1, np.arange(len(md)))) if len(md) else np.zeros(0, np.int64)
    letters = np.flatnonzero(is_letter)
    md_row = np.searchsorted(md_at, letters, side="right") - 1
    gone = (mark[letters] >= md_at[md_row]) & (md[mark[letters]] == ord("^")) if len(letters) else np.zeros(0, bool)
    # What MD says, in order: numbers as wide as they say, letters one column wide, deleted letters none.
    place = np.concatenate([number_start, letters])
    width = np.concatenate([_numbers(md, number_start, number_end), np.where(gone, 0, 1)])
    kind = np.concatenate([np.zeros(len(number_start), np.int8), np.where(gone, 2, 1).astype(np.int8)])
    order = np.argsort(place, kind="stable")
    place, width, kind = place[order], width[order], kind[order]
    of = np.searchsorted(md_at, place, side="right") - 1
    column = _before(width, np.searchsorted(of, np.arange(n_rows)), of)
    columns = np.bincount(of, width, n_rows).astype(np.int64)

    fits = seq_ok & cigar_ok & md_ok & has_pos & (np.bincount(row, read_n, n_rows) == length) & (np.bincount(row, match_n, n_rows) == columns) & (length == np.diff(qual_at))
    # Columns of the batch, one row after another; a deletion has to lie where a stretch of M begins or ends.
    column_at = np.concatenate([[0], np.cumsum(columns)])
    deleted = np.flatnonzero(kind == 2)
    start_of = np.concatenate([column_at[row] + match_before, column_at])
    at_edge = np.isin(column_at[of[deleted]] + column[deleted], start_of)
    fits &= np.bincount(of[deleted], ~at_edge, n_rows) == 0

    used = fits[row] & _READ[op] & (n > 0)
    row, n, op, read_before, match_before = row[used], n[used], op[used], read_before[used], match_before[used]
    # Deleted bases of the row before or at the stretch's first column.
    deleted_key = column_at[of[deleted]] + column[deleted]
    deleted_first = np.searchsorted(of[deleted], np.arange(n_rows))
    shift = np.zeros(len(row), np.int64)
    with_gone = np.flatnonzero(np.bincount(of[deleted], minlength=n_rows)[row] > 0)
    if len(with_gone):
        # Within a row the deleted columns rise, so the ones up to a column are counted by a search from the row's first.
        base = deleted_first[row[with_gone]]
        upto = np.searchsorted(deleted_key, column_at[row[with_gone]] + match_before[with_gone], side="right")
        last = np.searchsorted(of[deleted], row[with_gone], side="right")
        shift[with_gone] = np.clip(upto, base, last) - base
    start = pos[row] + match_before + shift

    j = _within(n)
    rows = np.repeat(row, n)
    i = np.repeat(read_before, n) + j
    ops = np.repeat(_OP[op], n)
    match = ops == ord("M")
    bases, quality = seq[seq_at[rows] + i], qual[qual_at[rows] + i].astype(np.int32) - 33
    said = np.full(int(column_at[-1]), SAME, np.uint8)
    changed = kind == 1
    said[column_at[of[changed]] + column[changed]] = md[place[changed]]
    ref = np.zeros(len(rows), np.uint8)
    ref[match] = said[column_at[rows[match]] + (np.repeat(match_before, n) + j)[match]]
    ref = np.where(ref == SAME, bases, ref)
    return Bases(rows, i, ops, bases, quality, ref, np.repeat(start, n) + np.where(match, j, 0), length[rows]), fits


def characters(codes: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Strings of one character."""
    mask = None if valid is None else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(np.arange(len(codes) + 1, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(codes)), mask, -1 if valid is not None else 0)
