"""Byte-level BPE of whole batches: split into pre-tokens by arrays, encode each distinct one once.

The split follows the byte-level pattern of the tokenizers library (contractions, an
optional space before letters, digits or other characters, white space); the ids of
a pre-token come from the library's own model and are kept in a bounded table of the worker.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np

from . import common

LETTER, DIGIT, OTHER, SPACE = range(4)
#: White_Space of Unicode.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Slots of the table, a power of two, and entries after which it is emptied.
SLOTS = 1 << 21
MOST_ENTRIES = 900_000

_classes: np.ndarray | None = None
_encoders: dict[str, Encoder] = {}


def classes() -> np.ndarray:
    """The class of every code point, as the library sees it.

    Python's own Unicode table can be older or newer than the library's.  Its classes are the guess: a run of code points of one class has to
    be one pre-token with a known character of that class; where it is not, each of its code points is asked for.
    """
    global _classes
    if _classes is None:
        from tokenizers.pre_tokenizers import ByteLevel

        split = ByteLevel(add_prefix_space=False, use_regex=True)
        kind = {"L": LETTER, "N": DIGIT}
        table = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
        table[WHITE] = SPACE
        known = {LETTER: "a", DIGIT: "1", OTHER: "!"}
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(table)) + 1, np.arange(0, 0x110000, 512), [0xD800, 0xE000, 0x110000]])).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            if table[a] == SPACE or 0xD800 <= a < 0xE000:
                continue
            if len(split.pre_tokenize_str(known[table[a]] + "".join(map(chr, range(a, b))))) > 1:
                for c in range(a, b):
                    table[c] = next((k for k, x in known.items() if len(split.pre_tokenize_str(x + chr(c))) == 1), SPACE)
        _classes = table
    return _classes


def byte_classes(buf: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 belongs to."""
    table = classes()
    out = table[:256][buf]
    for low, high, n, bits in ((0xC0, 0xDF, 2, 0x1F), (0xE0, 0xEF, 3, 0x0F), (0xF0, 0xFF, 4, 0x07)):
        at = np.flatnonzero((buf >= low) & (buf <= high))
        if not len(at):
            continue
        code = (buf[at] & bits).astype(np.int64)
        for k in range(1, n):
            code = (code << 6) | (buf[at + k] & 0x3F)
        kind = table[code]
        for k in range(n):
            out[at + k] = kind
    return out


def starts_of(buf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start; first marks the bytes at which a text, or a stretch around special strings, starts."""
    n = len(buf)
    kind = byte_classes(buf)
    edge = first.copy()
    edge[1:] |= kind[1:] != kind[:-1]
    start = edge.copy()
    # A run that follows white space inside a stretch: the last white character goes its own way or, a space, joins it.
    at = np.flatnonzero(edge & ~first & (kind != SPACE))
    at = at[kind[at - 1] == SPACE]
    blank = buf[at - 1] == 0x20
    start[at[blank]] = False
    last = at - 1
    for _ in range(3):  # to the lead byte of a longer character
        last = last - ((buf[last] & 0xC0) == 0x80)
    start[last] = True
    # Contractions: an apostrophe that stands alone before letters and is not joined by a space.
    at = np.flatnonzero((buf == 0x27) & start)
    at = at[at + 1 < n]
    at = at[~first[at + 1]]
    if len(at):
        one = np.isin(buf[at + 1], np.frombuffer(b"stmd", np.uint8))
        two = np.minimum(at + 2, n - 1)
        pair = (buf[at + 1].astype(np.int32) << 8) | buf[two]
        both = np.isin(pair, [0x7265, 0x7665, 0x6C6C]) & (at + 2 < n) & ~first[two]
        start[at[one | both] + 1] = False
        for ok, length in ((one, 2), (both & ~one, 3)):
            after = at[ok] + length
            start[after[after < n]] = True
    return start


class PieceTable:
    """Ids of the distinct stretches of texts, in a bounded table from a 64-bit hash to ids.

    A tokenizer gives starts() and ids_of(); equal stretches always have equal ids.
    """

    find: re.Pattern | None = None
    special: dict[bytes, int] = {}

    def __init__(self) -> None:
        self.clear()

    def starts(self, buf: np.ndarray, first: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def ids_of(self, token: bytes) -> list[int]:
        raise NotImplementedError

    def clear(self) -> None:
        self.hash = np.zeros(SLOTS, np.uint64)
        self.slot = np.full(SLOTS, -1, np.int32)
        self.at = np.zeros(MOST_ENTRIES, np.int64)
        self.n = np.zeros(MOST_ENTRIES, np.int32)
        self.ids = np.zeros(4 * MOST_ENTRIES, np.int32)
        self.used = self.entries = 0

    def _look(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        a = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        found = np.where(self.hash[a] == h, self.slot[a], np.int32(-1))
        miss = np.flatnonzero(found < 0)
        if len(miss):
            b = ((h[miss] >> np.uint64(32)) & np.uint64(SLOTS - 1)).astype(np.int64)
            found[miss] = np.where(self.hash[b] == h[miss], self.slot[b], np.int32(-1))
        return found

    def _add(self, h: int, ids: list[int]) -> int:
        k = self.entries
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
        self.at[k], self.n[k] = self.used, len(ids)
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.entries += 1
        for place in (h & (SLOTS - 1), (h >> 32) & (SLOTS - 1)):
            if self.slot[place] < 0:
                self.hash[place], self.slot[place] = h, k
                break
        return k

    def sizes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(start byte of every pre-token in the joined texts, its tokens)."""
        starts, _, ranges = self.ranges(texts)
        return starts, np.concatenate([np.zeros(0, np.int32), *[self.n[entry] for entry in ranges]]).astype(np.int64)

    def split(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """(start byte of every pre-token in the joined texts, its hash, pre-tokens of each text, the joined texts)."""
        joined = b"".join(texts)
        buf = np.frombuffer(joined, np.uint8)
        limits = np.cumsum([0, *map(len, texts)])
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), joined
        first = np.zeros(len(buf), bool)
        first[limits[limits < len(buf)]] = True
        if self.find is not None and any(x in joined for x in self.special):
            for i, text in enumerate(texts):
                for m in self.find.finditer(text):
                    first[limits[i] + m.start()] = True
                    if limits[i] + m.end() < len(buf):
                        first[limits[i] + m.end()] = True
        special = np.flatnonzero(first)
        start = self.starts(buf, first)
        if self.find is not None and len(special) > len(texts):
            for i, text in enumerate(texts):
                for m in self.find.finditer(text):  # a special string is one token
                    start[limits[i] + m.start() + 1 : limits[i] + m.end()] = False
        starts = np.flatnonzero(start)
        h = common.span_hashes(buf, starts, np.append(starts[1:], len(buf)), common.SEEDS[0])
        return starts, h, np.diff(np.searchsorted(starts, limits)), joined

    def entries_of(self, joined: bytes, starts: np.ndarray, h: np.ndarray, end: int | None = None) -> np.ndarray:
        """The entry of each pre-token; those not in the table are encoded, after it is emptied if it has no room for them."""
        entry = self._look(h)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            new, where, back = np.unique(h[miss], return_index=True, return_inverse=True)
            if self.entries + len(new) > MOST_ENTRIES:
                self.clear()
                return self.entries_of(joined, starts, h, end)
            at = miss[where]
            ends = np.append(starts[1:], len(joined) if end is None else end)
            ids = [self.ids_of(joined[a:b]) for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            made = np.array([self._add(x, y) for x, y in zip(new.tolist(), ids, strict=True)], np.int32)
            entry[miss] = made[back]
        return entry

    def ranges(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Iterator[np.ndarray]]:
        """(start byte of every pre-token in the joined texts, pre-tokens of each text, entries of consecutive ranges of all pre-tokens).

        A range's entries hold until the next is drawn.  A range has at most MOST_ENTRIES pre-tokens, so that the table is only a cache whatever the texts are.
        """
        starts, h, per_text, joined = self.split(texts)

        def run() -> Iterator[np.ndarray]:
            for a in range(0, len(starts), MOST_ENTRIES):
                b = min(a + MOST_ENTRIES, len(starts))
                yield self.entries_of(joined, starts[a:b], h[a:b], int(starts[b]) if b < len(starts) else len(joined))

        return starts, per_text, run()

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text."""
        _, per_text, ranges = self.ranges(texts)
        n = np.concatenate([np.zeros(0, np.int32), *[self.n[entry] for entry in ranges]])
        return self._per_text(n, per_text)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, tokens of each)."""
        _, per_text, ranges = self.ranges(texts)
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for entry in ranges:
            n = self.n[entry].astype(np.int64)
            total = np.concatenate([[0], np.cumsum(n)])
            ids.append(self.ids[np.repeat(self.at[entry] - total[:-1], n) + np.arange(total[-1])])
            counts.append(self.n[entry])
        return np.concatenate(ids), self._per_text(np.concatenate(counts), per_text)

    @staticmethod
    def _per_text(n: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        ends = np.cumsum(per_text)
        return total[ends] - total[ends - per_text]


class Encoder(PieceTable):
    """Pre-tokens of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        if any(x.lstrip or x.rstrip or x.single_word for x in added.values()):
            raise ValueError("special tokens with options are not supported")
        self.special = {x.content.encode(): i for i, x in added.items()}
        self.find = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if added else None
        # The model's alphabet: printable bytes stand for themselves, the others for code points from 256.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def starts(self, buf: np.ndarray, first: np.ndarray) -> np.ndarray:
        return starts_of(buf, first)

    def ids_of(self, token: bytes) -> list[int]:
        if token in self.special:
            return [self.special[token]]
        return [x.id for x in self.library.model.tokenize(token.decode("latin-1").translate(self.alphabet))]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
