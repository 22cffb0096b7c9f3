"""Operator 12: short licence notices, found with a bounded number of edits."""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common


class Notice(NamedTuple):
    label: str
    phrase: str
    edits: int


# Notices whose exact wording the contract names.
BASE = (
    Notice("mit", "under the mit license", 0),
    Notice("apache-2", "apache license version 2", 0),
    Notice("cc-by-nc", "cc by nc", 0),
)
#: Notices that may differ by some edits; a label stands for a family, so no edit of a version number tells two of them apart.
FUZZY = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 4),
    Notice("apache", "licensed under the apache license", 3),
    Notice("gpl", "gnu general public license", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("mpl", "mozilla public license", 2),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 4),
    Notice("isc", "permission to use copy modify and distribute this software for any purpose", 4),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 4),
    Notice("cc-by", "licensed under a creative commons attribution", 3),
    Notice("cc-by-nc", "creative commons attribution noncommercial", 3),
)

#: Everything in ASCII but digits and letters becomes a space, A-Z becomes a-z.
PLAIN = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: A place of a notice.
HIT = "struct<label: string, phrase: string, edits: int, first_word: long, end_word: long, begin: long, end: long>"


def plain(text: bytes) -> str:
    """The words joined by one space, a character for each byte."""
    return b" ".join(text.translate(PLAIN).split()).decode("latin-1")


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """(offset, piece): edits + 1 pieces of the phrase, of which that many edits leave at least one whole."""
    n, size = notice.edits + 1, len(notice.phrase)
    cuts = [size * i // n for i in range(n + 1)]
    return [(a, notice.phrase[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, notices: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.notices = notices
        places: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            if not notice.phrase or plain(notice.phrase.encode()) != notice.phrase or not notice.phrase.isascii() or not 0 <= notice.edits < len(notice.phrase) // 4:
                raise ValueError(f"a notice needs lower-case words and edits for fewer than a quarter of it: {notice}")
            for at, piece in seeds(notice):
                places.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()
        self.patterns = [[regex.compile(f" (?:{n.phrase}){{e<={e}}} ") for e in range(n.edits + 1)] for n in notices]

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, edits, start, end) of all hits in a plain text, in order."""
        starts: dict[int, set[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for i, at in where:
                starts.setdefault(i, set()).add(last - size + 1 - at)
        out = []
        for i, found in starts.items():
            phrase, most = self.notices[i].phrase, self.notices[i].edits
            if not most:
                ends = ((s, s + len(phrase)) for s in found)
                out += [(i, 0, a, b) for a, b in ends if (a == 0 or text[a - 1] == " ") and (b == len(text) or text[b] == " ")]
                continue
            # Seeds of one place give starts that differ by twice the edits at most.
            groups: list[list[int]] = []
            for s in sorted(found):
                if groups and s - groups[-1][1] <= 2 * most:
                    groups[-1][1] = s
                else:
                    groups.append([s, s])
            for a, b in groups:
                lo, hi = max(0, a - most), min(len(text), b + len(phrase) + most)
                # A match needs a space on either side, so none begins or ends in a word that the window cuts.
                left = " " if lo == 0 or text[lo - 1] == " " else ""
                window = left + text[lo:hi] + (" " if hi == len(text) or text[hi] == " " else "")
                for e, pattern in enumerate(self.patterns[i]):
                    m = pattern.search(window)
                    if m:
                        out.append((i, e, lo - len(left) + m.start() + 1, lo - len(left) + m.end() - 1))
                        break
        return sorted(out, key=lambda x: (x[2], x[3], x[0]))


@cache
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def scan(docs: DataFrame, notices: tuple[Notice, ...] = BASE + FUZZY, text_col: str = "text") -> DataFrame:
    """Where the notices stand in the texts, with at most their number of edits.

    A text's words are its runs of digits, letters and non-ASCII characters, A-Z lower-cased; a notice is found where
    consecutive words, joined by one space, can be made from its phrase by that many insertions, deletions and substitutions of bytes.
    Each phrase is split into edits + 1 pieces; one of them is left whole by so many edits, so the pieces, searched all at once, give every candidate;
    the window around it is then verified by bounded-error matching, with the least bound that matches.  Of places of one notice that overlap the
    first with the fewest edits is reported; places without edits are all reported.

    Adds n_words and hits: array of HIT (label, phrase, edits; first word and the word after the last, from 0;
    begin and end in the text's UTF-8 bytes).  Null and empty texts have no words and no hits.  Repeated rows are scanned alike.
    Input columns named n_words or hits are replaced.  A text of any length is worked on whole, in one task; nothing shuffles.
    """
    rows = docs.drop("n_words", "hits")
    notices = tuple(notices)
    hit = pa.struct([("label", pa.string()), ("phrase", pa.string()), ("edits", pa.int32()), *((c, pa.int64()) for c in ("first_word", "end_word", "begin", "end"))])

    def run(batches):
        find = scanner(notices)
        for part in common.parts(batches, text_col):
            n_words, hits = [], []
            for text in common.to_bytes(part.column(text_col)):
                words = plain(text)
                n_words.append(words.count(" ") + 1 if words else 0)
                found = find(words)
                spans = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(PLAIN))] if found else []
                row = []
                for i, edits, a, b in found:
                    first = words.count(" ", 0, a)
                    end = first + words.count(" ", a, b) + 1
                    row.append((notices[i].label, notices[i].phrase, edits, first, end, spans[first][0], spans[end - 1][1]))
                hits.append([dict(zip(hit.names, x, strict=True)) for x in row])
            arrays = [*part.columns, pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(hit))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "n_words", "hits"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *T.StructType.fromDDL(f"n_words long, hits array<{HIT}>").fields]))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: words, places of the base notices, their labels, all labels, and 1 less the least share of edits (0: no hit)."""
    base = F.filter("hits", lambda h: h["phrase"].isin(*(n.phrase for n in BASE)))
    labels = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    starts = F.transform(base, lambda h: h["first_word"])
    good = F.transform("hits", lambda h: (F.length(h["phrase"]) - h["edits"]) / F.length(h["phrase"]))
    return scanned.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(good), F.lit(0.0)).alias("score"),
    )


def distance(a: bytes, b: bytes) -> int:
    """Levenshtein distance, for tests."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(text: str | None, notices: tuple[Notice, ...] = BASE + FUZZY) -> dict[Notice, int]:
    """The fewest edits with which each notice is found, over all runs of words, for tests."""
    words = plain((text or "").encode()).split(" ")
    out: dict[Notice, int] = {}
    for n in notices:
        size = n.phrase.count(" ") + 1
        for k in range(max(1, size - n.edits), size + n.edits + 1):
            for i in range(len(words) - k + 1):
                run = " ".join(words[i : i + k]).encode("latin-1")
                if run and abs(len(run) - len(n.phrase)) <= n.edits:
                    e = distance(run, n.phrase.encode())
                    if e <= n.edits:
                        out[n] = min(out.get(n, e), e)
    return out
