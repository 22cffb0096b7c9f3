"""Operator 8: SentencePiece segmentation by best path, giant texts by a max-plus parallel scan."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, common

SLICE_BYTES = 1 << 20
#: Characters of a chunk of a giant text, and chunks whose matrices are combined in one task.
CHUNK_CHARS = 16 << 10
GROUP_CHUNKS = 256
#: Off the lowest score for a character that no piece covers, as in the library.
UNKNOWN_PENALTY = 10.0
MARK = "▁"
LOWEST = -np.inf

_models: dict[str, Model] = {}


class Model(bpe.PieceTable):
    """Pieces and scores of a SentencePiece file; texts have a space in front and MARK for each space."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
        plain = [i for i in range(len(self.pieces)) if not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i) or library.is_byte(i))]
        self.scores = np.array([library.get_score(i) for i in range(len(self.pieces))], dtype=np.float64)
        self.of = {self.pieces[i]: (i, float(self.scores[i])) for i in plain}
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if library.is_byte(i)}
        self.longest = max(map(len, self.of))
        #: Characters to deeper levels; "" to the (id, score) of a piece that ends there.
        self.trie: dict = {}
        for p, hit in self.of.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = hit
        low = min(self.bytes.values(), default=0)
        plain_bytes = [bytes([i - low]) if i in set(self.bytes.values()) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.width = np.array(list(map(len, plain_bytes)), dtype=np.int64)
        self.place = np.cumsum(self.width) - self.width
        self.data = np.frombuffer(b"".join(plain_bytes), np.uint8)
        self.unknown = float(min(self.scores[plain])) - UNKNOWN_PENALTY
        if any(MARK in p.lstrip(MARK) for p in self.of):
            raise ValueError("pieces that reach from one word into the next are not supported")

    def starts(self, buf: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Units start at a space that no space precedes: no piece reaches over such a place."""
        blank = buf == 0x20
        start = first.copy()
        start[1:] |= blank[1:] & ~blank[:-1]
        return start

    def ids_of(self, token: bytes) -> list[int]:
        text = token.decode().replace(" ", MARK)
        return self.path(text, self.forward(text, 0, len(text)), 0, len(text))

    def forward(self, text: str, start: int, end: int, enter: list[float] | None = None) -> tuple[list[float], list[int], list[int]]:
        """Best score, start of the last piece (-1: none here) and piece (-1: an unknown character) for every place from start.

        Pieces begin before `end`; of equal scores the longest last piece is taken.  enter: the scores with which the
        first places are reached by a piece that began before the text; that is longer than any that begins in it.
        """
        limit = min(len(text), end + self.longest)
        best, back, by = [LOWEST] * (limit + 1), [-1] * (limit + 1), [-1] * (limit + 1)
        best[start] = 0.0
        if enter is not None:
            n = min(len(enter), limit + 1)
            best[:n] = enter[:n]
        trie, unknown = self.trie, self.unknown
        for i in range(start, end):
            here = best[i]
            if here == LOWEST:
                continue
            node, j, alone = trie, i, True
            while j < limit:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                hit = node.get("")
                if hit is not None:
                    if j == i + 1:
                        alone = False
                    if here + hit[1] > best[j]:
                        best[j], back[j], by[j] = here + hit[1], i, hit[0]
            if alone and here + unknown > best[i + 1]:
                best[i + 1], back[i + 1], by[i + 1] = here + unknown, i, -1
        return best, back, by

    def path(self, text: str, run: tuple, start: int, end: int) -> list[int]:
        """Ids of the best path from start to end; bytes for unknown characters."""
        _, back, by = run
        out: list[list[int]] = []
        while end > start and back[end] >= 0:
            out.append([by[end]] if by[end] >= 0 else [self.bytes[b] for b in text[back[end] : end].encode()] if self.bytes else [0])
            end = back[end]
        return [x for part in reversed(out) for x in part]

    def total(self, ids: np.ndarray) -> float:
        """Score of a path: of its pieces, and of each unknown character by its first byte."""
        if not self.bytes:
            return float(np.where(ids == 0, self.unknown, self.scores[ids]).sum())
        low = min(self.bytes.values())
        value = ids - low
        byte = (value >= 0) & (value < 256)
        return float(self.scores[ids[~byte]].sum() + self.unknown * np.count_nonzero(byte & ((value & 0xC0) != 0x80)))

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """The texts of id arrays that stand one behind another, n of each, without the space in front."""
        width = self.width[ids]
        total = np.concatenate([[0], np.cumsum(width)])
        data = self.data[np.repeat(self.place[ids] - total[:-1], width) + np.arange(total[-1])].tobytes()
        ends = np.cumsum(n)
        return [data[total[e - k] + 1 : total[e]].decode(errors="replace") if k else "" for e, k in zip(ends.tolist(), n.tolist(), strict=True)]

    # A chunk covers [0, end) of its text, behind which up to longest - 1 characters follow.
    # State s at a limit: the piece that crosses it ends s characters behind it.

    def fixed(self, text: str, end: int) -> tuple[int, int]:
        """The first unit start that every path reaches whatever its state, and the last one; (end, end) if there is none."""
        at = [i for i in range(self.longest - 1, end) if text[i] == MARK and i and text[i - 1] != MARK][:1]
        if not at:
            return end, end
        last = end - 1
        while not (text[last] == MARK and text[last - 1] != MARK):
            last -= 1
        return at[0], last

    def transfer(self, text: str, end: int, middle: float | None) -> np.ndarray:
        """The chunk's matrix: best score from each state at its start to each at its end.

        middle: the score of the units between its fixed places; None if it has none.
        """
        states = self.longest
        first, last = self.fixed(text, end)
        head = [self.forward(text, s, first)[0] if s <= first else None for s in range(states)]
        if middle is None:
            out = np.full((states, states), LOWEST)
            for s, best in enumerate(head):
                if best is not None:
                    for e in range(min(states, len(best) - end)):
                        out[s, e] = best[end + e]
            return out
        tail = self.forward(text, last, end)[0]
        ends = np.array([tail[end + e] if end + e < len(tail) else LOWEST for e in range(states)])
        starts = np.array([best[first] for best in head])
        return starts[:, None] + middle + ends[None, :]

    def entered(self, head: str, tail: str, rest: int, enter: list[float]) -> list[int]:
        """The state at its start that the best path through a chunk has, for each state at its end (-1: not reached)."""
        text, end = (head, len(head)) if rest else (head + tail, len(head))
        _, back, _ = run = self.forward(text, 0, end, enter)
        ends = [end] * self.longest if rest else [end + e for e in range(self.longest)]

        def origin(at: int) -> int:
            while at < len(back) and back[at] >= 0:
                at = back[at]
            return at if at < min(len(enter), len(back)) and run[0][at] > LOWEST else -1

        return [origin(e) for e in ends]

    def walk(self, text: str, enter: list[float], end: int, last: int) -> list[int]:
        """Ids of the best path to last, whose pieces begin before end, from the state where it enters."""
        return self.path(text, self.forward(text, 0, end, enter), 0, last)


def model(path: str) -> Model:
    """The worker's model for a file."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def _ahead(matrices: list[np.ndarray], enter: np.ndarray) -> list[list[float]]:
    """The best scores of each state in front of every matrix."""
    out = []
    for m in matrices:
        out.append(enter.tolist())
        enter = (enter[:, None] + m).max(0)
    return out


def _whole(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL("ids array<int>, score double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for part in common.parts(batches, 1, SLICE_BYTES):
            ids, n = m.encode([b" " + x if x else b"" for x in common.to_bytes(part.column(1))])
            ends = np.cumsum(n)
            score = [m.total(ids[e - k : e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32)), pa.array(score, pa.float64())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS) -> DataFrame:
    """The segmentation of every whole text with the highest sum of piece scores: (id, ids, score).

    Texts are taken as the library normalises for such models (a space in front, MARK for spaces).
    Scores are those of the file; a character that no piece covers scores UNKNOWN_PENALTY under the lowest
    and becomes its UTF-8 bytes' pieces.  Texts of more than `chunk` characters are cut into
    chunks that are worked on apart: each gives its matrix of best scores from every state at its start
    (how far a crossing piece reaches in) to every state at its end; products of max-plus
    matrices, which are associative, are taken over groups of GROUP_CHUNKS and then over a text's groups, the best scores of the states in front
    of each chunk go down the same way; with these a chunk tells which state each of its last states comes from, and, that chain
    followed, every chunk traces its own part.

    Null and empty texts have no pieces.  One row for each input row; equal rows are allowed.
    Of segmentations with equal sums the one with the longest last piece is returned, among these the one with the longest piece before
    it, and so on; cut texts follow the same rule, so the ids do not depend on `chunk` (as long as sums of scores are exact; those of whole numbers are).
    Other input columns are not returned.
    """
    rows = docs.select(id_col, text_col)
    small = _whole(rows.where(F.coalesce(F.length(text_col), F.lit(0)) <= chunk), id_col, text_col, path)
    giant = rows.where(F.length(text_col) > chunk).withColumn("uid", F.sha2(text_col, 256))
    spark = docs.sparkSession
    n = common.partitions(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = model(path).longest - 1
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = (" " + text).replace(" ", MARK)
                starts = list(range(0, len(text), chunk))
                if len(starts) > 1 and len(text) - starts[-1] < over:  # a rest shorter than a piece stays with the chunk before
                    starts.pop()
                for k, s in enumerate(starts):
                    end = len(text) if k == len(starts) - 1 else s + chunk
                    yield pa.RecordBatch.from_arrays([pa.array([uid]), pa.array([k]), pa.array([k == len(starts) - 1]), pa.array([end - s]), pa.array([text[s : end + over]])], names=["uid", "k", "last", "size", "part"])

    chunks = giant.select("uid", text_col).dropDuplicates(["uid"]).mapInArrow(cut, "uid string, k long, last boolean, size long, part string").repartition(n, "uid", "k")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # With the matrix go the ids of the middle, which no state changes, and the two ends' texts.
        m = model(path)
        for part in common.parts(batches, 4, SLICE_BYTES):
            texts, sizes = part.column(4).to_pylist(), part.column(3).to_pylist()
            limits = [m.fixed(t, size) for t, size in zip(texts, sizes, strict=True)]
            ids, n = m.encode([t[a:b].replace(MARK, " ").encode() for t, (a, b) in zip(texts, limits, strict=True)])
            ends = np.cumsum(n)
            middles = [None if a == size else m.total(ids[e - k : e]) for (a, _), size, e, k in zip(limits, sizes, ends.tolist(), n.tolist(), strict=True)]
            found = [m.transfer(t, size, middle).tobytes() for t, size, middle in zip(texts, sizes, middles, strict=True)]
            inside = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, pa.binary()), inside, pa.array([t[:a] for t, (a, _) in zip(texts, limits, strict=True)]), pa.array([t[b:] for t, (_, b) in zip(texts, limits, strict=True)]), pa.array([size - b for size, (_, b) in zip(sizes, limits, strict=True)], pa.int64())], names=["uid", "k", "matrix", "inside", "head", "tail", "rest"])

    def load(t: pa.Table) -> list[np.ndarray]:
        flat = [np.frombuffer(x, np.float64) for x in t["matrix"].to_pylist()]
        return [x.reshape(int(len(x) ** 0.5), -1) for x in flat]

    def product(key, t):
        t = t.sort_by("k")
        whole, *rest = load(t)
        for x in rest:
            whole = times(whole, x)
        return pa.table({"uid": t["uid"].slice(0, 1), "g": pa.array([key[1].as_py()]), "matrix": pa.array([whole.tobytes()], pa.binary())})

    def over_groups(key, t):
        t = t.sort_by("g")
        found = load(t)
        start = np.full(len(found[0]), LOWEST)
        start[0] = 0.0
        return pa.table({"uid": t["uid"], "g": t["g"], "enter": pa.array(_ahead(found, start), pa.list_(pa.float64()))})

    def over_chunks(key, t, before):
        t = t.sort_by("k")
        return pa.table({"uid": t["uid"], "k": t["k"], "enter": pa.array(_ahead(load(t), np.array(before["enter"][0].as_py())), pa.list_(pa.float64()))})

    made = common.table(chunks.mapInArrow(matrices, "uid string, k long, matrix binary, inside array<int>, head string, tail string, rest long").withColumn("g", F.floor(F.col("k") / GROUP_CHUNKS)))
    scores = made.select("uid", "k", "g", "matrix")
    groups = scores.groupBy("uid", "g").applyInArrow(product, "uid string, g long, matrix binary")
    before = groups.groupBy("uid").applyInArrow(over_groups, "uid string, g long, enter array<double>")
    enters = common.table(scores.groupBy("uid", "g").cogroup(before.groupBy("uid", "g")).applyInArrow(over_chunks, "uid string, k long, enter array<double>"))

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("head", "tail", "rest", "enter")), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("k"), pa.array([m.entered(*x) for x in rows], pa.list_(pa.int64()))], names=["uid", "k", "from"])

    def chain(key, t):
        # 8 bytes for a state, of some for each chunk: a thousandth of the text.
        t = t.sort_by("k")
        leave, out = 0, []
        for come in reversed(t["from"].to_pylist()):
            out.append(leave)
            leave = come[leave]
        return pa.table({"uid": t["uid"], "k": t["k"], "leave": pa.array(out[::-1], pa.int64())})

    leaves = made.select("uid", "k", "head", "tail", "rest").join(enters, ["uid", "k"]).mapInArrow(leads, "uid string, k long, from array<long>").groupBy("uid").applyInArrow(chain, "uid string, k long, leave long")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        alone = [0.0]
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                head, tail, rest, enter, leave = (part.column(c).to_pylist() for c in ("head", "tail", "rest", "enter", "leave"))
                ids = []
                for x, h, t, n, s, e in zip(part.column("inside"), head, tail, rest, enter, leave, strict=True):
                    if not n:  # no fixed place: the head is the chunk, the tail what follows
                        own = m.walk(h + t, s, len(h), len(h) + e)
                    else:
                        own = [*m.walk(h, s, len(h), len(h)), *x.values.to_pylist(), *m.walk(t, alone, n, n + e)]
                    ids.append(np.array(own, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("k"), pa.array(ids, pa.list_(pa.int32())), pa.array([m.total(x) for x in ids], pa.float64())], names=["uid", "k", "ids", "score"])

    traced = made.drop("matrix", "g").join(enters.join(leaves, ["uid", "k"]), ["uid", "k"]).select("uid", "k", "inside", "head", "tail", "rest", "enter", "leave").mapInArrow(trace, "uid string, k long, ids array<int>, score double")
    # A text's pieces are one value of the result, so they meet in one row.
    whole = traced.groupBy("uid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"), F.sum("score").alias("score"))
    large = giant.select(id_col, "uid").join(whole, "uid").select(id_col, "ids", "score")
    return small.unionByName(large)


def _by_ids(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(part of a batch, its ids, ids of each row), about 100,000 ids at a time."""
    for batch in batches:
        n = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in common.slices(n, 100_000):
            part = batch.slice(a, b - a)
            yield part, part.column(place).flatten().to_numpy(zero_copy_only=False).astype(np.int64), n[a:b]


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """The texts of id arrays, in a column added (or replaced); null and empty arrays give empty texts."""
    rows = encoded.drop(to)
    schema = T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())])
    place = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for part, ids, n in _by_ids(batches, place):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(m.decode(ids, n), pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def digest(encoded: DataFrame, id_col: str, path: str) -> DataFrame:
    """(id, n_pieces, score, ids_crc32 of little-endian unsigned 32-bit ids, text_crc32 of the decoded text)."""
    schema = T.StructType([encoded.schema[id_col], *T.StructType.fromDDL("n_pieces long, score double, ids_crc32 long, text_crc32 long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for part, ids, n in _by_ids(batches, 1):
            raw, ends = ids.astype("<u4").tobytes(), np.cumsum(n).tolist()
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends, n.tolist(), strict=True)]
            back = [zlib.crc32(x.encode()) for x in m.decode(ids, n)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), part.column(2), pa.array(crc, pa.int64()), pa.array(back, pa.int64())], names=schema.names)

    return encoded.select(id_col, "ids", "score").mapInArrow(run, schema)
