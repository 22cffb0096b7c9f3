"""Operator 11: collocations, counted by broadcast double-array tries of Apriori-safe candidates."""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Texts are encoded in blocks of about so many bytes, cut only between pieces.
BLOCK_BYTES = 4 << 20
#: Most candidates of a trie, and most hashes, that are broadcast at a time; more go in further passes.
TRIE_PHRASES = 250_000
LIKELY_HASHES = 4_000_000
#: A task collects so many hashes before it sends them.
HELD_HASHES = 1_500_000
#: Words of a range of hashes, on average.
RANGE_HASHES = 4_000_000
#: A task collects so many phrases before it drops the repeated ones.
HELD_PHRASES = 200_000
#: Candidates that a task sends as one row.
COUNT_RANGE = 4096
#: Phrases are hashed to so many bits for the upper bounds.
HASH_BITS = 48

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

ENCODED = "lang string, n_words long, words array<string>, hashes array<long>, counts array<long>, codes binary"
_ENCODED_ARROW = pa.schema([("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])


class Trie:
    """A double array over phrases of 64-bit word hashes.

    A state is a slot; a word's code leads from state s to slot base[s] + code, if check of that slot is s (a base can be below 0, and
    slots count from the end then, where no child of s is).
    Slot 0 is the root; phrase[s] is the number of the phrase that ends in s, or -1.  All phrases have the same number of words.
    """

    def __init__(self, phrases: np.ndarray):
        self.letters = np.unique(phrases)
        coded = np.searchsorted(self.letters, phrases) + 1
        order = np.lexsort(coded.T[::-1])
        self.phrases, coded = phrases[order], coded[order]
        width, n = len(self.letters) + 1, len(coded)
        self.base, self.check, free = np.zeros(width, np.int64), np.full(width, -1, np.int64), np.ones(width, bool)
        free[0] = False
        node, slots, new = np.zeros(n, np.int64), np.zeros(1, np.int64), np.zeros(n, bool)
        for column in coded.T:
            # The nodes of this level: where sorted phrases differ in their first words.
            new[:1] = True
            new[1:] |= column[1:] != column[:-1]
            first = np.flatnonzero(new)
            parent, code = node[first], column[first]
            node = np.cumsum(new) - 1
            size = np.bincount(parent, minlength=len(slots))
            at = np.concatenate([[0], np.cumsum(size)])
            made = np.zeros(len(first), np.int64)
            # Those with the most children first, while there is room; those with about as many go on from where the last one found room.
            several = np.flatnonzero(size > 1)
            hints: Counter = Counter()
            for p in several[np.argsort(-size[several], kind="stable")].tolist():
                codes = code[at[p] : at[p + 1]] - code[at[p]]
                kind = len(codes).bit_length()
                here, missed = hints[kind], 0
                free = self._room(free, here + width)
                # Steps grow with the misses: some slots stay empty, but the search stays short.
                while not free[here + codes].all():
                    missed += 1
                    here += 1 + missed * missed // 16
                    free = self._room(free, here + width)
                hints[kind] = here
                made[at[p] : at[p + 1]] = here + codes
                free[here + codes] = False
            # An only child can have any slot.
            alone = at[:-1][size == 1]
            free = self._room(free, len(free) + len(alone))
            made[alone] = np.flatnonzero(free)[: len(alone)]
            free[made[alone]] = False
            self.check[made] = slots[parent]
            self.base[slots[parent]] = made - code
            slots = made
        used = int(np.flatnonzero(~free).max()) + width + 1
        self._room(free, used)
        self.base, self.check, self.phrase = self.base[:used].astype(np.int32), self.check[:used].astype(np.int32), np.full(used, -1, np.int32)
        self.phrase[slots] = np.arange(n)

    def _room(self, free: np.ndarray, size: int) -> np.ndarray:
        more = size - len(free)
        if more > 0:
            more += size
            self.base, self.check = np.concatenate([self.base, np.zeros(more, np.int64)]), np.concatenate([self.check, np.full(more, -1, np.int64)])
            free = np.concatenate([free, np.ones(more, bool)])
        return free

    def letter_codes(self, hashes: np.ndarray) -> np.ndarray:
        """The trie's code of each word hash; 0 for words that it does not hold."""
        if not len(self.letters):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.letters, hashes), len(self.letters) - 1)
        return np.where(self.letters[at] == hashes, at + 1, 0)

    def run(self, codes: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level: (positions still in the trie, their states), all positions advanced at once."""
        at, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for level in range(depth):
            fits = at + level < len(codes)
            at, state = at[fits], state[fits]
            c = codes[at + level]
            to = self.base[state] + c
            good = (c > 0) & (self.check[to] == state)
            at, state = at[good], to[good]
            yield at, state


def _hash(lang: str, words_buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    return common.mix(common.span_hashes(words_buf, starts, ends, common.SEEDS[0] + 2 * seed) + np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed)))


def _blocks(buf: np.ndarray) -> Iterator[np.ndarray]:
    """Of about BLOCK_BYTES, ending behind a separator of pieces."""
    start = 0
    while start < len(buf):
        stop = start + BLOCK_BYTES
        if stop < len(buf):
            while stop < len(buf):
                cut = np.flatnonzero(_KIND[buf[stop : stop + (1 << 16)]] == 2)
                if len(cut):
                    stop += int(cut[0]) + 1
                    break
                stop += 1 << 16
        yield buf[start:stop]
        start = stop


def _encode_block(lang: str, buf: np.ndarray, seed: int) -> tuple | None:
    kind = _KIND[buf]
    edge = np.zeros(len(buf) + 2, np.int8)
    edge[1:-1] = kind == 0
    step = np.diff(edge)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return None
    hashes = _hash(lang, buf, starts, ends, seed)
    distinct, first, code, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    pieces = np.cumsum(kind == 2)[starts]
    gap = np.flatnonzero(np.diff(pieces))
    codes = np.insert(code.astype(np.int64) + 1, gap + 1, 0)
    data = buf.tobytes()
    words = [data[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    return lang, len(starts), words, distinct.view(np.int64), n, codes.astype(np.uint16 if len(distinct) < 65535 else np.uint32).tobytes()


def encode(docs: DataFrame, text_col: str, lang_col: str, seed: int) -> DataFrame:
    """Texts as blocks of word codes, with the block's words, their hashes and counts; code 0 stands between pieces."""

    def run(batches):
        held: dict[str, list[bytes]] = defaultdict(list)
        sizes: Counter = Counter()

        def flush(lang):
            buf = common.LOWER[np.frombuffer(b"\n".join(held.pop(lang)), np.uint8)]
            del sizes[lang]
            for block in _blocks(buf):
                made = _encode_block(lang, block, seed)
                if made:
                    lang, n, words, hashes, counts, codes = made
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([n]), pa.array([words], pa.list_(pa.string())), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in (hashes, counts)), pa.array([codes], pa.binary())],
                        schema=_ENCODED_ARROW,
                    )

        for part in common.parts(batches, text_col):
            for lang, text in zip(part.column(lang_col).to_pylist(), common.to_bytes(part.column(text_col)), strict=True):
                if text:
                    held[lang].append(text)
                    sizes[lang] += len(text)
            # The whole of what is held is bounded, however many languages there are.
            while sizes.total() > BLOCK_BYTES:
                yield from flush(sizes.most_common(1)[0][0])
        for lang in list(held):
            yield from flush(lang)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias(lang_col), F.col(text_col))
    return rows.mapInArrow(run, ENCODED)


def _words(encoded: DataFrame) -> DataFrame:
    """(hashes, lang, word, f): every word once with its number of occurrences, summed from the blocks' own counts; the words of blocks are joined to nothing."""
    each = encoded.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w")).select("lang", "w.*")
    return each.groupBy("hashes", "lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))


def _rows(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of the block's words, codes of its positions) of encoded rows."""
    for batch in batches:
        for hashes, codes in zip(batch.column("hashes"), batch.column("codes"), strict=True):
            h, data = hashes.values.to_numpy(), codes.as_py()
            # 0 stands between pieces, so nearly every block with fewer than 65,535 words has two bytes a code.
            yield h, np.frombuffer(data, np.uint16 if len(h) < 65535 else np.uint32).astype(np.int64)


def _keys(h: np.ndarray, codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of HASH_BITS of the phrases of `size` words at some places."""
    u = h.view(np.uint64)
    out = u[codes[at] - 1]
    for j in range(1, size):
        out = common.mix(out + common.mix(u[codes[at + j] - 1] ^ np.uint64(common.WINDOW_SEEDS[1])))
    return out >> np.uint64(64 - HASH_BITS)


def _adjacent(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))


def _sent(encoded: DataFrame, places, size: int, least: int, bits: int) -> DataFrame:
    """Hashes of the phrases of `size` words at the places, with counts: sorted and packed, one row for each range of hashes that a task has."""

    def run(batches):
        keys, counts, held = [], [], 0

        def flush():
            k, n = _summed(keys, counts)
            cuts = np.searchsorted(k, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(HASH_BITS - bits))
            used = np.flatnonzero(np.diff(cuts))
            size = [(int(cuts[i]), int(cuts[i + 1])) for i in used.tolist()]
            for i in range(0, len(size), 256):
                some = size[i : i + 256]
                yield pa.RecordBatch.from_arrays([pa.array(used[i : i + 256], pa.int64()), pa.array([_pack(k[a:b], n[a:b]) for a, b in some], pa.binary())], names=["bucket", "packed"])

        for h, codes in _rows(batches):
            k, c = np.unique(_keys(h, codes, places(h, codes), size), return_counts=True)
            keys.append(k)
            counts.append(np.minimum(c, least).astype(np.int64))
            held += len(k)
            if held > HELD_HASHES:
                yield from flush()
                keys, counts, held = [], [], 0
        if held:
            yield from flush()

    return encoded.select("hashes", "codes").mapInArrow(run, "bucket long, packed binary")


def _likely(sent: DataFrame, least: int) -> DataFrame:
    """Hashes whose counts over all texts reach `least`: none of a frequent phrase is missing, as equal hashes only add up."""

    def judge(key, t):
        keys, counts = zip(*(_unpack(x) for x in t["packed"].to_pylist()), strict=True)
        k, n = _summed(list(keys), list(counts))
        return pa.table({"hash": k[n >= least].astype(np.int64)})

    return sent.groupBy("bucket").applyInArrow(judge, "hash long")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(n, first)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Number of keys; bytes of a step and of a count; steps and counts, plane by plane."""
    steps = np.concatenate([keys[:1], np.diff(keys)]).astype("<u8")
    counts = counts.astype("<u8")
    widths = [(int(x.max()).bit_length() + 7) // 8 for x in (steps, counts)]
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for x, w in zip((steps, counts), widths, strict=True)]
    return np.array([len(keys), *widths], "<u8").tobytes() + b"".join(planes)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, a, b = np.frombuffer(data, "<u8", 3).tolist()
    out = []
    for width, at in ((a, 24), (b, 24 + n * a)):
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
        out.append(x.view("<u8").ravel())
    return np.cumsum(out[0], dtype=np.uint64), out[1].astype(np.int64)


def _slices(df: DataFrame, most: int) -> Iterator[pa.Table]:
    """The rows in tables of about `most`, one at a time."""
    n = -(-df.count() // most)
    for i in range(n):
        yield (df if n == 1 else df.where(F.pmod(F.xxhash64(*df.columns), F.lit(n)) == i)).toArrow()


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, size)


def _lists(rows: np.ndarray) -> pa.ListArray:
    size = rows.shape[1] if rows.ndim > 1 else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(size)), pa.array(rows.ravel(), pa.int64()))


def _observed(encoded: DataFrame, places, size: int, likely: DataFrame) -> DataFrame:
    """Distinct phrases of `size` words at the places whose hashes are likely; a pass for each slice of the hashes."""
    out = None
    for table in _slices(likely, LIKELY_HASHES):
        told = encoded.sparkSession.sparkContext.broadcast(np.sort(table["hash"].to_numpy().astype(np.uint64)))

        def run(batches, told=told):
            good, kept, held = told.value, [np.zeros((0, size + 1), np.int64)], 0
            for h, codes in _rows(batches):
                at = places(h, codes)
                keys = _keys(h, codes, at, size)
                number = np.minimum(np.searchsorted(good, keys), len(good) - 1)
                hit = np.flatnonzero(good[number] == keys)
                found = np.concatenate([number[hit, None], h[codes[at[hit, None] + np.arange(size)] - 1]], 1)
                kept.append(np.unique(found, axis=0))
                held += len(kept[-1])
                if held > HELD_PHRASES:
                    kept = [np.unique(np.concatenate(kept), axis=0)]
                    held = 0
            rows = np.unique(np.concatenate(kept), axis=0)
            buckets, first = np.unique(rows[:, 0] // COUNT_RANGE, return_index=True)
            packed = [x[:, 1:].tobytes() for x in np.split(rows, first[1:])] if len(rows) else []
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "packed"])

        def distinct(key, t):
            return pa.table({"phrase": _lists(np.unique(np.concatenate([np.frombuffer(x, np.int64).reshape(-1, size) for x in t["packed"].to_pylist()]), axis=0))})

        part = common.table(encoded.select("hashes", "codes").mapInArrow(run, "bucket long, packed binary").groupBy("bucket").applyInArrow(distinct, "phrase array<long>"))
        told.destroy()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else encoded.sparkSession.createDataFrame([], "phrase array<long>")


def _adder(told, least: int):
    def add(key, t):
        number, f = _summed(*map(list, zip(*(_unpack(x) for x in t["packed"].to_pylist()), strict=True)))
        number, f = number[f >= least].astype(np.int64), f[f >= least]
        return pa.table({"phrase": _lists(told.value.phrases[number]), "f": pa.array(f, pa.int64())})

    return add


def _count(encoded: DataFrame, candidates: DataFrame, size: int, least: int) -> DataFrame:
    """(phrase, f) of the candidates that occur `least` times or more: a trie for each slice of them, one pass for each trie."""
    spark, counted = encoded.sparkSession, None
    for table in _slices(candidates, TRIE_PHRASES):
        told = spark.sparkContext.broadcast(Trie(_matrix(table["phrase"], size)))

        def run(batches, told=told):
            trie = told.value
            total = np.zeros(len(trie.phrases), np.int64)
            for h, codes in _rows(batches):
                letters = np.concatenate([[0], trie.letter_codes(h)])[codes]
                for _, state in trie.run(letters, size):
                    pass
                ends = trie.phrase[state]
                total += np.bincount(ends[ends >= 0], minlength=len(total))
            at = np.flatnonzero(total)
            buckets, first = np.unique(at // COUNT_RANGE, return_index=True)
            packed = [_pack(x.astype(np.uint64), total[x]) for x in np.split(at, first[1:])] if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "packed"])

        part = common.table(encoded.select("hashes", "codes").mapInArrow(run, "bucket long, packed binary").groupBy("bucket").applyInArrow(_adder(told, least), "phrase array<long>, f long"))
        told.destroy()
        counted = part if counted is None else counted.unionByName(part)
    return counted if counted is not None else spark.createDataFrame([], "phrase array<long>, f long")


def _pairs(encoded: DataFrame, least: int, bits: int) -> DataFrame:
    """Candidates of two words."""
    return _observed(encoded, _adjacent, 2, common.table(_likely(_sent(encoded, _adjacent, 2, least, bits), least)))


def _longer(encoded: DataFrame, frequent: DataFrame, size: int, least: int, bits: int) -> DataFrame:
    """Candidates one word longer than the frequent phrases of `size` words: both their parts of that size are frequent, and their hashes occur often enough.

    Where the frequent ones fill several tries, each gives the places that begin with one of its phrases, so that every
    place is given once; the second part is then looked up by a join.
    """
    spark, whole = encoded.sparkSession, frequent.count() <= TRIE_PHRASES
    empty = spark.createDataFrame([], "phrase array<long>")
    told = [spark.sparkContext.broadcast(Trie(_matrix(t["phrase"], size))) for t in _slices(frequent.select("phrase"), TRIE_PHRASES)] if whole else []
    if whole and not told:
        return empty

    def places(h, codes, told):
        trie = told.value
        letters = np.concatenate([[0], trie.letter_codes(h)])[codes]
        for at, state in trie.run(letters, size):
            pass
        known = np.zeros(len(codes) + 1, bool)
        known[at[trie.phrase[state] >= 0]] = True
        if whole:
            return np.flatnonzero(known[:-1] & known[1:])
        at = np.flatnonzero(known[: len(codes) - size])
        return at[codes[at + size] > 0]

    if whole:
        here = functools.partial(places, told=told[0])
        found = _observed(encoded, here, size + 1, common.table(_likely(_sent(encoded, here, size + 1, least, bits), least)))
        told[0].destroy()
        return found
    sent = None
    for table in _slices(frequent.select("phrase"), TRIE_PHRASES):
        trie = spark.sparkContext.broadcast(Trie(_matrix(table["phrase"], size)))
        part = common.table(_sent(encoded, functools.partial(places, told=trie), size + 1, least, bits))
        trie.destroy()
        sent = part if sent is None else sent.unionByName(part)
    likely, begun = common.table(_likely(sent, least)), empty
    for table in _slices(frequent.select("phrase"), TRIE_PHRASES):
        trie = spark.sparkContext.broadcast(Trie(_matrix(table["phrase"], size)))
        begun = begun.unionByName(_observed(encoded, functools.partial(places, told=trie), size + 1, likely))
        trie.destroy()
    return common.table(begun.withColumn("rest", F.slice("phrase", 2, size)).join(frequent.select(F.col("phrase").alias("rest")), "rest", "left_semi").select("phrase"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, most_words: int = 5, percent: int = 100, top: int = 2000) -> DataFrame:
    """Each language's best phrases of 2 to `most_words` words.

    Words are the runs without blank and tab of the pieces between .,;:!? and line ends, A-Z lower-cased.  A phrase with
    a >= `least` occurrences is cut in two after its first k words; with l and r occurrences of the parts and n words of the
    language, the score is the least floor(1000 a n / (l r)) over the cuts, the smallest k among equals.  Phrases inside a longer one
    that has `percent` of their occurrences or more are left out; the first `top` by score, a and phrase (UTF-8 order) stay.

    Blocks of texts are encoded once.  Words are counted by a shuffle.  Then, for 2, 3, ... words, hashes of the phrases whose two parts with a word
    less are both frequent (of all pairs, at first) are summed, packed, to upper bounds; the phrases that these allow are the
    candidates, held by double-array tries.  A pass advances all positions of a block through the trie at once, level by level, and counts
    the accepting states; the sums of the tasks are exact.  Tries and sets of hashes are cut to a bounded size; more candidates
    take more passes.

    Null texts are empty, a null language is `und`; repeated rows count again; other columns are not read.  No texts, or no phrase that is
    frequent, give no rows.  Scores are exact up to 38 digits.  Words of a language are told apart by 64-bit hashes; equal hashes of
    two words would be seen, and all hashed anew.
    Returns lang, rank, phrase, a, l, r, n, score and k, the words of the first part.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    for seed in range(8):
        encoded = common.table(encode(rows, "text", "lang", seed))
        counted = common.table(_words(encoded))
        if counted.groupBy("hashes").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            break
    else:
        raise RuntimeError("words with equal hashes under every seed")
    words = common.table(counted.where(F.col("f") >= least))
    n = encoded.agg(F.sum("n_words")).first()[0] or 0
    bits = int(max(4, np.ceil(np.log2(max(1, n / RANGE_HASHES)))))
    frequent = {1: words.select(F.array("hashes").alias("phrase"), "f")}
    for size in range(2, most_words + 1):
        candidates = _pairs(encoded, least, bits) if size == 2 else _longer(encoded, frequent[size - 1], size - 1, least, bits)
        frequent[size] = _count(encoded, candidates, size, least)
    phrases = functools.reduce(DataFrame.unionByName, (frequent[k] for k in range(2, most_words + 1)))
    everything = phrases.unionByName(frequent[1])

    inside = phrases.where(F.size("phrase") > 2).select(F.col("f").alias("longer"), F.explode(_parts_of(F.col("phrase"))).alias("phrase"))
    covered = inside.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = phrases.join(covered, "phrase", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f"))).select("phrase", F.col("f").alias("a"))

    cuts = kept.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.slice("phrase", 1, F.col("k")), "rest": F.slice("phrase", F.col("k") + 1, F.size("phrase"))})
    cuts = cuts.join(everything.select(F.col("phrase").alias("first"), F.col("f").alias("l")), "first").join(everything.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest")
    total = encoded.groupBy("lang").agg(F.sum("n_words").alias("n"))
    named = kept.select("phrase", F.posexplode("phrase").alias("i", "hashes")).join(words.select("hashes", "lang", "word"), "hashes")
    named = named.groupBy("phrase").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("text"))
    scored = cuts.join(named, "phrase").join(total, "lang").withColumn("score", F.expr("(1000 * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"))
    best = scored.groupBy("lang", F.col("text").alias("phrase"), "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # Ranked within shares of a language first, so that no task gets more than a bounded part of one.
    order = (F.desc("b.score"), F.desc("a"), F.col("phrase"))
    best = best.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(common.partitions(docs.sparkSession))))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    out = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "b.l", "b.r", "n", "b.score", F.col("b.k").cast("long").alias("k"))


def _parts_of(phrase):
    """All shorter contiguous parts of 2 words or more."""
    sizes = F.sequence(F.lit(2), F.size(phrase) - 1)
    return F.array_distinct(F.flatten(F.transform(sizes, lambda m: F.transform(F.sequence(F.lit(1), F.size(phrase) - m + 1), lambda i: F.slice(phrase, i, m)))))


def brute_force(rows: list[tuple[str | None, str | None]], least: int = 100, most_words: int = 5, percent: int = 100, top: int = 2000) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score, k) of (text, lang) rows by plain counters, for tests."""
    import re

    f: dict[str, Counter] = defaultdict(Counter)
    for text, lang in rows:
        low = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(rb"[ \t]+", piece) if x]
            for k in range(1, most_words + 1):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        good = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        covered = set()
        for q, c in good.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    p = q[i : i + m]
                    if 100 * c >= percent * good[p]:
                        covered.add(p)
        scored = []
        for p, a in good.items():
            if p not in covered:
                s, k = min((1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, b" ".join(p), count[p[:k]], count[p[k:]], k))
        for rank, (s, a, p, left, right, k) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s, k))
    return sorted(out)
