"""Each operator against brute force, on awkward rows and on empty tables."""

import functools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from runloom.llm import bpe, common, language, lattice, line_dedup, maxplus, neighbours, packing, quotations, simhash, substring_dedup, token_counts
from runloom.llm.queries import tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, key string, fp long, node long, chunk long, length long, rank int, uid string, score double"


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(vocabulary) for _ in range(n))


def rows():
    shared = words(1, 60)
    line = "This line of more than forty characters comes back again and again."
    long = words(2, 4000)
    texts = [
        None, "", " \n\t ", "x", "\n\n", "Ünïcödé – ‘quotes’ 日本語   end", shared, shared + " tail", "head " + shared + "\n" + words(3, 50),
        long, long, long + " and more", *[f"{words(10 + i, 20)}\n  {line.upper() if i % 2 else line}\t\n{words(30 + i, 5)}" for i in range(7)],
        words(4, 35), words(4, 35), words(5, 34), words(5, 34), "a " * 100, "<|endoftext|> a<|endoftext|>", "'s don't 'll  \n\n x" * 30, "a" * 3000,
    ]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", None, 7, "k", 1, 2, 3, 4, 5, "u", 0.5) for i, t in rows()], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_substrings(docs, none):
    made = {r[0]: tuple(r)[1:] for r in substring_dedup.digest(substring_dedup.remove_repeats(docs)).collect()}
    assert made == substring_dedup.brute_force(rows())
    kept = substring_dedup.remove_repeats(docs)
    assert {"source", "key", "chunk"} <= set(kept.columns) and kept.where("text IS NULL").count() == 1
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substring_spans_and_null_ids(spark):
    shared = words(8, 40)
    df = spark.createDataFrame([(None, "a b " + shared), (None, shared), (1, "q")], "doc_id long, text string")
    made = sorted((r["n_removed"], r["spans"]) for r in substring_dedup.remove_repeats(df).collect())
    assert [x[0] for x in made] == [0, 40, 40] and sorted(s.start for _, spans in made for s in spans) == [0, 2]


def test_lines(docs, none):
    made = {r[0]: tuple(r)[1:] for r in line_dedup.digest(line_dedup.drop_lines(docs)).collect()}
    assert made == line_dedup.brute_force(rows())
    assert line_dedup.drop_lines(none).count() == 0


def test_lines_repeated_rows_and_null_ids(spark):
    line = "x" * 50
    df = spark.createDataFrame([(1, line)] * 9 + [(2, line), (3, line), (4, line)], "doc_id long, text string")
    assert line_dedup.drop_lines(df).where("n_dropped > 0").count() == 0  # four documents only
    df = df.union(spark.createDataFrame([(None, line)], df.schema))
    kept = {r["doc_id"] for r in line_dedup.drop_lines(df).where("n_dropped = 0").collect()}
    assert kept == {4}


def test_token_counts(docs, none):
    path = tokenizer("byte_bpe_50k.json")
    library = bpe.encoder(path).library
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in rows()}
    for options in ({}, {"chunk": 300, "overlap": 40}, {"chunk": 64, "overlap": 33}):
        made = token_counts.count_tokens(docs, path, **options).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in made} == want, options
        assert all(r["over_limit"] == (r["n_tokens"] > 512) and r["n_bytes"] == len((dict(rows())[r["doc_id"]] or "").encode()) for r in made)
    assert token_counts.count_tokens(none, path).count() == 0


def test_token_counts_repeated_rows(docs):
    twice = docs.union(docs)
    assert token_counts.count_tokens(twice, tokenizer("byte_bpe_50k.json"), chunk=500).count() == 2 * docs.count()


def test_bpe_against_library():
    encoder = bpe.encoder(tokenizer("byte_bpe_50k.json"))
    r = random.Random(5)
    parts = ["a", "B", "é", "'s", "'re", "'ll", " ", "  ", "\n", "\t", " ", "　", "1", "²", "!", "<|endoftext|>", "<|endof", "中", "\U0001f600", "\x85", "\x1c", "s", "\r\n", "’"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(3000)]
    ids, n = encoder.encode([t.encode() for t in texts])
    ends = np.cumsum(n)
    for k, want in enumerate(encoder.library.encode_batch(texts, add_special_tokens=False)):
        assert ids[ends[k] - n[k] : ends[k]].tolist() == want.ids, texts[k]


def test_language(spark, none):
    sample = {"aa": "lorem ipsum dolor sit amet consetetur", "bb": "the quick brown fox jumps over it", "cc": "zwölf boxkämpfer jagen viktor quer über"}
    r = random.Random(3)
    made = [(i, " ".join(r.choices(sample[k].split(), k=30)), k) for i, k in enumerate(sorted(sample) * 40)]
    df = spark.createDataFrame([*made, (900, None, "aa"), (901, "", None), (902, "123 ... 4", "bb"), (903, "ü", None)], "doc_id long, text string, lang string")
    dictionaries = language.learn(df.where("doc_id % 3 = 0 OR doc_id < 30"))
    assert dictionaries == language.learn(df.where("doc_id % 3 = 0 OR doc_id < 30").repartition(5)) and set(dictionaries) == set(sample)
    out = {x["doc_id"]: x for x in language.classify(df.select("doc_id", "text"), dictionaries).collect()}
    good = [out[i]["lang_pred"] == k for i, _, k in made]
    assert np.mean(good) > 0.95 and all(0 <= x["score"] <= 1 for x in out.values())
    assert [out[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and all(out[i]["rejected"] for i in (900, 901, 902)) and out[903]["lang_pred"] != "und"
    assert language.learn(none) == {} and language.classify(none, {}).count() == 0
    assert {x["lang_pred"] for x in language.classify(df, {}).collect()} == {"und"}


def check_packing(made, texts, size):
    library = bpe.encoder(tokenizer("byte_bpe_50k.json")).library
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, t in texts}
    sequences, seen = {}, {i: 0 for i in ids}
    for r in made:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"] and len(ids[r["doc_id"]]) == r["doc_tokens"]
        seen[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen == {i: len(x) for i, x in ids.items()}
    for pieces in map(sorted, sequences.values()):
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False)) and sum(n for _, n in pieces) <= size
    return len(sequences)


def test_packing(docs, none):
    path = tokenizer("byte_bpe_50k.json")
    for size in (2048, 64):
        check_packing(packing.pack(docs, path, size=size).collect(), rows(), size)
    assert packing.pack(none, path).count() == 0
    with_ids = packing.pack(docs, path, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in with_ids)


def test_packing_patterns():
    r = random.Random(1)
    for _ in range(20):
        counts = {r.randrange(1, 65): r.randrange(1, 200) for _ in range(30)}
        patterns = packing.shortest_pack_first(counts, 64)
        used = {}
        for packs, inside in patterns:
            assert packs > 0 and sum(a * n for a, n in inside) <= 64
            for a, n in inside:
                used[a] = used.get(a, 0) + packs * n
        assert used == counts and len(patterns) <= 2 * len(counts)


def test_simhash(docs, none):
    made = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(docs).collect()}
    assert made == simhash.brute_force(rows())
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs.union(docs)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c in made.values()})
    assert sorted(simhash.keep_one(docs).columns) == sorted(docs.columns)


def test_simhash_links_find_every_pair(spark, monkeypatch):
    r = np.random.default_rng(2)
    base = r.integers(0, 2**63, 30, dtype=np.uint64)
    near = [b ^ np.bitwise_or.reduce(np.uint64(1) << r.choice(64, k, replace=False).astype(np.uint64)) for b in base for k in (1, 2, 3, 4, 4, 5)]
    values = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    want = list(range(len(values)))

    def root(i):
        while want[i] != i:
            i = want[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4) + i + 1:
            a, b = root(i), root(int(j))
            want[max(a, b)] = min(a, b)
    for block in (4096, 4):  # the second cuts nearly every signature into blocks
        monkeypatch.setattr(simhash, "BLOCK", block)
        df = spark.createDataFrame([(int(v.astype(np.int64)), i) for i, v in enumerate(values)], "fp long, node long")
        found = {x["node"]: x["component"] for x in common.components(simhash.links(df, 4)).collect()}
        assert [found.get(i, i) for i in range(len(values))] == [root(i) for i in range(len(values))]


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (450, 500), (7, 7), (600, 601), (601, 600), (None, 3)]
    made = {r[0]: r[1] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(made[i] == 0 for i in range(201)) and made[500] == made[450] == 400 and made[601] == 600 and 7 in made
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def embeddings(n, dim, seed, copies=6):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dim))
    for i in range(0, n - copies, 3 * copies):
        for k in range(1, copies):
            x[i + k] = x[i] + r.standard_normal(dim) * 0.12 * k / copies
    x[n // 2] = x[3]
    return x


def test_neighbours(spark):
    x = embeddings(1500, 16, 4)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] + [1.0] * 15), (2300, [None] + [1.0] * 15), (2400, [1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    made = {}
    for r in neighbours.search(df, df["vec_id"] % 100 == 0).collect():
        made.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(made) == list(range(0, 1500, 100))
    hit = 0
    for q, found in made.items():
        d = np.sqrt(np.square(x - x[q]).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(x)), d))[:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and all(abs(d[v] - s) < 1e-12 for _, v, s in found)
        hit += len({v for _, v, _ in found} & set(best.tolist()))
    assert hit >= 0.9 * 10 * len(made)


def test_bpe_text_with_more_pretokens_than_the_table(monkeypatch):
    """One text alone overflows the table, between others, with special tokens at the ends of ranges."""
    monkeypatch.setattr(bpe, "MOST_ENTRIES", 50)
    encoder = bpe.Encoder(tokenizer("byte_bpe_50k.json"))
    long = " ".join(f"id{i} {i * 7919} <|endoftext|>Ünï{i}\n" for i in range(700))
    texts = ["", "a few words", long, "a few other words", long + " " + words(6, 300), ""]
    ids, n = encoder.encode([t.encode() for t in texts])
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(x) for x in want] == encoder.counts([t.encode() for t in texts]).tolist()
    assert ids.tolist() == [x for w in want for x in w]


def test_neighbours_ties_go_to_the_smaller_id(spark, monkeypatch):
    """A third of the rows are copies of one vector, in blocks that are not measured in full."""
    monkeypatch.setattr(neighbours, "RERANK_LEAST", 16)
    x = embeddings(3000, 16, 11).astype(np.float32)
    x[np.random.default_rng(3).permutation(3000)[:1000]] = x[7]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    made = {}
    for r in neighbours.search(df, df["vec_id"] % 20 == 0).collect():
        made.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(made) == list(range(0, 3000, 20))
    hit = 0
    for q, found in made.items():
        d = np.sqrt(np.square(x.astype(np.float64) - x[q]).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(x)), d))[:10].tolist()
        found = [v for _, v in sorted(found)]
        assert len(found) == 10
        if d[best[-1]] == 0:
            assert found == best
        hit += len(set(found) & set(best))
    assert hit >= 0.9 * 10 * len(made)


def test_neighbours_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.search(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0).count() == 0
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 0.0]), (5, [0.0, 2.0])], schema)
    made = sorted(tuple(r) for r in neighbours.search(df, df["vec_id"] % 100 == 0).collect())
    assert made == [(0, 1, 100, 0.0), (0, 2, 5, 5.0**0.5), (100, 1, 0, 0.0), (100, 2, 5, 5.0**0.5)]


def test_lattice_with_vectors_of_several_lengths(spark):
    """Each length gives what it gives alone; 24 and 16 divide in sum, 7 does not."""
    kinds = {24: embeddings(120, 24, 5), 16: embeddings(120, 16, 6), 7: embeddings(61, 7, 8)}
    schema = "vec_id long, embedding array<double>"
    data = {dim: [(1000 * dim + i, v.tolist()) for i, v in enumerate(x)] for dim, x in kinds.items()}
    want = sorted(tuple(r) for rows in data.values() for r in lattice.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    made = lattice.near_duplicates(spark.createDataFrame([x for rows in data.values() for x in rows], schema)).collect()
    assert sorted(map(tuple, made)) == want and sum(r["n_links"] for r in made) > 0


@pytest.mark.parametrize("block", [4096, 8])
def test_lattice(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    x = embeddings(400, 24, 9)
    x[50], x[60] = 3 * x[0], x[0]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 24), (902, [float("inf")] + [1.0] * 23)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(400)
    for _ in range(400):
        label = np.array([min(label[i], *(label[near[i]].tolist() or [label[i]])) for i in range(400)])
    made = {r["vec_id"]: r for r in lattice.near_duplicates(df).collect()}
    links = sum(made[i]["n_links"] for i in range(400))
    assert 0.95 * near.sum() <= links <= near.sum() and all(made[i]["n_links"] <= near[i].sum() for i in range(400))
    assert np.mean([made[i]["component_id"] == label[i] for i in range(400)]) > 0.95
    assert all(made[i]["n_links"] == 0 and made[i]["kept"] for i in (900, 901, 902))


def test_lattice_recall_and_empty(spark):
    r = np.random.default_rng(1)
    a = r.standard_normal((1000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = r.standard_normal(a.shape)
    o -= (o * a).sum(1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    cells = lattice.Cells(64)
    met = lattice._first_meeting(cells.of(a), cells.of(0.9 * a + 0.19**0.5 * o)) < np.iinfo(np.int64).max
    assert met.mean() > 0.95
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lattice_points():
    r = np.random.default_rng(3)
    y = r.uniform(-2, 2, (500, 8))
    points = lattice.nearest(y)
    others = points[:, None, :] + lattice.roots()[None]
    assert len(lattice.roots()) == 240
    assert (np.square(y - points).sum(1)[:, None] <= np.square(y[:, None] - others).sum(2) + 1e-9).all()


def test_maxplus(docs, none):
    path = tokenizer("piece_bpe_32k.model")
    m = maxplus.model(path)
    whole = {r["doc_id"]: r for r in maxplus.encode(docs, path, chunk=1 << 20).collect()}
    for i, t in rows():
        assert m.decode(np.array(whole[i]["ids"], np.int64), np.array([len(whole[i]["ids"])])) == [t or ""]
        text = (" " + t).replace(" ", maxplus.MARK) if t else ""
        best = m.forward(text, 0, len(text))[0][len(text)] if t else 0.0
        assert abs(best - whole[i]["score"]) < 1e-3
    for chunk in (37, 300):
        made = {r["doc_id"]: r for r in maxplus.encode(docs, path, chunk=chunk).collect()}
        assert all(made[i]["score"] == whole[i]["score"] and len(made[i]["ids"]) > 0 or made[i]["ids"] == whole[i]["ids"] for i in whole)
        assert {r["doc_id"]: r["text"] for r in maxplus.decode(maxplus.encode(docs, path, chunk=chunk), path).collect()} == {i: t or "" for i, t in rows()}
    assert maxplus.encode(none, path).count() == 0
    back = maxplus.decode(maxplus.encode(docs, path), path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in rows()}


def test_maxplus_products_are_associative():
    r = np.random.default_rng(0)
    a, b, c = (r.integers(-9, 9, (5, 5)).astype(float) for _ in range(3))
    assert (maxplus.times(maxplus.times(a, b), c) == maxplus.times(a, maxplus.times(b, c))).all()


def test_quotations(spark):
    mails = [
        (1, 0, "Hello all,\n\nshall we meet on Monday at nine?"),
        (1, 1, "Fine with me.\nA wrote:\n> Hello all,\n>\n> shall we  meet on MONDAY at nine?"),
        (1, 2, "Me too.\n> Fine with me.\n> > Hello all,\n> > \n> > shall we meet on Monday at nine?"),
        (1, 3, "Only a part:\n> shall we meet on Monday at nine?\nNo, ten."),
        (2, 0, "> Me too.\nFrom another conversation."),
        (2, 1, "> something nobody wrote before this one\nok"),
        (2, 2, None), (2, 3, ""), (2, 4, "> "), (None, 1, "x"), (1, 2, "Me too.\n> Fine with me.\n> > Hello all,\n> > \n> > shall we meet on Monday at nine?"),
    ]
    df = spark.createDataFrame([(*m, "k", 3) for m in mails], "conv_id long, turn long, text string, key string, level int")
    made = {(r["conv_id"], r["turn"]): r for r in quotations.link(df).collect()}
    parent = {k: (r["parent_conv"], r["parent_turn"]) for k, r in made.items()}
    assert parent == {(1, 0): (None, None), (1, 1): (1, 0), (1, 2): (1, 1), (1, 3): (1, 0), (2, 0): (1, 2), (2, 1): (None, None), (2, 2): (None, None), (2, 3): (None, None), (2, 4): (None, None)}
    assert made[1, 1]["text"] == "Fine with me." and made[1, 3]["text"] == "Only a part:\nNo, ten." and made[2, 2]["text"] is None
    assert [made[k]["depth"] for k in ((1, 0), (1, 1), (1, 2), (2, 0))] == [0, 1, 2, 3] and (made[2, 0]["root_conv"], made[2, 0]["root_turn"]) == (1, 0)
    assert made[1, 2]["n_quotes"] == made[1, 2]["n_linked"] == 2 and made[2, 1]["n_linked"] == 0
    assert quotations.link(df.limit(0)).count() == 0
    thread = [(r["conv_id"], r["turn"]) for r in quotations.link(df).where("root_conv = 1 AND root_turn = 0").collect()]
    assert all(thread.index(parent[k]) < thread.index(k) for k in thread if parent[k][0] is not None)


def unigram_library(path):
    """The library with the file's model type set to unigram: field 3 of the trainer's field 2."""
    import sentencepiece

    data = bytearray(open(path, "rb").read())

    def number(i):
        n = shift = 0
        while True:
            n, shift, i = n | (data[i] & 127) << shift, shift + 7, i + 1
            if data[i - 1] < 128:
                return n, i

    def fields(i, end):
        while i < end:
            tag, i = number(i)
            start = i
            if tag & 7 == 0:
                _, i = number(i)
            elif tag & 7 == 2:
                n, start = number(i)
                i = start + n
            else:
                i += 4 if tag & 7 == 5 else 8
            yield tag >> 3, start, i

    for f, a, b in fields(0, len(data)):
        if f == 2:
            at = next(x for g, x, _ in fields(a, b) if g == 3)
            data[at] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


def test_maxplus_is_the_best_path(spark):
    """Against all segmentations of a word, and the head of the library's n-best list (its plain encode can score lower)."""
    path = tokenizer("piece_bpe_32k.model")
    library, m, r = unigram_library(path), maxplus.model(path), random.Random(4)
    parts = "the ing tion er an éa ou ver schl os ción x q zz un".split()
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 6))) for _ in range(500)]

    @functools.cache
    def best(t):
        ends = range(1, min(len(t), m.longest) + 1)
        return max((m.of[t[:n]][1] if t[:n] in m.of else m.unknown if n == 1 else -np.inf) + best(t[n:]) for n in ends) if t else 0.0

    made = {x["doc_id"]: x for x in maxplus.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()}
    for i, t in enumerate(texts):
        assert made[i]["score"] == m.total(np.array(made[i]["ids"])) == best(maxplus.MARK + t), t
        assert made[i]["score"] == m.total(np.array(library.nbest_encode_as_ids(t, 2)[0])), t
        assert made[i]["score"] >= m.total(np.array(library.encode(t))), t


def thue_morse(n, a, b):
    """The Thue-Morse word of n letters over a and b, and its complement: equal under polynomials modulo powers of two."""
    at = [0]
    while len(at) < n:
        at += [1 - i for i in at]
    return "".join((a, b)[i] for i in at), "".join((b, a)[i] for i in at)


@pytest.mark.parametrize("n", [1024, 2048])
def test_hashes_tell_thue_morse_words_apart(spark, n):
    p, q = thue_morse(n, "a", "b")
    buf = np.frombuffer((p + q).encode(), np.uint8)
    items = np.array([7 if c == "a" else 9 for c in p + q], np.uint64)
    for seed in (*common.SEEDS, *common.WINDOW_SEEDS):
        x, y = common.span_hashes(buf, np.array([0, n]), np.array([n, 2 * n]), seed)
        assert x != y
        w = common.window_hashes(items, n, seed)
        assert w[0] != w[n]
    same = words(20, 34)
    docs = [(0, f"{same} {p}"), (1, f"{same} {q}"), *[(2 + i, "head\n" + (p if i % 2 else q)) for i in range(8)]]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert {r[0]: tuple(r)[1:] for r in substring_dedup.digest(substring_dedup.remove_repeats(df)).collect()} == substring_dedup.brute_force(docs)
    assert {r[0]: tuple(r)[1:] for r in line_dedup.digest(line_dedup.drop_lines(df)).collect()} == line_dedup.brute_force(docs)
    path = tokenizer("byte_bpe_50k.json")
    library = bpe.encoder(path).library
    made = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, path).collect()}
    assert made == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in docs}
    check_packing(packing.pack(df, path).collect(), docs, 2048)
    pieces = tokenizer("piece_bpe_32k.model")
    encoded = maxplus.encode(df, pieces)
    assert {r["doc_id"]: r["text"] for r in maxplus.decode(encoded, pieces).collect()} == dict(docs)


def test_hashes_are_functions_of_the_bytes():
    r = np.random.default_rng(0)
    text = bytes(r.integers(97, 100, 20_000, dtype=np.uint8))
    starts = r.integers(0, 19_800, 8000)
    ends = starts + r.integers(0, 150, 8000)
    seen = {}
    for a, b, h in zip(starts, ends, common.span_hashes(np.frombuffer(text, np.uint8), starts, ends, common.SEEDS[0]).tolist(), strict=True):
        assert seen.setdefault(text[a:b], h) == h
    assert len(set(seen.values())) == len(seen)
    items = r.integers(0, 3, 3000).astype(np.uint64)
    for n in (1, 2, 3, 18, 35, 64, 70):
        seen = {}
        hashes = common.window_hashes(items, n, common.WINDOW_SEEDS[0]).tolist()
        assert len(hashes) == 3001 - n
        for i, h in enumerate(hashes):
            assert seen.setdefault(tuple(items[i : i + n].tolist()), h) == h
        assert len(set(seen.values())) == len(seen)
    assert len(common.window_hashes(items[:5], 6, 1)) == 0


def test_columns_of_any_name_stay(spark):
    """Columns named like those that the operators add inside, or return."""
    names = ["__chunk", "__chunk_", "chunk", "h", "line", "lang_pred", "score", "rejected", "__id", "__n", "spans", "n_lines"]
    df = spark.createDataFrame([(i, t, *([f"v{i}"] * len(names))) for i, t in rows()[:12]], "doc_id long, text string, " + ", ".join(f"`{x}` string" for x in names))
    for made, own in ((substring_dedup.remove_repeats(df), {"spans"}), (line_dedup.drop_lines(df), {"n_lines"}), (language.classify(df, {"a": b"some text of words"}), {"lang_pred", "score", "rejected"}), (simhash.keep_one(df), set())):
        assert set(df.columns) <= set(made.columns)
        for r in made.collect():
            assert all(r[x] == f"v{r['doc_id']}" for x in names if x not in own)


def test_keep_one_of_rows_with_one_id(spark):
    df = spark.createDataFrame([(1, "b c d e f", "x"), (1, "a c d e f", "y"), (1, "a c d e f", "x"), (2, "q", "z"), (None, "q", "n"), (None, "q", "n")], "doc_id long, text string, source string")
    for _ in range(2):
        made = sorted(map(tuple, simhash.keep_one(df.repartition(3)).where("doc_id IS NOT NULL").collect()))
        groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).where("doc_id IS NOT NULL").collect()}
        assert made == sorted(x for x in [(1, "a c d e f", "x"), (2, "q", "z")] if groups[x[0]] == x[0])
    assert simhash.keep_one(df).where("doc_id IS NULL").count() == 2


def test_language_against_plain_compression(spark):
    """Every text for itself, by a compressor of its own."""
    import zstandard

    r = random.Random(8)
    pools = {"aa": "lorem ipsum dolor sit amet consetetur".split(), "bb": "the quick brown fox jumps over it".split()}
    texts = [(i, " ".join(r.choices(pools[k], k=r.randrange(1, 700))), k) for i, k in enumerate(sorted(pools) * 30)]
    odd = [(100, None, "aa"), (101, "", "bb"), (102, "12 -- 3", None), (103, "ipsum", None), (104, "ÄÖ fox 7", "bb"), (105, "fox", None)]
    df = spark.createDataFrame(texts + odd, "doc_id long, text string, lang string")
    dictionaries = language.learn(df.where("doc_id < 40 OR doc_id > 99"), size=2000)
    assert set(dictionaries) == {"aa", "bb"} and all(0 < len(x) <= 2000 for x in dictionaries.values())
    made = {x["doc_id"]: x for x in language.classify(df, dictionaries).collect()}
    for i, text, _ in texts + odd:
        plain = "".join(c if c.isalpha() else " " for c in text or "")
        if not plain.strip():
            assert (made[i]["lang_pred"], made[i]["score"], made[i]["rejected"]) == ("und", 0.0, True)
            continue
        while "  " in plain:
            plain = plain.replace("  ", " ")
        data = plain.lower().encode()
        size = {k: sum(len(language.compressor(d).compress(data[a : a + 2048] + b" " + data[a : a + 2048])) for a in range(0, len(data), 2048)) for k, d in dictionaries.items()}
        best, other = sorted(size, key=lambda k: (size[k], k))
        margin = 1 - size[best] / size[other]
        assert made[i]["lang_pred"] == best and abs(made[i]["score"] - min(1, 5 * margin)) < 1e-12 and made[i]["rejected"] == (margin < language.LEAST_MARGIN)
        assert len(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionaries[best], dict_type=zstandard.DICT_TYPE_RAWCONTENT)).decompress(language.compressor(dictionaries[best]).compress(data), max_output_size=len(data) + 1)) == len(data)


def test_language_learns_from_blocks_of_whole_texts(spark):
    """A long text is drawn from all over; copies count once; the id has no say."""
    text = " ".join(f"{a}{b}" for a in "abcdefghij" * 300 for b in ("one", "two", "six", "ten"))
    df = spark.createDataFrame([(i, text, "aa") for i in range(50)], "doc_id long, text string, lang string")
    one = language.learn(df, size=3000)
    assert one == language.learn(df.where("doc_id = 7"), size=3000) == language.learn(df.withColumn("doc_id", -df["doc_id"]), size=3000)
    assert 1000 < len(one["aa"]) <= 3000 and language.learn(df.where("doc_id < 0")) == {}
    assert language.learn(df.withColumn("lang", F.lit(None).cast("string"))) == {}


def test_token_counts_of_texts_longer_than_a_chunk(spark):
    """Chunks of the real size, a text without any boundary, and more distinct pre-tokens than the table takes at a time."""
    path = tokenizer("byte_bpe_50k.json")
    texts = [words(31, 40_000, 30_000), "x" * 70_000, ("word " * 9000) + "é" * 40_000, " " * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = bpe.encoder(path).library
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, path).collect()} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_packing_leaves_little_room(spark):
    """Never more than one sequence in fifty over what the tokens need, on lengths of many kinds."""
    r = random.Random(12)
    for size, lengths in ((2048, [r.randrange(1, 2049) for _ in range(3000)]), (2048, [int(r.paretovariate(1.1)) % 2048 + 1 for _ in range(5000)]), (64, [1] * 500 + [63] * 500)):
        counts = {}
        for n in lengths:
            counts[n] = counts.get(n, 0) + 1
        sequences = sum(packs for packs, _ in packing.shortest_pack_first(counts, size))
        assert sequences <= 1.02 * (sum(lengths) / size) + 1
    docs = [(i, words(i, r.randrange(1, 600))) for i in range(400)]
    made = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), tokenizer("byte_bpe_50k.json")).collect()
    n = check_packing(made, docs, 2048)
    assert n <= 1.02 * sum(x["length"] for x in made) / 2048 + 1


def test_neighbours_of_several_lengths_and_large_numbers(spark):
    """Each length gives what it gives alone; components beyond single precision; equal rows count once."""
    schema = "vec_id long, embedding array<double>"
    kinds = [(0, np.random.default_rng(1).standard_normal((300, 8))), (1000, np.random.default_rng(2).standard_normal((40, 5)) * 1e120)]
    data = [(base + i, v.tolist()) for base, x in kinds for i, v in enumerate(x)]
    df = spark.createDataFrame(data + data[:30], schema)
    made = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect():
        made.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for base, x in kinds:
        for q in range(0, len(x), 20):
            d = np.sqrt(np.square(x - x[q]).sum(1))
            d[q] = np.inf
            best = np.lexsort((np.arange(len(x)), d))[:10]
            found = sorted(made[base + q])
            assert len(set(v for _, v, _ in found)) == len(found) == 10
            assert len({v - base for _, v, _ in found} & set(best.tolist())) >= 9
            assert all(s == d[v - base] for _, v, s in found)


def test_dense_cell_of_vectors(spark):
    """Thousands of different vectors around one: all are linked, few rows come out."""
    r = np.random.default_rng(4)
    x = r.standard_normal(64) + 0.1 * r.standard_normal((1500, 64))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    made = lattice.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    assert sum(m["n_links"] for m in made) >= 0.99 * (near.sum() - len(x)) and all(m["component_id"] == 0 for m in made)


def test_largest_of_rows_with_ties():
    r = np.random.default_rng(3)
    for x in (r.standard_normal((50, 240)), r.integers(0, 4, (50, 240)).astype(float), np.zeros((3, 5)), np.zeros((0, 240))):
        at, value = lattice._largest(x.copy(), 4)
        assert (value == -np.sort(-x, axis=1)[:, :4]).all()
        assert (np.take_along_axis(x, at, 1) == value).all() and all(len(set(row)) == 4 for row in at.tolist())


def test_first_meeting_against_all_cells():
    """The smallest cell that both have, one of them as its own."""
    r = np.random.default_rng(4)
    cells = lattice.Cells(64)
    a = lattice._unit(r.standard_normal((300, 64)))
    x, y = cells.of(a), cells.of(lattice._unit(a + 0.06 * r.standard_normal(a.shape)))
    for p, q, met in zip(x, y, lattice._first_meeting(x, y).tolist(), strict=True):
        own_p, own_q = set(p[:, 0].tolist()), set(q[:, 0].tolist())
        shared = {c for c in p.ravel().tolist() if c in set(q.ravel().tolist()) and (c in own_p or c in own_q)}
        assert met == min(shared, default=np.iinfo(np.int64).max)
