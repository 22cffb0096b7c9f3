"""The registered queries on the smallest tables, and the pipeline against brute force."""

import os
import re
import zlib

import numpy as np
import pytest
import xxhash

from runloom.llm import bpe, language, line_dedup, queries, simhash, substring_dedup

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    made = queries.QUERIES[name](spark, SF)
    columns = sorted(made.columns)
    found = c.execute(queries.ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted((repr([r[names.index(k)] for k in columns]) for r in found.fetchall()))
    assert sorted(repr([r[k] for k in columns]) for r in made.collect()) == want


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    raw = {r["doc_id"]: r["text"] for r in docs.collect()}
    dictionaries = language.learn(docs.where(~language.held_out()))
    kept = {r["doc_id"] for r in language.classify(docs, dictionaries).where("NOT rejected").collect()}
    rows = [(i, t) for i, t in raw.items() if i in kept]
    space = " \t\n\v\f\r"
    where = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = line.strip(space)
            where.setdefault("".join(c.lower() if c.isascii() else c for c in k), set()).add(i)

    def keep(i, line):
        k = "".join(c.lower() if c.isascii() else c for c in line.strip(space))
        return len(k) < 40 or len(where[k]) < 5 or i == max(where[k])

    rows = [(i, "\n".join(x for x in (t or "").split("\n") if keep(i, x))) for i, t in rows]
    groups = simhash.brute_force(rows)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    want = substring_dedup.brute_force(rows)
    library = bpe.encoder(queries.tokenizer("byte_bpe_50k.json")).library
    made = p.run(spark, SF).collect()
    assert {r["doc_id"] for r in made} == {i for i, _ in rows}
    tokens = {r["doc_id"]: r["doc_tokens"] for r in made}
    for i, t in rows:
        if want[i][1] == 0:
            assert tokens[i] == len(library.encode(t, add_special_tokens=False).ids) + 1
    sequences = {}
    for r in made:
        sequences[r["sequence_id"]] = sequences.get(r["sequence_id"], 0) + r["length"]
    assert max(sequences.values()) <= 2048 and sum(sequences.values()) == sum(tokens.values())
    assert line_dedup.digest(line_dedup.drop_lines(docs)).count() == len(raw)


def test_held_out_accuracy(spark):
    made = queries.op4_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    test = made.where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in test) >= 0.97 * len(test)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op3_against_library(spark, texts):
    library = bpe.encoder(queries.tokenizer("byte_bpe_50k.json")).library
    made = {r["doc_id"]: r for r in queries.op3_token_counts(spark, SF).collect()}
    assert set(made) == set(texts)
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (made[i]["n_bytes"], made[i]["n_tokens"], made[i]["over_limit"]) == (len(t.encode()), n, n > 512)


def test_op5_against_library(spark, texts):
    library = bpe.encoder(queries.tokenizer("byte_bpe_50k.json")).library
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    made = queries.op5_packing(spark, SF).collect()
    whole, places = {i: 0 for i in ids}, {}
    for r in made:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        whole[r["doc_id"]] += r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert whole == {i: len(x) for i, x in ids.items()}
    for pieces in map(sorted, places.values()):
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False)) and sum(n for _, n in pieces) <= 2048
    assert len(places) <= 1.02 * sum(map(len, ids.values())) / 2048 + 1


def plain_fingerprint(text):
    """Bit by bit, over shingles made by a pattern."""
    parts = re.findall(rb"[^ \t-\r]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))
    shingles = [b" ".join(parts[k : k + 4]) for k in range(max(1, len(parts) - 3))] if parts else []
    hashes = [xxhash.xxh64(x, seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op6_against_all_pairs(spark, texts):
    made = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, SF).collect()}
    ids = sorted(texts)
    fp = [plain_fingerprint(texts[i]) for i in ids]
    label = {i: i for i in ids}
    changed = True
    near = [(a, b) for x, a in enumerate(ids) for y, b in enumerate(ids[:x]) if (fp[x] ^ fp[y]).bit_count() <= 4]
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert made == {i: (f"{fp[k]:016x}", label[i]) for k, i in enumerate(ids)}


def test_op8_gives_back_the_texts(spark, texts):
    made = {r["doc_id"]: r for r in queries.op8_maxplus(spark, SF).collect()}
    assert {i: r["text_crc32"] for i, r in made.items()} == {i: zlib.crc32(t.encode()) for i, t in texts.items()}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_op9_recall(spark, sf):
    """Recall at 10 against brute force, by id, and exact scores."""
    folder = f"/root/testdata/{sf}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows = sorted((i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    made = {}
    for r in queries.op9_neighbours(spark, folder).collect():
        made.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    place = {i: k for k, i in enumerate(ids.tolist())}
    assert set(made) == {i for i in ids.tolist() if i % 100 == 0}
    hit = 0
    for q, found in made.items():
        d = np.sqrt(np.square(x - x[place[q]]).sum(1))
        d[place[q]] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and all(abs(s - d[place[v]]) <= 1e-12 * s for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hit += len(best & {v for _, v, _ in found})
    assert hit >= 0.9 * 10 * len(made)


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    """Nulls, repeated rows, ties and no rows at all go through every stage."""
    import corpus_pipeline as p

    good = "the house of the old man stood on the hill and the wind came over the sea to it " * 3
    rows = [(i, good + f"number {i} " * (i % 5), "en" if i % 2 else None, None, None) for i in range(12)]
    rows += [rows[3], (20, None, "en", "s", 1), (21, "", None, "s", 0), (22, " \n ", "en", "s", 3), (None, good, "en", "s", 5), (None, None, None, None, None), (23, "12 34", "en", "s", 5)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for k, data in enumerate((rows, [])):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in p.STAGES[:-1]:
            before = docs
            docs = stage(spark, docs, folder)
            assert docs.columns == p.COLUMNS, name
            assert docs.count() <= before.count()
        assert sum(r["length"] for r in p.run(spark, folder).collect()) >= (1 if data else 0)
