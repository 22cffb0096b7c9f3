"""Phrases, licences and conversation repair: awkward rows and random ones against brute force."""

import hashlib
import random

import numpy as np
import pytest

from runloom.llm import bpe, conversation_repair, license_scan, maxplus, phrases
from runloom.llm.queries import tokenizer


@pytest.fixture
def small(monkeypatch):
    """Bounds so small that every way beyond them is taken."""
    for name, value in (("TRIE_PHRASES", 23), ("LIKELY_HASHES", 50), ("BLOCK_BYTES", 1000), ("HELD_HASHES", 200), ("RANGE_HASHES", 20)):
        monkeypatch.setattr(phrases, name, value)


def phrase_rows():
    rng = random.Random(4)
    words = ["a", "b", "c", "A", "d", "é", "the", "of", "x"]
    text = lambda: " ".join(rng.choice(words) + rng.choice(["", "", "", "", ",", ".", "\n"]) for _ in range(rng.randint(0, 300)))
    rows = [(rng.choice([None, "", text(), text()]), rng.choice(["en", "de", None])) for _ in range(60)]
    return rows + [("x x x x x x x x\tx  x" * 9, "xx")] * 2 + [(None, "yy"), (" .\n", "yy")]


@pytest.mark.parametrize("bounds", ["large", "small"])
def test_phrases(spark, request, bounds):
    if bounds == "small":
        request.getfixturevalue("small")
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "other", 1) for r in rows], "text string, lang string, phrase string, k int").repartition(5)
    made = phrases.collocations(docs, least=7, top=50).collect()
    assert sorted(map(tuple, made)) == phrases.brute_force(rows, least=7, top=50)


def test_words_of_many_blocks(spark):
    """However many blocks hold a word, it is one row when the frequent words are chosen, and no join of blocks with words is made."""
    rows = [("the cat the dog", "en"), ("der Hund the", "de")] * 16
    encoded = phrases.encode(spark.createDataFrame(rows, "text string, lang string").repartition(16), "text", "lang", 0)
    assert encoded.count() > 2
    made = phrases._words(encoded)
    assert sorted((r["lang"], r["word"], r["f"]) for r in made.collect()) == [("de", "der", 16), ("de", "hund", 16), ("de", "the", 16), ("en", "cat", 16), ("en", "dog", 16), ("en", "the", 32)]
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()


def test_phrases_of_nothing(spark):
    schema = "text string, lang string"
    assert phrases.collocations(spark.createDataFrame([], schema)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en"), ("a b c", "en")], schema)).collect() == []


def test_long_text_is_cut_between_pieces_only(monkeypatch, spark):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 50)
    rows = [("alpha beta gamma " * 40 + ". " + "alpha beta. " * 100, "en")]
    made = phrases.collocations(spark.createDataFrame(rows, "text string, lang string"), least=20).collect()
    assert sorted(map(tuple, made)) == phrases.brute_force(rows, least=20)


def test_double_array():
    rng = random.Random(1)
    words = [rng.getrandbits(62) for _ in range(40)]
    known = list({tuple(rng.choice(words) for _ in range(3)) for _ in range(500)})
    trie = phrases.Trie(np.array(known, np.int64))
    known = list(map(tuple, trie.phrases.tolist()))

    text = np.array([w for _ in range(400) for w in (rng.choice(known) if rng.random() < 0.5 else [rng.choice(words)] * 2 + [7])], np.int64)
    for at, state in trie.run(trie.letter_codes(text), 3):
        pass
    found = {(int(a), known[trie.phrase[s]]) for a, s in zip(at, state, strict=True) if trie.phrase[s] >= 0}
    want = {(i, tuple(text[i : i + 3].tolist())) for i in range(len(text) - 2)}
    assert found == {x for x in want if x[1] in set(known)}


def mutated(rng, phrase, edits):
    letters, out = "abcdefghij  klmnopqrstuvwxyz0é", list(phrase)
    for _ in range(edits):
        i, kind = rng.randrange(len(out) + 1), rng.random()
        if kind < 0.35:
            del out[i : i + 1]
        elif kind < 0.7:
            out.insert(i, rng.choice(letters))
        else:
            out[i : i + 1] = [rng.choice(letters)]
    return "".join(out)


def test_licences_within_edits():
    rng = random.Random(5)
    scanner = license_scan.scanner(license_scan.BASE + license_scan.FUZZY)
    for _ in range(250):
        some = [rng.choice(license_scan.BASE + license_scan.FUZZY) for _ in range(rng.randint(1, 2))]
        text = rng.choice([" ", ". ", " x", "-"]).join(mutated(rng, n.phrase, rng.randint(0, n.edits + 1)) for n in some)
        plain, found = license_scan.plain(text.encode()), {}
        for i, edits, a, b in scanner(plain):
            n = scanner.notices[i]
            assert license_scan.distance(plain[a:b].encode("latin-1"), n.phrase.encode()) == edits
            found[n] = min(found.get(n, edits), edits)
        assert found == license_scan.brute_force(text), text


def test_licences_rows(spark):
    long = "word, " * 200_000
    rows = [
        (1, "Released under the MIT-License; Released under the MIT license!", "a"),
        (2, None, "b"),
        (3, "", "c"),
        (4, "CC BY-NC cc by nc xcc by nc", "d"),
        (5, long + "Licenced under the Apache Licence, Version 2.0." + long, "e"),
        (6, "under the mit licenses", "f"),
        (6, "under the mit licenses", "f"),
        (None, "nothing of the kind", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    made = license_scan.scan(docs)
    assert made.columns == ["doc_id", "text", "n_words", "hits"]
    by_id = {r["doc_id"]: r for r in made.collect()}
    hits = by_id[5]["hits"]
    assert [(h["label"], h["edits"], h["first_word"], h["end_word"]) for h in hits] == [("apache", 2, 200_000, 200_005)]
    assert rows[4][1].encode()[hits[0]["begin"] : hits[0]["end"]] == b"Licenced under the Apache Licence"
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.digest(made).collect()}
    assert got[1] == (10, 2, 1, 6, "mit", "mit", 1.0)
    assert got[2] == got[3] == (0, 0, None, None, "", "", 0.0)
    assert got[4] == (9, 2, 0, 3, "cc-by-nc", "cc-by-nc", 1.0)
    assert got[6][1:4] == (0, None, None)
    assert got[None] == (4, 0, None, None, "", "", 0.0)
    assert license_scan.scan(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        license_scan.scanner((license_scan.Notice("x", "abc", 2),))


def solved(rows):
    seen, items = set(), []
    for _, role, text in rows:
        solid = text.strip(conversation_repair.SPACE)
        forced = not solid or (role, text) in seen
        seen.add((role, text))
        items.append(conversation_repair._row(int(forced), role, not forced and solid[-1] not in ".!?"))
    return conversation_repair.solve(items)[0]


@pytest.mark.parametrize("segment", [64, 5, 2])
def test_cheapest_edits(monkeypatch, segment):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(600):
        rows = [(i, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["", " ", "a.", "b", f"d?{i}", f"e{i}.", f"f{i}!"])) for i in range(rng.randint(0, 14))]
        assert solved(rows) == conversation_repair.brute_force(rows)[1]


def test_long_run_of_one_role():
    rows = [(i, "user", f"{i}.") for i in range(400)]
    assert solved(rows) == conversation_repair.brute_force(rows)[1]


def repaired(rows, audit):
    left, out, last = iter(rows), [], ""
    for e in audit:
        _, role, text = (None, None, "") if e == "I" else next(left)
        if e == "D":
            continue
        role = role if e == "K" else "assistant" if last == "u" else "user"
        last = role[0]
        out.append(f"{role}:{text}")
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("long_rows", [4096, 20])
def test_repair_rows(spark, monkeypatch, long_rows):
    """Both ways, for conversations that fit one task and for those that do not."""
    monkeypatch.setattr(conversation_repair, "LONG_ROWS", long_rows)
    rng = random.Random(3)
    pick = lambda i: (rng.choice([None, 1, 2, 3]), rng.choice([None, *range(60)]), rng.choice([None, "", "user", "assistant", "system", "tool", "usher"]), rng.choice([None, "", " x ", "a.", "b!", "d?\n", "é", f"w.{i % 50}"]))
    rows = [pick(i) for i in range(300)] + [(77, None, None, None)] * 3 + [(8, 5, "user", "same.")] * 60
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, edit string")
    made = {r["conv_id"]: r for r in conversation_repair.digest(conversation_repair.repair(turns)).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert set(made) == set(by_conv)
    for conv, x in by_conv.items():
        x.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        cost, audit = conversation_repair.brute_force(x)
        given = sorted({t for t, _, _ in x if t is not None})
        gaps = given[-1] - given[0] + 1 - len(given) if given else 0
        assert (made[conv]["cost"], made[conv]["audit"], made[conv]["gaps"], made[conv]["repaired_sha256"]) == (cost, audit, gaps, repaired(x, audit))


def test_repair_of_nothing(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert conversation_repair.digest(conversation_repair.repair(spark.createDataFrame([], schema))).collect() == []
    gone = spark.createDataFrame([("a", 1, "user", "x.", 0)], schema + ", copies int")
    row = conversation_repair.digest(conversation_repair.repair(gone)).first()
    assert tuple(row) == ("a", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_very_long_texts_are_repaired(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "LONG_BYTES", 1 << 20)
    rows = [(1, 0, "user", "q " * 600_000 + "?"), (1, 1, "assistant", "a " * 600_000)]
    made = conversation_repair.digest(conversation_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert (made["audit"], made["cost"], made["truncated"]) == ("DD", 4, 1)


def test_every_code_point():
    """Ids equal the library's for texts of all code points, beside letters, digits, marks and spaces."""
    encoder, points = bpe.encoder(tokenizer("byte_bpe_50k.json")), [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a".join(map(chr, points[i : i + 16])) + " 1" + "".join(map(chr, points[i + 16 : i + 32])) + "! " for i in range(0, len(points), 32)]
    for a in range(0, len(texts), 4000):
        part = texts[a : a + 4000]
        ids, n = encoder.encode([t.encode() for t in part])
        ends = np.cumsum(n)
        for t, e, k in zip(part, ends.tolist(), n.tolist(), strict=True):
            assert list(ids[e - k : e]) == encoder.library.encode(t, add_special_tokens=False).ids, ascii(t)


def test_ids_do_not_depend_on_chunks(spark):
    """Operator 8 on texts full of ties, and on given ones: one rule for whole and cut texts."""
    rng, path = random.Random(1), tokenizer("piece_bpe_32k.model")
    rows = [(i, "".join(rng.choice(["a", "aa", "ab", "aba", " ", "  ", "aaaa", "the"]) for _ in range(500))) for i in range(20)]
    rows += [(100 + i, "a" * rng.randint(300, 500) + "ba" * 200) for i in range(5)] + [(200, "no" * 20 + " " * 90 + "é" * 80), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text").where("length(text) < 8000")).repartition(4)
    whole = {r["doc_id"]: r["ids"] for r in maxplus.encode(docs, path, chunk=1 << 20).collect()}
    m = maxplus.model(path)
    for i, t in rows:
        text = (" " + t).replace(" ", maxplus.MARK) if t else ""
        assert whole[i] == m.path(text, m.forward(text, 0, len(text)), 0, len(text))
    for chunk in (37, 300, 16 << 10):
        assert {r["doc_id"]: r["ids"] for r in maxplus.encode(docs, path, chunk=chunk).collect()} == whole
