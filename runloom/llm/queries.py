"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, language, lattice, license_scan, line_dedup, maxplus, neighbours, packing, phrases, quotations, simhash, substring_dedup, token_counts


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.digest(substring_dedup.remove_repeats(docs))


def op2_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as mails that quote the turns before, and linked again."""
    linked = quotations.link(quotations.as_mail(_read(spark, sf_dir, "conversations")))
    return linked.select("conv_id", "turn", "parent_conv", "parent_turn", "root_conv", "root_turn", "depth", "n_quotes", "n_linked", F.md5("text").alias("own_md5"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    dictionaries = language.learn(docs.where(~F.col("held_out")))
    found = language.classify(docs.select("doc_id", "text", "held_out"), dictionaries)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.digest(line_dedup.drop_lines(docs))


def op8_maxplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("piece_bpe_32k.model")
    return maxplus.digest(maxplus.encode(_read(spark, sf_dir, "documents"), path), "doc_id", path)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_read(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(_read(spark, sf_dir, "conversations"))
    return conversation_repair.digest(conversation_repair.repair(damaged))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quotations": op2_quotations,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_maxplus": op8_maxplus,
    "op9_neighbours": op9_neighbours,
    "op10_lattice_dedup": op10_lattice_dedup,
    "op11_collocations": op11_collocations,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_repair": op13_conversation_repair,
}

OP1_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 33, 1))) AS i, w FROM d),
k AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM r) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(gone, j)), lambda j: w[j]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS line FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN h USING (key) GROUP BY doc_id"""

OP2_SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, min(text) AS text FROM conversations GROUP BY ALL),
k AS (SELECT *, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS key FROM m),
f AS (SELECT conv_id, key, min(turn) AS first FROM k GROUP BY ALL),
p AS (SELECT m.conv_id, m.turn, m.text, f.first AS parent, (q.key IS NOT NULL)::BIGINT + (r.key IS NOT NULL)::BIGINT AS n
  FROM m LEFT JOIN k q ON q.conv_id = m.conv_id AND q.turn = m.turn - 1 AND q.key <> ''
  LEFT JOIN k r ON r.conv_id = m.conv_id AND r.turn = m.turn - 2 AND r.key <> ''
  LEFT JOIN f ON f.conv_id = m.conv_id AND f.key = q.key),
t AS (SELECT conv_id, turn, turn AS root, CAST(0 AS BIGINT) AS depth FROM p WHERE parent IS NULL
  UNION ALL SELECT p.conv_id, p.turn, t.root, t.depth + 1 FROM p JOIN t ON p.conv_id = t.conv_id AND p.parent = t.turn)
SELECT p.conv_id, p.turn, CASE WHEN parent IS NOT NULL THEN p.conv_id END AS parent_conv, parent AS parent_turn,
  p.conv_id AS root_conv, t.root AS root_turn, t.depth, n AS n_quotes, n AS n_linked, md5(text) AS own_md5
FROM p JOIN t ON p.conv_id = t.conv_id AND p.turn = t.turn"""

OP10_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM (SELECT x AS vec_id, min(y) AS c FROM r GROUP BY x) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)"""


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(x, '[\x20\x09]+'), lambda y: y <> '') AS w FROM p),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, w[i : i + m - 1] AS p FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) x(m))) GROUP BY ALL HAVING count(*) >= 100),
i AS (SELECT lang, q[i : i + m - 1] AS p, f FROM (SELECT lang, p AS q, f, m, unnest(range(1, len(p) - m + 2)) AS i FROM f, range(2, 5) x(m) WHERE len(p) > m)),
c AS (SELECT lang, p, max(f) AS longer FROM i GROUP BY ALL),
k AS (SELECT f.lang, f.p, f.f AS a, unnest(range(1, len(f.p))) AS k FROM f LEFT JOIN c USING (lang, p) WHERE len(f.p) > 1 AND (longer IS NULL OR 100 * longer < 100 * f.f)),
s AS (SELECT k.lang, k.p, a, l.f AS l, r.f AS r, n, k, (1000 * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.p = k.p[1 : k] JOIN f r ON r.lang = k.lang AND r.p = k.p[k + 1 :] JOIN t ON t.lang = k.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS cut FROM s),
o AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score, k, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM b WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score, k FROM o WHERE rank <= 2000"""

#: Of a phrase's edits + 1 pieces a place of it holds one unchanged, so blocks of words without any are left out.
OP12_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT * FROM (VALUES BASE_NOTICES) t(label, phrase)),
f AS (SELECT *, len(string_split(phrase, ' ')) AS size FROM (VALUES FUZZY_NOTICES) t(label, phrase, most)),
g AS (SELECT doc_id, start, w[start + 1 : start + 48] AS w FROM (SELECT doc_id, w, unnest(range(0, len(w), 32)) AS start FROM d) WHERE regexp_matches(array_to_string(w[start + 1 : start + 48], ' '), 'PIECES')),
p AS (SELECT doc_id, start, w, unnest(range(1, least(len(w), 32) + 1)) AS i FROM g),
x AS (SELECT doc_id, start + i - 1 AS i, label FROM p JOIN b ON array_to_string(w[i : i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
y AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM x GROUP BY doc_id),
r AS (SELECT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS run FROM (SELECT doc_id, w, i, unnest(range(1, least(17, len(w) - i + 1) + 1)) AS k FROM p)),
c AS (SELECT doc_id, label, phrase, most, run FROM r JOIN (SELECT *, unnest(range(greatest(1, size - most), size + most + 1)) AS k FROM f) USING (k) WHERE abs(strlen(run) - length(phrase)) <= most),
z AS (SELECT doc_id, label, (length(phrase) - levenshtein(run, phrase)) / length(phrase) AS score FROM c WHERE levenshtein(run, phrase) <= most),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM (SELECT doc_id, label, score FROM z UNION ALL SELECT doc_id, label, 1.0 FROM x) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN y USING (doc_id) LEFT JOIN l USING (doc_id)""".replace("BASE_NOTICES", ", ".join(f"('{n.label}', '{n.phrase}')" for n in license_scan.BASE)).replace(
    "FUZZY_NOTICES", ", ".join(f"('{n.label}', '{n.phrase}', {n.edits})" for n in license_scan.FUZZY)
).replace("PIECES", "|".join(sorted({x for n in license_scan.BASE + license_scan.FUZZY for _, x in license_scan.seeds(n)})))

#: Forward over the rows: the cheapest edits, ASCII-least first, into each of the four states; the repaired rows follow from the edits.
OP13_SQL = r"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
k AS (SELECT *, xor(4294967295, list_reduce(list_transform(range(1, length(key) + 1), lambda i: ord(key[i])::BIGINT),
    lambda x, b: list_reduce(range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(x, b)), 4294967295::BIGINT)) % 20 AS k FROM d),
r AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid FROM r),
f AS (SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before, 'u' = role[1] AS u, 'a' = role[1] AS a, 's' = role[1] AS s FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
t(conv_id, i, x0, x1, x2, x3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {'c': 0::BIGINT, 'e': ''}, NULL::STRUCT(c BIGINT, e VARCHAR), NULL::STRUCT(c BIGINT, e VARCHAR), NULL::STRUCT(c BIGINT, e VARCHAR) FROM conversations
  UNION ALL
  SELECT conv_id, i, {'c': w0.c + 2, 'e': w0.e || 'D'},
    list_min(list_filter([{'c': w1.c + 2, 'e': w1.e || 'D'}, CASE WHEN stays AND s THEN {'c': w0.c + extra, 'e': w0.e || 'K'} END], lambda y: y.c IS NOT NULL)),
    list_min(list_filter([{'c': w2.c + 2, 'e': w2.e || 'D'}, CASE WHEN stays THEN {'c': m.c + extra + 1, 'e': m.e || 'R'} END, CASE WHEN stays AND u THEN {'c': m.c + extra, 'e': m.e || 'K'} END], lambda y: y.c IS NOT NULL)),
    list_min(list_filter([{'c': w3.c + 2, 'e': w3.e || 'D'}, CASE WHEN stays THEN {'c': w2.c + extra + 1, 'e': w2.e || 'R'} END, CASE WHEN stays AND a THEN {'c': w2.c + extra, 'e': w2.e || 'K'} END], lambda y: y.c IS NOT NULL))
  FROM (SELECT *, list_min(list_filter([w0, w1, w3], lambda y: y.c IS NOT NULL)) AS m FROM (
    SELECT t.conv_id, t.i + 1 AS i, f.u, f.a, f.s, f.fault IN ('', 'truncated') AS stays, CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra, x0 AS w0, x1 AS w1,
      list_min(list_filter([x2, {'c': x0.c + 5, 'e': x0.e || 'I'}, {'c': x1.c + 5, 'e': x1.e || 'I'}, {'c': x3.c + 5, 'e': x3.e || 'I'}], lambda y: y.c IS NOT NULL)) AS w2,
      list_min(list_filter([x3, {'c': x2.c + 5, 'e': x2.e || 'I'}, {'c': x0.c + 10, 'e': x0.e || 'II'}, {'c': x1.c + 10, 'e': x1.e || 'II'}], lambda y: y.c IS NOT NULL)) AS w3
    FROM t JOIN f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i + 1))),
b AS (SELECT conv_id, list_min(list_filter([x0, x3, {'c': x2.c + 5, 'e': x2.e || 'I'}, {'c': x0.c + 10, 'e': x0.e || 'II'}, {'c': x1.c + 10, 'e': x1.e || 'II'}], lambda y: y.c IS NOT NULL)) AS z
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM t) WHERE back = 1),
e AS (SELECT *, sum((edit <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY j) AS i FROM (SELECT conv_id, z.e[j] AS edit, j FROM (SELECT conv_id, z, unnest(range(1, length(z.e) + 1)) AS j FROM b))),
h AS (SELECT e.conv_id, j, edit, f.role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text, row_number() OVER (PARTITION BY e.conv_id ORDER BY j) AS o, first_value(edit = 'K' AND f.s) OVER (PARTITION BY e.conv_id ORDER BY j) AS led
  FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND edit <> 'I' WHERE edit <> 'D'),
q AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS repaired FROM h GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, z.c AS cost, z.e AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM b LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM b.conv_id"""

ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op2_quotations": OP2_SQL, "op7_line_dedup": OP7_SQL, "op10_lattice_dedup": OP10_SQL, "op11_collocations": OP11_SQL, "op12_license_scan": OP12_SQL, "op13_conversation_repair": OP13_SQL}
