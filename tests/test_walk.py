"""The alignment walk over random reads against a plain one, and the tables from one scan against exploded bases."""

import random

import pytest
from pyspark.sql import functions as F
from test_reads import walk as plain_walk

from runloom.operators import alignment
from runloom.plans import control_profile

SCHEMA = "name string, mapped boolean, reverse boolean, first_mate boolean, second_mate boolean, paired boolean, nm int, pos int, cigar string, md string, seq string, qual string"


def made_up(n, seed):
    """Reads with a CIGAR and an MD that fit: deletions of MD stand where the CIGAR has them."""
    r, rows = random.Random(seed), []
    for k in range(n):
        cigar, md, length, run = "", "", 0, 0
        if r.random() < 0.3:
            s = r.randint(1, 3)
            cigar, length = f"{s}S", s
        for part in range(r.randint(1, 4)):
            if part:
                d = r.randint(1, 3)
                if r.random() < 0.5:
                    cigar += f"{d}D"
                    md, run = md + f"{run}^" + "".join(r.choice("ACGT") for _ in range(d)), 0
                else:
                    cigar, length = cigar + f"{d}I", length + d
            m = r.randint(1, 12)
            cigar, length = cigar + f"{m}{r.choice('MMM=X')}", length + m
            for _ in range(m):
                if r.random() < 0.2:
                    md, run = md + f"{run}{r.choice('ACGTN')}", 0
                else:
                    run += 1
        md += str(run)
        seq = "".join(r.choice("ACGTN") for _ in range(length))
        rows.append((f"r{k}", True, r.random() < 0.5, r.random() < 0.5, r.random() < 0.5, r.random() < 0.8, r.choice([None, 0, 2, 3]), r.randint(0, 50), cigar, md, seq, "".join(chr(33 + r.randint(0, 41)) for _ in range(length))))
    return rows


def test_random_reads(spark):
    rows = made_up(400, 7) + [("none", True, False, True, False, True, 0, 0, None, "4", "ACGT", "IIII"), ("short", True, False, True, False, True, 0, 0, "4M", "4", "ACGT", "III"), ("empty", True, False, True, False, True, 0, 0, "", "", "", ""), ("inside", True, False, True, False, True, 0, 5, "4M", "2^A2", "ACGT", "IIII")]
    made = {}
    for x in alignment.explode_alignment(spark.createDataFrame(rows, SCHEMA)).orderBy("name", "i").collect():
        made.setdefault(x["name"], []).append((x["op"], x["ref"], x["ref_pos"]))
    want = {}
    for x in rows[:400]:
        want[x[0]] = [(op, ref, at) for op, ref, at in plain_walk(x[7], x[8], x[9], x[10])]
    assert made == want


def both_ways(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "MOST_MASKED", most)
    reads = spark.createDataFrame(made_up(500, 11), SCHEMA).repartition(3)
    mask = spark.createDataFrame([(p,) for p in [*range(0, 60, 7), None, 7]], "pos int")
    return reads, mask, alignment.base_counters(reads, mask, by_length=True)


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_counters_equal_exploded_bases(spark, monkeypatch, most):
    reads, mask, counters = both_ways(spark, monkeypatch, most)
    bases = alignment.explode_alignment(reads)
    free = alignment.masked(bases, mask)
    rows = lambda df: sorted(repr(sorted(r.asDict().items())) for r in df.collect())
    assert rows(alignment.cycle_error(counters, 50)) == rows(alignment.cycle_error(bases, 50))
    assert rows(alignment.substitutions(counters)) == rows(alignment.substitutions(bases, alignment.cycle()))
    assert rows(alignment.end_substitutions(counters, 5)) == rows(alignment.end_substitutions(bases, 5))
    for by in (None, alignment.by_base(), alignment.by_cycle()):
        for most_edits in (None, 2):
            assert rows(alignment.observed_predicted(counters, by, most_edits)) == rows(alignment.observed_predicted(free, by, most_edits))


def test_tables_of_one_scan(spark, monkeypatch):
    reads, mask, counters = both_ways(spark, monkeypatch, 1_000_000)
    tables = control_profile.control_tables(reads, None, mask)
    got = {(r["table"], r["cycle"], r["base"], r["ref"], r["q"]): (r["matches"], r["mismatches"], r["few_matches"], r["few_mismatches"]) for r in tables.collect()}
    for table, by in (("A4", []), ("A5", alignment.by_base()), ("A6", alignment.by_cycle())):
        few = {tuple(r[c] for c in ("cycle", "base") if c in r) + (r["q"],): (r["matches"], r["mismatches"]) for r in alignment.observed_predicted(counters, by, 2).where("matches + mismatches > 0").collect()}
        for r in alignment.observed_predicted(counters, by).where("matches + mismatches > 0").collect():
            r = r.asDict()
            key = tuple(r[c] for c in ("cycle", "base") if c in r) + (r["q"],)
            assert got[table, r.get("cycle"), r.get("base"), None, r["q"]] == (r["matches"], r["mismatches"], *few.get(key, (0, 0)))
    for r in alignment.cycle_error(counters, 50).where("matches + mismatches > 0").collect():
        assert got["A2", r["cycle"], None, None, None][:2] == (r["matches"], r["mismatches"])
    kinds = {(r["cycle"], r["type"]): r["n"] for r in alignment.substitutions(counters).collect() if r["n"]}
    assert {(c, f"{ref}>{base}"): v[1] for (t, c, base, ref, _), v in got.items() if t == "A3" and base != ref} == kinds
    unrun = control_profile.control_tables(spark.createDataFrame(made_up(9, 1), SCHEMA), None, mask)
    plan = unrun._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 1


def test_first_mates_then_second(spark):
    reads = spark.createDataFrame([("a", True, False, True, False, True, 0, 0, "4M", "4", "ACGT", "IIII"), ("a", True, True, False, True, True, 0, 0, "4M", "4", "ACGT", "IIII")], SCHEMA)
    made = alignment.base_counters(reads, first_read_cycles=10).groupBy("cycle").agg(F.sum("n").alias("n")).collect()
    assert {r["cycle"]: r["n"] for r in made} == {**{c: 1 for c in (1, 2, 3, 4)}, **{c: 1 for c in (11, 12, 13, 14)}}


def test_observed_qualities_walk_the_reads_once(spark):
    counted = alignment.observed_predicted(alignment.base_counters(spark.createDataFrame(made_up(9, 1), SCHEMA)), max_nm=2)
    assert counted._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [r["q"] for r in counted.orderBy("q").collect()] == list(range(counted.count()))


@pytest.mark.parametrize("held", [0, 20, 512])
def test_bases_beyond_the_array_are_counted_too(spark, monkeypatch, held):
    monkeypatch.setattr(alignment, "HELD_PLACES", held)
    odd = [("odd", True, True, True, False, True, 1, 3, "4M", "1R2", "ACXT", "~I~!")]
    reads = spark.createDataFrame(made_up(200, 5) + odd, SCHEMA).repartition(2)
    keys = ["cycle", "base", "ref", "q", "few_edits", "paired"]
    strand = lambda c: F.when(F.col("reverse"), F.translate(c, "ACGT", "TGCA")).otherwise(F.col(c)).alias(c)
    bases = alignment.explode_alignment(reads).where("op = 'M'").select(alignment.cycle().alias("cycle"), "read_length", strand("base"), strand("ref"), "q", F.coalesce(F.col("nm") <= 2, F.lit(False)).alias("few_edits"), "paired")
    for by_length in (False, True):
        by = [*keys, "read_length"] if by_length else keys
        want = sorted(map(tuple, bases.groupBy(*by).agg(F.count("*").alias("n")).collect()))
        assert sorted(map(tuple, alignment.base_counters(reads, by_length=by_length).groupBy(*by).agg(F.sum("n").alias("n")).collect())) == want


def test_totals_of_operations_equal_exploded_bases(spark):
    reads = spark.createDataFrame(made_up(300, 9) + [("short", True, False, True, False, True, 0, 0, "4M", "4", "ACGT", "III"), ("null", True, None, True, False, True, 0, 5, "2S4M", "1A2", "ACGTNN", "IIIIII")], SCHEMA).repartition(3)
    bases = alignment.explode_alignment(reads)
    want = bases.groupBy("op").agg(F.count("*"), F.count_if("is_match"), F.count_if(~F.col("is_match")), F.sum(alignment.cycle()), F.sum("ref_pos"), F.sum("q"))
    made = alignment.operation_totals(reads)
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want.collect()))
    assert alignment.operation_totals(reads.where("name = 'short'")).count() == 0


@pytest.mark.parametrize("bin", [8, 30, 256])
def test_a_large_mask_is_joined_to_reads(spark, monkeypatch, bin):
    monkeypatch.setattr(alignment, "MASK_BIN", bin)
    reads, mask, counters = both_ways(spark, monkeypatch, 3)
    # Only reads that may be longer than a stretch are exploded: two walks, of which one has no read here.
    keys = [c.split()[0] for c in alignment.COUNTERS.split(", ")][:-1]
    rows = lambda df: sorted(map(tuple, df.groupBy(*keys).agg(F.sum("n")).collect()))
    monkeypatch.setattr(alignment, "MOST_MASKED", 1_000_000)
    assert rows(counters) == rows(alignment.base_counters(reads, mask, by_length=True))
    if bin == 256:
        assert "__masked" in counters._jdf.queryExecution().optimizedPlan().toString()
