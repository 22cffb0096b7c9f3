"""Hand-worked cases of the operators on reads, and a plain walk over alignments."""

import random
import re

import pytest
from pyspark.sql import functions as F

from runloom.functions import quality, sequence
from runloom.operators import alignment, demultiplex, flags, groups, indices, merging, profiles, runs, tiles

ALIGNED = "name string, mapped boolean, reverse boolean, first_mate boolean, second_mate boolean, paired boolean, nm int, pos int, cigar string, md string, seq string, qual string"


def one(df):
    return df.first().asDict()


def test_quality_and_complexity(spark):
    df = spark.createDataFrame([("ACGT", "IIII"), ("", ""), (None, None), ("NNNN", "####"), ("AAAC", "!!!!")], "seq string, qual string")
    made = [tuple(r) for r in df.select(F.round(quality.expected_error(), 9), F.round(sequence.entropy(), 6), sequence.max_frequency(), F.round(quality.log10_likelihood(), 6)).collect()]
    assert made[0] == (0.0001, 2.0, 0.25, round(4 * -4.3431619e-05, 6)) and made[1][:3] == (None, None, None) and made[2] == (None,) * 4
    assert made[3][1:3] == (None, None) and made[4][0] == round(10**-0.2, 9) and made[4][1:3] == (0.811278, 0.75)  # quality 0 counts as 2


def test_flags(spark):
    df = spark.createDataFrame([("ACGT", "IIII", False), ("", "", None), ("NNNN", "IIII", False), ("AAAA", "!!!!", True)], "seq string, qual string, failed_qc boolean")
    made = flags.flag_reads(df, entropy=1.0, min_length=1).collect()
    assert [r["fails_error"] for r in made] == [False, False, False, True]  # an empty read has no error and passes that test
    assert [r["fails_entropy"] for r in made] == [False, True, True, True] and [r["fails_length"] for r in made] == [False, True, False, False]
    assert [r["failed_qc"] for r in flags.flag_reads(df, max_error=None).collect()] == [False, False, False, True]
    assert not any(r["failed_qc"] for r in flags.flag_reads(df, max_error=None, reset=True).collect())
    report = one(flags.filter_report(flags.flag_reads(df, entropy=1.0)))
    assert report["n_total"] == 4 and report["n_failed_before"] == 1 and report["n_error"] == 1 and report["n_entropy"] == 3
    for bad in ({"entropy": 1.0, "frequency": 0.5}, {"entropy": 2.5}, {"frequency": 1.5}):
        with pytest.raises(ValueError):
            flags.flag_reads(df, **bad)


@pytest.mark.parametrize("most", [50_000, 20])
def test_kth_smallest(spark, monkeypatch, most):
    monkeypatch.setattr(flags, "MOST_SORTED", most)
    r = random.Random(1)
    values = [r.randrange(50) / 7 for _ in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    good = sorted(v for v in values if v is not None)
    for k in (0, 1, 150, 1500, 2999, 3000, 9999):
        assert flags.kth_smallest(df, "x", k) == good[min(k, 2999)]
    assert flags.kth_smallest(df.limit(0), "x", 3) is None


def walk(pos, cigar, md, seq):
    """(op, ref, ref_pos) of every read base, one base at a time."""
    cols, p = [], pos
    for t in re.findall(r"\d+|\^[A-Z]+|[A-Z]", md):
        if t[0] == "^":
            p += len(t) - 1
            continue
        for k in range(int(t) if t.isdigit() else 1):
            cols.append(("=" if t.isdigit() else t, p))
            p += 1
    out, i, c = [], 0, 0
    for n, op in re.findall(r"(\d+)([MIDNSHPX=])", cigar):
        if op in "DNHP":
            continue
        for _ in range(int(n)):
            if op in "M=X":
                ref, at = cols[c]
                out.append(("M", seq[i] if ref == "=" else ref, at))
                c += 1
            else:
                out.append((op, None, cols[c][1] if c < len(cols) else cols[-1][1] + 1))
            i += 1
    return out


CASES = [
    ("32M", "10A5C15", 32), ("4S28M", "28", 32), ("10M2I20M", "30", 32), ("16M3D16M", "16^ACG16", 32), ("5M1I2D6M3S", "5^AC0G5", 15), ("3H4M1D2I4M2H", "4^T0A3", 10),
    ("2S3M", "0A1G0", 5), ("4M2D4M1I1M", "2C1^GG3T1", 10), ("6=1X3=", "6T3", 10), ("3M1P1I3M", "6", 7), ("1I4M", "4", 5), ("4M3S", "4", 7), ("2M1D2M1D2M", "2^A2^C2", 6),
]


def test_alignment_walk(spark):
    r = random.Random(2)
    rows = []
    for k, (cigar, md, n) in enumerate(CASES):
        seq = "".join(r.choice("ACGT") for _ in range(n))
        rows.append((f"r{k}", True, k % 2 == 0, True, False, True, 1, 10 * k, cigar, md, seq, "I" * n))
    rows += [("bad1", True, False, True, False, True, 0, 0, "5M", "4", "ACGTA", "IIIII"), ("bad2", True, False, True, False, True, 0, 0, "4M", "4", "ACGTA", "IIIII"), ("un", False, False, True, False, True, 0, 0, "4M", "4", "ACGT", "IIII"), ("no", True, False, True, False, True, 0, 0, None, None, "ACGT", "IIII")]
    df = spark.createDataFrame(rows, ALIGNED)
    made = {}
    for x in alignment.explode_alignment(df).orderBy("name", "i").collect():
        made.setdefault(x["name"], []).append((x["op"], x["ref"], x["ref_pos"]))
    want = {x[0]: walk(x[7], x[8], x[9], x[10]) for x in rows[: len(CASES)]}
    assert made == want
    with pytest.raises(Exception, match="does not fit"):
        alignment.explode_alignment(df, strict=True).collect()
    assert df.where("name = 'r2'").select(alignment.cigar_operations()).first()[0] == "M" * 10 + "II" + "M" * 20


def test_strands_and_counters(spark):
    rows = [("f", True, False, True, False, True, 1, 100, "4M", "1C2", "AAGN", "IIII"), ("r", True, True, True, False, True, 9, 200, "4M", "4", "ACGT", "IIII")]
    bases = alignment.explode_alignment(spark.createDataFrame(rows, ALIGNED))
    error = {x["cycle"]: (x["matches"], x["mismatches"], x["error_pct"]) for x in alignment.cycle_error(bases, 5).collect()}
    assert error == {1: (2, 0, 0.0), 2: (1, 1, 50.0), 3: (2, 0, 0.0), 4: (1, 0, 0.0), 5: (0, 0, None)}  # N neither matches nor not; cycle 5 is empty
    kinds = {(x["cycle"], x["type"]): x["n"] for x in alignment.substitutions(bases, alignment.cycle()).where("n > 0").collect()}
    assert kinds == {(2, "C>A"): 1}
    seen = {x["q"]: (x["matches"], x["mismatches"]) for x in alignment.observed_predicted(bases).collect()}
    assert len(seen) == 41 and seen[40] == (6, 1) and seen[3] == (0, 0)
    assert {x["q"]: x["matches"] for x in alignment.observed_predicted(bases, max_nm=2).collect()}[40] == 2
    assert {(x["base"], x["matches"]) for x in alignment.observed_predicted(bases, alignment.by_base()).collect()} == {("A", 2), ("C", 1), ("G", 2), ("T", 1)}
    mask = spark.createDataFrame([(101,)], "pos int")
    assert alignment.masked(bases, mask).where("name = 'f'").count() == 3
    counted = spark.createDataFrame([(1, 10, 90, 10), (2, 20, 5, 0)], "cycle int, q int, matches long, mismatches long")
    assert abs(one(alignment.quality_rmse(counted))["rmse"] - abs(10 - 10 * 1.0043213737826426)) < 1e-9


def test_groups_and_profiles(spark):
    reads = spark.createDataFrame([("a", "RG1", True, False, "AC", "II"), ("b", None, True, False, "AC", "II"), ("c", "control1", True, True, "GG", "##")], "name string, rg string, mapped boolean, failed_qc boolean, seq string, qual string")
    head = spark.createDataFrame([("RG1",), ("RG2",)], "rg string")
    assert {tuple(r) for r in groups.group_counts(reads, head).collect()} == {("RG1", 1), ("RG2", 0), ("unknown", 1), ("control1", 1)}
    tally = spark.createDataFrame([("RG1", "pass", 300_000), ("RG2", "pass", 2_000_000), ("RG3", "fail", 900_000), ("control", "pass", 900_000), ("TOTAL", "pass", 9_000_000), ("", "pass", 900_000), ("RG4", "pass", 200_000)], "rg string, status string, n_mapped long")
    assert {r["rg"]: r["fraction"] for r in groups.retained_groups(tally).collect()} == {"RG1": 1.0, "RG2": 0.5}
    kept = groups.subsample(spark.createDataFrame([(f"n{i}", True, "RG2") for i in range(2000)], "name string, mapped boolean, rg string"), groups.retained_groups(tally)).count()
    assert 900 < kept < 1100
    assert {r["mean_q"]: r["n"] for r in profiles.quality_per_read(reads).collect()} == {40: 2, 2: 1}
    assert one(profiles.kernel_density(spark.createDataFrame([(0.0, 2), (0.0, 1)], "q double, n long"), "q", "n", [0.0]))["density"] == pytest.approx(0.3989422804)


def test_pairs(spark):
    df = spark.createDataFrame([("a", True, True, False, "AC", "II"), ("a", True, False, True, "GT", "II"), ("b", True, True, False, "AC", "II"), ("c", False, False, False, "AC", "II")], "name string, paired boolean, first_mate boolean, second_mate boolean, seq string, qual string")
    assert profiles.mate_pairs(df).count() == 1 and [tuple(r) for r in profiles.unpaired_mates(df).collect()] == [("b", "second")]


def test_indices(spark):
    book = spark.createDataFrame([("p7", "1", "ACGTACG"), ("p5", "9", "TTTTTTT"), ("p7", "2", "CCCCCCC"), ("p7", "2", "CCCCCCC")], "kind string, id string, seq string")
    sheet = spark.createDataFrame([("S1", "1", "9"), ("S 2", "7", None), ("S3", None, "8")], "name string, p7 string, p5 string")
    assert {r["name"]: (r["p7_seq"], r["p5_seq"]) for r in indices.lookup(sheet, book).collect()} == {"S1": ("ACGTACG", "TTTTTTT"), "S 2": (None, None), "S3": (None, None)}
    assert {(r["name"], r["problem"]) for r in indices.invalid(sheet, book).collect()} == {("S 2", "unknown p7"), ("S3", "unknown p5"), ("S3", "missing p7"), ("S 2", "illegal name"), (None, "duplicate p7")}
    assert indices.with_controls(sheet, indices.control_sequences(spark, 7)).count() == 7
    assert indices.exclude_controls(spark.createDataFrame([("control1",), ("unknown",), ("S",)], "name string")).count() == 1
    reads = spark.createDataFrame([("ACGT",), (None,)], "xi string")
    assert indices.control_reads(reads, ["ACGT"]).count() == 1
    with pytest.raises(Exception, match="no index"):
        indices.control_reads(reads, ["ACGT"], strict=True).collect()


def test_demultiplex(spark):
    sheet = spark.createDataFrame([("A", "ACGTACG", None), ("B", "TTTTTTT", None), ("C", "TTTTTTA", None)], "name string, p7_seq string, p5_seq string")
    reads = spark.createDataFrame([("1", "ACGTACG", "IIIIIII"), ("2", "ACGTACC", "IIIIIII"), ("3", "GGGGGGG", "IIIIIII"), ("4", "TTTTTTN", "IIIIII!")], "name string, xi string, yi string").withColumns({"xj": F.lit(None).cast("string"), "yj": F.lit(None).cast("string"), "failed_qc": F.lit(False)})
    made = {r["name"]: (r["sample"], r["assignment"], r["failed_qc"]) for r in demultiplex.assign(reads, sheet).collect()}
    assert made["1"] == ("A", "assigned", False) and made["2"] == ("A", "assigned", False) and made["3"] == (None, "unknown", True) and made["4"][1] == "conflict" and made["4"][2]


def test_merging(spark):
    insert, adapter = "ACGTTGCAAGGCTTAGCCATACGGATTACA", "AGATCGGAAGAGC"
    turn = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    a, b = (insert + adapter)[:36], (turn(insert) + adapter)[:36]
    rows = [("m", a, "I" * 36, b, "I" * 36), ("u", "A" * 36, "I" * 36, "CA" * 18, "I" * 36), ("s", insert[:20] + adapter, "I" * 33, None, None), ("e", adapter, "I" * 13, None, None), ("c", "TACACA" + "G" * 10, "I" * 16, None, None)]
    made = {r["name"]: r for r in merging.trim_and_merge(spark.createDataFrame(rows, "name string, seq1 string, qual1 string, seq2 string, qual2 string"), adapter, chimeras=["TACACA"]).collect()}
    assert (made["m"]["status"], made["m"]["seq"], made["m"]["insert_length"]) == ("merged", insert, 30)
    assert made["u"]["status"] == "unmerged" and made["s"]["seq"] == insert[:20] and made["e"]["status"] == "empty" and made["c"]["status"] == "chimera"
    keyed = spark.createDataFrame([("k", "GG" + a, "I" * 38, b, "I" * 36), ("x", a, "I" * 36, b, "I" * 36)], "name string, seq1 string, qual1 string, seq2 string, qual2 string")
    assert {r["name"]: r["status"] for r in merging.trim_and_merge(keyed, adapter, key1="GG").collect()} == {"k": "merged", "x": "no_key"}


def test_tiles_and_runs(spark):
    counts = tiles.tile_counts(spark.createDataFrame([(1, 1101, 102, 100.0), (1, 1101, 103, 80.0), (1, 1102, 102, 0.0), (1, 1101, 100, 5.0)], "lane int, tile int, code int, value double"))
    row = one(tiles.lane_stats(counts))
    assert (row["n_tiles"], row["mean_clusters"], row["sd_clusters"], row["mean_pf_pct"]) == (2, 50.0, 50.0, 80.0)
    assert one(spark.createDataFrame([([3.0, 1.0, 2.0, 9.0],)], "v array<double>").select(tiles.upper_median(F.col("v")).alias("m")))["m"] == 3.0
    ids = spark.createDataFrame([("120101_M1_0042_X",), ("nonsense",)], "run_id string")
    made = {r["run_id"]: r for r in runs.retention(ids.withColumns(runs.run_fields(F.col("run_id"))), F.lit("2012-08-01").cast("date")).collect()}
    assert str(made["120101_M1_0042_X"]["run_date"]) == "2012-01-01" and made["120101_M1_0042_X"]["experiment"] == "M1_0042_X" and made["120101_M1_0042_X"]["retention"] == "drop_intensities"
    assert made["nonsense"]["run_date"] is None and made["nonsense"]["retention"] == "keep"
    events = spark.createDataFrame([("r", 1, "started", 0), ("r", 1, "completed", 1), ("r", 1, "progress", 0), ("r", 2, "started", 0)], "run_id string, lane int, marker string, proc int")
    assert {r["lane"]: (r["status"], r["n_done"]) for r in runs.lane_status(events).collect()} == {1: ("completed", 1), 2: ("started", 0)}


def test_index_candidates_are_all_pairs_within_the_distance(spark):
    import random

    from runloom.operators import demultiplex

    r = random.Random(3)
    word = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    samples = [(f"s{i}", word(r.choice([6, 7])), None if i % 4 == 0 else word(7)) for i in range(20)]
    near = lambda s: "".join(r.choice("ACGTN") if r.random() < 0.15 else c for c in s)
    reads = [(near(a)[: r.choice([5, 7, 7])], "IIIIIII", near(b or word(7)), "IIIIIII") for _, a, b in samples * 8] + [(None, None, samples[1][2], "IIIIIII"), ("", "", None, None), ("ACGTACGTAC", "I" * 10, "ACGT", "IIII")]
    reads = sorted(set(reads), key=repr)
    far = lambda x, y: sum(a != b for a, b in zip(x or "", y or "", strict=False))
    for most in (0, 1, 2):
        made = demultiplex.candidates(spark.createDataFrame(reads, "xi string, yi string, xj string, yj string"), spark.createDataFrame(samples, "sample string, s7 string, s5 string"), most)
        want = [(*x, *s) for x in reads for s in samples if far(x[0], s[1]) + (0 if s[2] is None else far(x[2], s[2])) <= most]
        assert sorted(map(tuple, made.collect()), key=repr) == sorted(want, key=repr)


def test_samples_are_found_where_the_reads_are(spark):
    sheet = spark.createDataFrame([("A", "ACGTACG", "TTTTTTT"), ("B", "ACGTACG", None), ("C", "ÄCGTACG", None)], "name string, p7_seq string, p5_seq string")
    reads = spark.createDataFrame([("1", "ACGTACG", "IIIIIII", "TTTTTTT", "IIIIIII"), ("2", "ÄCGTACT", "IIIIIII", "GGGGGGG", "IIIIIII"), ("3", None, None, "TTTTTTA", "IIIIIII")], "name string, xi string, yi string, xj string, yj string").withColumn("failed_qc", F.lit(False))
    made = demultiplex.assign(reads, sheet, max_mismatches=1)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    rows = {r["name"]: r for r in made.collect()}
    assert (rows["1"]["sample"], rows["1"]["second_sample"], rows["1"]["assignment"]) == ("B", "A", "conflict")
    assert (rows["2"]["sample"], rows["2"]["second_sample"], rows["2"]["assignment"]) == ("C", None, "assigned")
    assert rows["3"]["sample"] is not None and set(made.columns) == {*reads.columns, "sample", "second_sample", "quality", "ratio", "assignment"}
    # Grouped and filtered, the search is made once for each reading.
    assert demultiplex.unassigned(made)._jdf.queryExecution().optimizedPlan().toString().count("near(") == 1


def test_sums_over_reads_are_made_by_arrays(spark):
    import math

    texts = ["", None, "I", "!~Ié", "5" * 40, "+5?I" * 500, *["I5+"[: i % 4] for i in range(40)]]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, seq string, qual string")
    made = df.select("i", quality.total().alias("t"), quality.expected_error().alias("e"), quality.log10_likelihood().alias("l"))
    assert "ArrowEvalPython" in made._jdf.queryExecution().executedPlan().toString()
    e = lambda c: math.pow(10.0, -max(ord(c) - 33, 2) / 10.0)
    for r in made.collect():
        t = texts[r["i"]]
        if t is None:
            assert (r["t"], r["e"], r["l"]) == (None, None, None)
            continue
        total = logs = 0.0
        for c in t:
            total, logs = total + e(c), logs + math.log10(1 - e(c))
        assert r["t"] == sum(ord(c) - 33 for c in t) and r["e"] == (total / len(t) if t else None) and r["l"] == logs


def test_mixed_names_are_refused(spark):
    rows = [("a", True, True, False, "AC", "II"), ("a", False, False, False, "GT", "II"), ("b", True, True, False, "AC", "II"), ("b", True, False, True, "AC", "II")]
    df = spark.createDataFrame(rows, "name string, paired boolean, first_mate boolean, second_mate boolean, seq string, qual string")
    with pytest.raises(Exception, match="paired and unpaired"):
        profiles.mate_pairs(df).collect()
    assert profiles.mate_pairs(df.where("name = 'b'")).count() == 1


def test_mates_are_dealt_out_once_and_deep_names_are_joined(spark, monkeypatch):
    r = random.Random(4)
    rows = [(r.choice([None, "a", "b", "c", "d", "e", "f"]), True, r.random() < 0.6, r.random() < 0.5, r.choice([None, "AC", "ACG"]), f"q{i}") for i in range(60)] + [("u", False, True, False, "AC", "II"), ("g", True, True, False, "AC", "II")]
    df = spark.createDataFrame(rows, "name string, paired boolean, first_mate boolean, second_mate boolean, seq string, qual string")
    want = sorted((a[0], a[4], a[5], b[4], b[5], len(a[4]) == len(b[4])) for a in rows for b in rows if a[0] and a[0] == b[0] and a[1] and b[1] and a[2] and b[3] and a[4] and b[4])
    made = profiles.mate_pairs(df)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, made.select("name", "seq1", "qual1", "seq2", "qual2", "equal_length").collect())) == want
    monkeypatch.setattr(profiles, "DEEP", 9)
    assert sorted(map(tuple, profiles.mate_pairs(df).select("name", "seq1", "qual1", "seq2", "qual2", "equal_length").collect())) == want
    with pytest.raises(Exception, match="paired and unpaired"):
        profiles.mate_pairs(df.unionByName(df.where("name = 'a'").withColumn("paired", F.lit(False)))).collect()


def test_readings_without_index_are_unknown(spark):
    sheet = spark.createDataFrame([("S1", "ACGTACG", None), ("S2", "TTTTACG", None)], "name string, p7_seq string, p5_seq string")
    reads = spark.createDataFrame([("none", None, None, None, None, False), ("empty", "", "", None, None, False), ("good", "ACGTACG", "IIIIIII", None, None, False)], "name string, xi string, yi string, xj string, yj string, failed_qc boolean")
    done = demultiplex.assign(reads, sheet)
    assert {r["name"]: (r["sample"], r["assignment"]) for r in done.collect()} == {"none": (None, "unknown"), "empty": (None, "unknown"), "good": ("S1", "assigned")}
    assert {(r["xi"], r["assignment"], r["n"]) for r in demultiplex.unassigned(done).collect()} == {(None, "unknown", 1), ("", "unknown", 1)}
    assert {(r["kind"], r["value"], r["n"]) for r in demultiplex.distributions(done).collect()} == {("quality", 80, 1)}


def test_header_groups_get_an_empty_output(spark, tmp_path):
    reads = spark.createDataFrame([("a", "RG1"), ("b", None)], "name string, rg string")
    groups.split_by_group(reads, str(tmp_path / "out"), spark.createDataFrame([("RG1",), ("RG9",)], "rg string"))
    assert {p.name for p in (tmp_path / "out").glob("rg=*")} == {"rg=RG1", "rg=unknown", "rg=RG9"}
    assert spark.read.parquet(str(tmp_path / "out" / "rg=RG9")).count() == 0


def test_quality_cells(spark, monkeypatch):
    """Counted by arrays: awkward reads give the cells that a plain walk gives, and no base is a row."""
    from collections import Counter

    from runloom.operators import profiles

    rows = [("ACGTN", "I5!~I", "AC", "II", "GT", "!I", False), ("ACG", "II", "A", None, None, "I", None), (None, "II", "AC", "I", "", "", True), ("", "", "T", "IÄ", "AÄC", "III", False), ("ÄCG", "IIÄ", "TT", "II", "TT", "II", True), ("A" * 5000, "I" * 5000, None, None, None, None, True)]
    want = Counter()
    for seq, qual, xi, yi, xj, yj, second in rows:
        for s, q, offset in [(seq, qual, 39 if second else 0), *([] if second else [(xi, yi, 32), (xj, yj, 71)])]:
            want.update((offset + i, b, ord(c) - 33) for i, (b, c) in enumerate(zip(s or "", q or "", strict=False), 1) if b in "ACGT" and 0 <= ord(c) - 33 <= 50)
    reads = spark.createDataFrame(rows, "seq string, qual string, xi string, yi string, xj string, yj string, second_mate boolean").repartition(2)
    made = profiles.quality_histogram(reads, 32, 7, 32)
    assert {(r["cycle"], r["base"], r["q"]): r["n"] for r in made.collect()} == want
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()


def test_density_makes_its_values_once(spark):
    from pyspark.sql import functions as F

    from runloom.operators import profiles

    values = spark.createDataFrame([(None,), (0.001,), (0.5,), (0.01,), (0.0,)], "v double").select(F.aggregate(F.array("v"), F.lit(0.0), lambda s, q: s + q).alias("x"))
    made = profiles.density(values, "x", 0.01)
    assert {r["bin"]: (r["n"], round(r["density"], 6)) for r in made.collect()} == {0: (1, 1250.0), 5: (1, 1250.0), 49: (2, 2500.0)}
    assert profiles.density(values.where("x IS NULL"), "x", 0.01).collect() == []
    assert made._jdf.queryExecution().optimizedPlan().toString().count("aggregate(array(") == 1
