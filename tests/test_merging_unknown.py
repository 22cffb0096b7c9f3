"""C-2 on reads with N, and over all reads of the view."""

import os

import pytest
from pyspark.sql import functions as F

from runloom import queries
from runloom.operators import merging
from runloom.views import view

SF = "/root/testdata/sf0.001"


def test_unknown_bases(spark):
    insert = "ACGTTGCAAGGCTTAGCCATACGGATTACAGG"
    turn = lambda s: s.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]
    a, b = insert[:24], turn(insert[8:])
    rows = [
        ("all", "N" * 24, "I" * 24, "N" * 24, "I" * 24),
        ("leading", "NNNN" + a[4:], "I" * 24, b, "I" * 24),
        ("inside", a[:12] + "NNN" + a[15:], "I" * 24, b, "#" * 24),  # a base of low quality wins over N
        ("both", a[:12] + "N" + a[13:], "I" * 24, b[:19] + "N" + b[20:], "#" * 24),
        ("few", a[:10] + "N" * 14, "I" * 24, b, "I" * 24),  # 2 known bases overlap
    ]
    made = {r["name"]: (r["status"], r["seq"], r["insert_length"]) for r in merging.trim_and_merge(spark.createDataFrame(rows, "name string, seq1 string, qual1 string, seq2 string, qual2 string"), "AGATCGGAAGAGC").collect()}
    assert made["all"] == ("unmerged", "N" * 24, None) and made["few"][0] == "unmerged"
    assert made["leading"] == ("merged", "NNNN" + insert[4:], 32)
    assert made["inside"] == ("merged", insert, 32)
    assert made["both"] == ("merged", insert[:12] + "N" + insert[13:], 32)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_every_read_of_the_view_is_counted(spark):
    made = queries.QUERIES["trimmed_and_merged"](spark, SF)
    assert made.agg(F.sum("n")).first()[0] == view(spark, SF, "reads").count()


def plain_merge(seq1, qual1, seq2, qual2, least, most):
    """Base by base, one insert length after another."""
    turned, back = seq2.translate(str.maketrans("ACGTN", "TGCAN"))[::-1], qual2[::-1]
    best, length = 0, 0
    for n in range(least, len(seq1) + len(turned) - least + 1):
        both = [(seq1[i], turned[i - n + len(turned)]) for i in range(min(n, len(seq1))) if 0 <= i - n + len(turned) < len(turned)]
        known = [x for x in both if "N" not in x]
        wrong = sum(x != y for x, y in known)
        if len(known) >= least and wrong <= most * len(known) and len(known) - 3 * wrong > best:
            best, length = len(known) - 3 * wrong, n
    if not length:
        return None
    made = []
    for i in range(length):
        k = i - length + len(turned)
        here = ([(qual1[i], seq1[i])] if i < len(seq1) else []) + ([(back[k], turned[k])] if 0 <= k < len(turned) else [])
        made.append(max([x for x in here if x[1] != "N"] or here))
    return "".join(b for _, b in made), "".join(q for q, _ in made), length


def test_merging_against_a_plain_walk():
    import random

    r = random.Random(1)
    word = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    turn = lambda s: s.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]
    blur = lambda s: "".join(r.choice("ACGTN") if r.random() < 0.04 else c for c in s)
    pairs = [("", "", "", ""), ("ACG", "III", "", "")]
    for _ in range(1500):
        insert, n1, n2 = word(r.randrange(8, 60)), r.choice([20, 24, 30]), r.choice([20, 24])
        a, b = blur((insert + word(40))[:n1]), blur((turn(insert) + word(40))[:n2])
        pairs.append((a, "".join(r.choice("#+5?I") for _ in a), b, "".join(r.choice("#+5?I") for _ in b)))
    made = merging.merge_pairs(*map(list, zip(*pairs, strict=True)), 11, 0.1)
    assert made == [plain_merge(*p, 11, 0.1) for p in pairs] and sum(x is not None for x in made) > 400
