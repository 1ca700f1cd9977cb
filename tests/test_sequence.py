import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions import sequence as seqf
from strandline.functions.alignment import Scoring, align
from strandline.operators.snps import snps


def one(spark, seqs, *columns):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, seq string")
    return [tuple(r)[1:] for r in rows.select("i", *columns).orderBy("i").collect()]


def test_quality_of_each_class(spark):
    seqs = ["ATGAAATAA", "ATGTAAAAATAA", "ATGAAAAAA", "AAAAAATAA", "AAAAAAAAA", "CTGAAATAA", "TTATTTCAT", "ATGAAATA", None, "", "AT"]
    got = [r[0] for r in one(spark, seqs, seqf.quality_class(F.col("seq")))]
    bad = "bad_quality: "
    assert got == ["good_quality", bad + "multiple_stop", bad + "no_stop", bad + "no_start", bad + "no_start_stop", "good_quality", "good_quality", bad + "no_stop", None, bad + "no_start_stop", bad + "no_start_stop"]


def test_direction_stop_translation(spark):
    got = one(spark, ["ATGAAATAA", "TTATTTCAT", "CCC", "ATGANATA"], seqf.direction(F.col("seq")), seqf.first_stop(F.col("seq")), seqf.translate(F.col("seq")), seqf.coding_protein(F.col("seq")))
    assert got == [("forward", 6, "MK*", "MK"), ("reverse", None, "LFH", "MK"), ("Error", None, "P", "-"), ("forward", None, "MX", "-")]


def test_ids(spark):
    got = one(spark, ["locus_12", "7", "x"], seqf.allele_number(F.col("seq")))
    assert got == [(12,), (7,), (None,)]
    assert one(spark, ["gnl|my|contig|x", "plain"], seqf.contig_name(F.col("seq"))) == [("my|contig",), ("plain",)]


def test_final_sequence_on_both_strands(spark):
    gene = "ATGAAACCCTAA"
    got = one(spark, ["GG" + gene + "GG"], seqf.final_sequence(F.col("seq"), F.lit(3), F.lit(11)))
    assert got == [(gene,)]
    back = gene.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert one(spark, ["GG" + back + "GG"], seqf.final_sequence(F.col("seq"), F.lit(14), F.lit(5))) == [(gene,)]
    assert one(spark, ["ATGAAA"], seqf.final_sequence(F.col("seq"), F.lit(1), F.lit(6))) == [(None,)]


def test_snps(spark):
    pairs = spark.createDataFrame([(1, "ATGAAATAA", "ATGAGATAA"), (2, "ATGAAATAA", "ATG-AAA"), (3, "ATG", "ATG"), (4, "TCTAAA", "TGAAAA"), (5, None, "A"), (6, "", "")], "k int, allele_seq string, found_seq string")
    got = [tuple(r) for r in snps(pairs).orderBy("k", "position").collect()]
    assert got == [
        (1, 5, "A/G", "AAA/AGA", "K/R", "Synonymous", "basic / basic"),
        (2, 7, "T/-", "TAA/---", "*/-", "Missense", "Stop codon / -----"),
        (4, 2, "C/G", "TCT/TGA", "S/*", "Nonsense", "polar / Stop codon"),
        (4, 3, "T/A", "TCT/TGA", "S/*", "Nonsense", "polar / Stop codon"),
    ]


@settings(max_examples=60, deadline=None)
@given(st.text("ACGT", max_size=12), st.text("ACGT", max_size=12))
def test_alignment_score_is_the_best(a, b):
    s = Scoring(2, -1, 1, 1)
    first, more = s.gap_open + s.gap_extend, s.gap_extend
    best, low = 0, -99
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    e = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    f = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            e[i][j] = max(h[i - 1][j] - first, e[i - 1][j] - more)
            f[i][j] = max(h[i][j - 1] - first, f[i][j - 1] - more)
            h[i][j] = max(0, h[i - 1][j - 1] + (s.reward if a[i - 1] == b[j - 1] else s.penalty), e[i][j], f[i][j])
            best = max(best, h[i][j])
    got = align(a, b, s)
    assert got.score == best
    assert a[got.a_start :].startswith(got.a.replace("-", "")) and b[got.b_start :].startswith(got.b.replace("-", ""))
    score, gap = 0, None
    for x, y in zip(got.a, got.b, strict=True):
        if "-" in (x, y):
            side = 0 if x == "-" else 1
            score -= more if gap == side else first
            gap = side
        else:
            score += s.reward if x == y else s.penalty
            gap = None
    assert score == best


@pytest.mark.parametrize("seq", ["", "ACGT", "ACGTNRY"])
def test_reverse_complement_twice(spark, seq):
    assert one(spark, [seq], seqf.reverse_complement(seqf.reverse_complement(F.col("seq")))) == [(seq,)]
