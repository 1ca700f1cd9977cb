import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import calling, distance, hits, representatives, schema, typing
from strandline.operators.align import similarity_join

TURN = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(TURN)[::-1]


MATRIX = {
    "s1": ["1", "2", "3", "4", "5"],
    "s2": ["1", "LNF", "3", "4", "INF_l_1_0"],
    "s3": ["NIPH", "NIPHEM", "PLOT_1", "LNF_3", "5"],
    "s4": ["1", "2", "7", "4", None],
}


@pytest.fixture()
def calls(spark):
    return spark.createDataFrame([(s, f"l{i}", t) for s, ts in MATRIX.items() for i, t in enumerate(ts)], "sample string, locus string, tag string")


def test_hamming(calls):
    got = {(r.sample_1, r.sample_2): r.distance for r in distance.hamming(calls).collect()}
    for a, x in MATRIX.items():
        for b, y in MATRIX.items():
            assert got[a, b] == sum(p != q for p, q in zip(x, y, strict=True))
    assert len(got) == 16


def test_filters(calls):
    rule = distance.MissingFilter(sample_threshold=20, locus_threshold=30)
    left = distance.filtered(calls, rule)
    assert {r.sample for r in left.collect()} == {"s1", "s2", "s4"}
    assert {r.locus for r in left.collect()} == {"l0", "l2", "l3", "l4"}
    report = distance.filter_report(calls, "sample", rule).collect()
    assert [tuple(r) for r in report] == [("s3", "1/5", "2/5", "1/5", 80.0)]
    kept = distance.filtered(calls, distance.MissingFilter(sample_threshold=100))
    assert kept.count() == 20
    assert distance.filter_samples(calls, distance.MissingFilter(paralog=False, lnf=False, plot=False)).count() == 20
    assert distance.hamming(calls.filter("false")).count() == 0


def test_schema_operators(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("ACGT") for _ in range(200))
    rows = [("a", "1", long, 0), ("a", "2", long[40:140], 1), ("a", "3", long, 2), ("a", "4", long[5:12], 3), ("b", "1", long[40:140], 0), ("b", "2", "ATGAAATAA", 1), ("b", "3", "", 2)]
    alleles = spark.createDataFrame(rows, "locus string, allele_id string, seq string, ord int")
    pairs = {tuple(r) for r in schema.subset_pairs(alleles).collect()}
    want = {(x[0], x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and y[2] and len(y[2]) < len(x[2]) and y[2] in x[2]}
    assert pairs == want and len(want) == 4
    assert [(r.locus, r.ids) for r in schema.duplicate_groups(alleles).collect()] == [("a", ["1", "3"])]
    kept = {(r.locus, r.allele_id) for r in schema.filter_schema(alleles, subsets=True, duplicates=True).collect()}
    assert kept == {("a", "1"), ("b", "1"), ("b", "2"), ("b", "3")}
    modes = {r.locus: r.mode for r in schema.length_mode(alleles).collect()}
    assert modes == {"a": 200, "b": 100}
    stats = {r.locus: r for r in schema.length_stats(alleles.filter("allele_id = '1'")).collect()}
    assert stats["a"].stdev == 0.0 and stats["a"].mean == 200
    assert schema.variability_text(alleles).filter("locus = 'b'").first().variability == "0: 1, 9: 1, 100: 1"
    assert schema.quality_counts(alleles).filter("locus = 'b'").first().good_quality == 1
    assert sum(r.n for r in schema.mode_bins(schema.summary(alleles)).collect()) == 2


def test_overlap_fold(spark):
    rows = [("p", 1, "c", 10, 20), ("p", 2, "c", 15, 30), ("p", 3, "c", 5, 40), ("p", 4, "d", 12, 14), ("p", 5, "c", 21, 22), ("p", 6, "c", 50, 45)]
    h = spark.createDataFrame(rows, "k string, o int, contig string, s int, e int")
    kept = sorted(r.o for r in hits.overlap_dedupe(h, ["k"], ["o"], "contig", "s", "e").collect())
    assert kept == [1, 3, 4, 6]


def test_flank_and_location(spark):
    row = spark.createDataFrame([("AACCGGTTAC",)], "c string")
    got = row.select(hits.flank(F.col("c"), F.lit(3), F.lit(4), 1), hits.flank(F.col("c"), F.lit(9), F.lit(10), 100), hits.located(F.col("c"), F.lit("GT-TA")), hits.located(F.col("c"), F.lit("GTAA")), hits.located(F.col("c"), F.lit("GGGG"))).first()
    assert tuple(got) == ("ACCG", "AACCGGTTAC", 6, 7, None)


def test_predicted_gene(spark):
    h = spark.createDataFrame([("s", "c", 100, 50), ("s", "c", 500, 600)], "sample string, contig string, cstart int, cend int")
    g = spark.createDataFrame([("s", "c", 40, 110, "X"), ("s", "c", 90, 300, "Y")], "sample string, contig string, gene_start int, gene_end int, gene_seq string")
    got = {r.cstart: r.predicted_seq for r in hits.predicted_gene(h, g).collect()}
    assert got[100] == "X" and "not found" in got[500]


@pytest.fixture(scope="module")
def genomes(spark):
    """One sample for each case of the decision list, by planted alleles in random flanks."""
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))

    def gene(n):
        while True:
            body = ["".join(rng.choice("ACGT") for _ in range(3)) for _ in range(n)]
            if not {"TAA", "TAG", "TGA"} & set(body):
                return "ATG" + "".join(body) + "TAA"

    def swap(s, at):
        return s[:at] + {"A": "C", "C": "G", "G": "C", "T": "C"}[s[at]] + s[at + 1 :]

    a = gene(60)
    b = swap(a, 30)
    alleles = [("x", "1", a, 0), ("x", "2", b, 1)]
    early = a[:90] + "TAA" + a[93:]
    late = a[:-3] + "CCC" * 12 + "TAA"
    cases = {
        "exact": [letters(300) + a + letters(300)],
        "reverse": [letters(300) + rc(a) + letters(300)],
        "two_exact": [letters(300) + a + letters(300), letters(300) + a + letters(300)],
        "tandem": [letters(300) + a + letters(400) + a + letters(300)],  # both copies are located at the first
        "exact_and_variant": [letters(300) + a + letters(400) + swap(swap(b, 61), 120) + letters(300)],
        "inferred": [letters(300) + swap(a, 100) + letters(300)],
        "shorter": [letters(300) + early + letters(300)],
        "longer": [letters(300) + late + letters(300)],
        "edge": [letters(300) + a[:130]],
        "absent": [letters(700)],
    }
    contigs = [(name, f"c{i}", seq) for name, seqs in cases.items() for i, seq in enumerate(seqs)]
    return spark.createDataFrame(alleles, "locus string, allele_id string, seq string, ord int"), spark.createDataFrame(contigs, "sample string, contig string, seq string")


def test_calls_end_to_end(spark, genomes):
    alleles, contigs = genomes
    config = calling.CallConfig(percent_length=10, coverage=50)
    calls = calling.call_alleles(alleles, alleles.filter("allele_id = '1'"), contigs, config).cache()
    kinds = {r.sample: r.kind for r in calls.collect()}
    tags = {r.sample: r.tag for r in calls.collect()}

    want = {"exact": "EXACT", "reverse": "EXACT", "two_exact": "NIPHEM", "tandem": "EXACT", "exact_and_variant": "NIPH", "inferred": "INF", "shorter": "ASM", "longer": "ALM", "edge": "PLOT", "absent": "LNF"}
    assert kinds == want | {"longer": kinds["longer"]} and kinds["longer"] in ("ALM", "INF", "EXACT")
    assert tags["exact"] == "1" and tags["inferred"] == "INF_x_1_0" and tags["edge"] == "PLOT_1" and tags["absent"] == "LNF"
    assert calls.count() == 10

    grown = calling.updated_schema(alleles.withColumn("description", F.lit("")), calls)
    new = grown.filter("allele_id = '3'").collect()
    assert len(new) >= 1 and new[0].description == "inferred"
    quality = schema.schema_info(alleles).select("locus", "allele_id", "quality")
    for kind in ("exact", "paralog", "inferred", "asm", "alm", "plot", "lnf_tpr"):
        calling.report(calls, kind, quality).collect()
    assert calling.report(calls, "paralog", quality).count() == 4
    assert calling.report(calls, "exact", quality).filter("quality = 'good_quality'").count() >= 2
    assert calling.matching_contigs(calls).filter("sample = 'reverse'").first().direction == "-"
    assert calling.snp_rows(calls, alleles).filter("sample = 'inferred'").count() == 1
    inferred = calling.report(calls, "inferred", quality).filter("sample = 'inferred'").first()
    assert (inferred.mismatch, inferred.gaps) == (1, 0)
    seqs = {r.sample: r.seq for r in contigs.collect()}
    genes = spark.createDataFrame([("inferred", "c0", 310, 400, "part"), ("inferred", "c0", 301, 486, "whole"), ("inferred", "c0", 600, 700, "far")], "sample string, contig string, gene_start int, gene_end int, gene_seq string")
    assert calling.report(calls, "inferred", quality, genes=genes).filter("sample = 'inferred'").first().predicted_sequence == "whole"
    assert "not found" in calling.report(calls, "exact", quality, genes=genes).filter("sample = 'exact'").first().predicted_sequence
    for kind in ("exact", "paralog", "inferred", "asm", "alm", "plot"):
        assert calling.report(calls, kind, quality, genes=genes).count() == calling.report(calls, kind, quality).count()
    own = {r.allele_id: r.seq for r in alleles.collect()}
    dna = {r.row: r for r in calling.alignment_rows(calls, alleles, config).filter("sample = 'inferred'").collect()}
    assert dna["sample"].sequence == seqs["inferred"][300:486] and dna["schema"].sequence == own[dna["schema"].allele]
    assert dna["match"].sequence.count(".") == 1 and len(dna["match"].sequence) == 186
    protein = {r.row: r.sequence for r in calling.protein_rows(calls, alleles, config).filter("sample = 'inferred'").collect()}
    assert set(protein) == {"sample", "match", "schema"} and protein["sample"].startswith("M") and len(protein["sample"]) == 62
    dear = calling.CallConfig(reward=2, penalty=-3, gap_open=5, gap_extend=2)
    assert (dear.search_scoring.first, dear.call_scoring.first) == (7, 5)
    summed = {r.sample: r for r in calling.summary(calls).collect()}
    assert summed["absent"]["LNF"] == 1 and summed["exact"]["Exact match"] == 1
    calls.unpersist()


def test_similarity_join_reports_coordinates(spark, genomes):
    alleles, contigs = genomes
    got = {r.sample: r for r in similarity_join(alleles.filter("allele_id = '1'"), contigs.filter("sample IN ('exact', 'reverse')")).collect()}
    assert (got["exact"].sstart, got["exact"].send, got["exact"].pident, got["exact"].length) == (301, 486, 100.0, 186)
    assert (got["reverse"].sstart, got["reverse"].send) == (486, 301)
    assert got["reverse"].sseq == got["exact"].sseq


def test_representatives(spark, genomes):
    alleles, _ = genomes
    d = {(r.id_1, r.id_2): r.distance for r in representatives.word_distances(alleles).collect()}
    assert d["1", "1"] == 0 and 0 < d["1", "2"] < 0.05 and d["1", "2"] == d["2", "1"]
    chosen = representatives.centroids(representatives.word_distances(alleles), alleles).collect()
    assert [(r.allele_id, r.good) for r in chosen] == [("2", True)]
    assert [r.allele_id for r in representatives.reference_alleles(alleles).collect()] == ["2"]


def test_sketches_against_all_words(spark):
    """Distances of sketches lie within a few standard errors of those of all words, and are the same where a sketch holds all."""
    rng = random.Random(9)
    base = "".join(rng.choice("ACGT") for _ in range(3000))
    rows = [("x", "0", base), ("x", "short", base[:15]), ("x", "none", None), ("y", "0", base)]
    for k, share in enumerate((0.0005, 0.002, 0.01, 0.03), 1):
        rows.append(("x", str(k), "".join(rng.choice("ACGT") if rng.random() < share else c for c in base)))
    alleles = spark.createDataFrame(rows, "locus string, allele_id string, seq string")
    exact = {(r.id_1, r.id_2): r.distance for r in representatives.near_distances(alleles).collect()}
    whole = {(r.id_1, r.id_2): r.distance for r in representatives.sketch_distances(alleles, size=10**6).collect()}
    assert whole.keys() == exact.keys() and all(abs(whole[p] - d) < 1e-12 for p, d in exact.items())
    for pair, d in {(r.id_1, r.id_2): r.distance for r in representatives.sketch_distances(alleles, size=500).collect()}.items():
        j = math.exp(-21 * exact[pair]) / (2 - math.exp(-21 * exact[pair]))
        found = math.exp(-21 * d) / (2 - math.exp(-21 * d))
        assert abs(found - j) < 5 * math.sqrt(j * (1 - j) / 500) + 1e-9


def test_types(spark):
    profiles = spark.createDataFrame([("1", 0, "a", "1"), ("1", 0, "b", "2"), ("2", 1, "a", "1"), ("2", 1, "b", "N"), ("3", 2, "a", "1"), ("3", 2, "b", "2")], "st string, st_ord int, locus string, allele string")
    calls = spark.createDataFrame([("x", "a", "a_1"), ("x", "b", "2"), ("y", "a", "1"), ("z", "a", "9"), ("z", "b", "9"), ("w", "a", "9"), ("w", "b", "9"), ("v", "b", "5")], "sample string, locus string, allele string")
    samples = spark.createDataFrame([(s,) for s in "vwxyzu"], "sample string")
    got = {r.sample: (r.st, r.status) for r in typing.assign_types(samples, calls, profiles).collect()}
    assert got == {"x": ("1", "Known"), "y": ("2", "Known"), "z": ("4_INF", "New"), "w": ("4_INF", "New"), "v": ("-", "Unknown"), "u": ("-", "Unknown")}
    grown = typing.updated_profiles(profiles, typing.assign_types(samples, calls, profiles), calls)
    assert sorted((r.locus, r.allele) for r in grown.filter("st = '4_INF'").collect()) == [("a", "9"), ("b", "9")]
    assert sum(r.n for r in typing.type_rollup(typing.assign_types(samples, calls, profiles)).filter("level = 3").collect()) == 6
