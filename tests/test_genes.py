"""The predicted gene of a hit by the score of its alignment, against alignments of all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions.alignment import align
from strandline.operators import calling, genes, hits
from strandline.plans import queries, surrogates

RNG = random.Random(29)
HIT = "sample string, contig string, cstart int, cend int, sseq string"
GENE = "sample string, contig string, gene_start int, gene_end int, gene_seq string"
TURN = str.maketrans("ACGT", "TGCA")


def dna(n):
    return "".join(RNG.choice("ACGT") for _ in range(n))


def every(seq, n):
    """seq with every n-th letter changed."""
    return "".join(seq[i] if (i + 1) % n else "ACGT"["ACGT".index(seq[i]) - 1] for i in range(len(seq)))


def by_all_pairs(hit_rows, gene_rows):
    """(cstart, cend) of each hit: start and end of its gene, by whole alignments with all genes of its contig on both strands."""
    out = {}
    for h in hit_rows:
        best = None
        for g in gene_rows:
            if (h[0], h[1]) != (g[0], g[1]) or not h[4] or not g[4]:
                continue
            query = h[4].replace("-", "")
            for own in (query, query.translate(TURN)[::-1]):
                found = align(own, g[4])
                if not found.a:
                    continue
                same = sum(x == y for x, y in zip(found.a, found.b, strict=True))
                bits = (1.28 * found.score - math.log(0.46)) / math.log(2)
                if same * 100 / len(found.a) >= 90 and len(query) * len(g[4]) * 2.0**-bits <= 0.001:
                    rank = (found.score, -g[2], -g[3])
                    best = max(best or (rank, g), (rank, g))
        out[h[0], h[1], h[2], h[3]] = (str(best[1][2]), str(best[1][3])) if best else ("-", "-")
    return out


@pytest.fixture(scope="module")
def planted():
    """Contigs on which overlap and score disagree: (hits, genes, hit -> gene_start)."""
    a, b, c = dna(900), dna(900), dna(900)
    contig = a + b + c
    rows_g = [
        ("s", "c", 1, 900, every(a, 5)),  # overlaps most, aligns badly
        ("s", "c", 901, 1800, b),
        ("s", "c", 1801, 2700, c.translate(TURN)[::-1]),  # on the other strand
        ("s", "c", 5001, 5400, every(c[:400], 20)),  # a changed copy far away
        ("s", "c", 7001, 7900, b),  # an exact copy far away
        ("s", "d", 901, 1800, b),  # the same gene on another contig
        ("t", "c", 1, 900, a),  # and in another sample
        ("s", "c", None, None, None),
    ]
    rows_h = [
        ("s", "c", 501, 1100, contig[500:1100]),
        ("s", "c", 1100, 501, contig[500:1100].translate(TURN)[::-1]),
        ("s", "c", 1850, 2350, contig[1849:2350]),
        ("s", "c", 1000, 1500, contig[999:1200] + "---" + contig[1200:1500]),
        ("s", "d", 501, 1100, contig[500:1100]),
        ("t", "c", 501, 1100, contig[500:1100]),
        ("u", "c", 501, 1100, contig[500:1100]),
        ("s", "c", 3000, 3100, dna(100)),
        ("s", "c", 1, 5, "ACGTA"),
        ("s", "c", 2, 5, ""),
        ("s", "c", 3, 5, None),
    ]
    return rows_h, rows_g


def test_score_decides_where_overlap_does_not(spark, planted):
    rows_h, rows_g = planted
    h, g = spark.createDataFrame(rows_h + rows_h[:1], HIT), spark.createDataFrame(rows_g + rows_g[:2], GENE)
    got = genes.best_gene(h, g)
    assert got.count() == len(rows_h) + 1  # one row a hit, repeated ones too
    found = {(r.sample, r.contig, r.cstart, r.cend): (r.predicted_start, r.predicted_end) for r in got.collect()}
    assert found == by_all_pairs(rows_h, rows_g)
    assert found["s", "c", 501, 1100] == ("901", "1800") and found["s", "c", 1850, 2350] == ("1801", "2700") and found["t", "c", 501, 1100] == ("1", "900")
    assert found["u", "c", 501, 1100] == ("-", "-") == found["s", "c", 3, 5]
    overlap = {r.cstart: r.predicted_start for r in hits.predicted_gene(h.filter("sample = 's' AND contig = 'c' AND cstart = 501"), g).collect()}
    assert overlap == {501: "1"}


def test_clashing_columns_and_empty_tables(spark, planted):
    rows_h, rows_g = planted
    h, g = spark.createDataFrame(rows_h[:1], HIT), spark.createDataFrame(rows_g, GENE)
    odd = h.withColumns({"gene_start": F.lit("mine"), "bitscore": F.lit(1), "place": F.lit(2), "seq": F.lit("x"), "a.b": F.lit(3)})
    row = genes.best_gene(odd, g).first()
    assert (row.gene_start, row.bitscore, row.place, row.seq, row["a.b"], row.predicted_start) == ("mine", 1, 2, "x", 3, "901")
    assert genes.best_gene(h, g.limit(0)).first().predicted_seq == genes.NOT_FOUND
    assert genes.best_gene(h.limit(0), g).count() == 0


def test_query_equals_all_pairs(spark, tmp_path):
    """gene_by_score on some documents, one of them with a repeated passage."""
    words = ["".join(RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(RNG.randint(2, 9))) for _ in range(600)]
    text = lambda n: " ".join(RNG.choice(words) for _ in range(n))
    shared = text(200)
    docs = [(1, text(700)), (2, shared + " " + text(90) + " " + shared), (3, "short"), (4, ""), (5, None), (6, "x" * 2000)]
    table = spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, lang string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    rows_h, rows_g = [], []
    for r in table.select("doc_id", surrogates.dna(F.col("text")).alias("seq")).collect():
        seq = r.seq or ""
        for k, at in enumerate(range(0, len(seq), 900)):
            own = seq[at : at + 900]
            gene = own if k % 2 else "".join("A" if i % 5 == 4 else x for i, x in enumerate(own))
            rows_g.append(("documents", r.doc_id, at + 1, at + len(own), gene))
            if at + 700 < len(seq):
                part = seq[at + 700 : at + 1000]
                rows_h.append(("documents", r.doc_id, at + 701, at + 700 + len(part), part))
    got = {("documents", r.doc_id, r.cstart, r.cend): (r.predicted_start, r.predicted_end) for r in queries.QUERIES["gene_by_score"](spark, str(tmp_path)).collect()}
    assert got == by_all_pairs(rows_h, rows_g)


def test_report_by_score(spark, planted):
    """exact rows only of bad quality, inferred ones always."""
    rows_h, rows_g = planted
    hit = F.struct(F.col("contig"), F.col("cstart"), F.col("cend"), F.col("sseq"), F.lit("1").alias("qseqid"), F.lit(600).alias("length"), F.lit(1.0).alias("bitscore"), F.lit(600).alias("allele_len"), F.lit(600).alias("found_len"), F.lit(0).alias("mismatch"), F.lit(0).alias("gapopen"))
    base = spark.createDataFrame(rows_h[:1], HIT).select("sample", hit.alias("hit"), F.array(hit).alias("kept"), F.lit("x").alias("locus"), F.lit("1").alias("allele"), F.lit("1").alias("tag"), F.lit("").alias("final_seq"), F.lit(600).alias("final_len"))
    g = spark.createDataFrame(rows_g, GENE)
    for kind, report, quality, want in (("EXACT", "exact", "good_quality", "-"), ("EXACT", "exact", "bad_quality: no_stop", "found"), ("INF", "inferred", "good_quality", "found")):
        q = spark.createDataFrame([("x", "1", quality)], "locus string, allele_id string, quality string")
        got = calling.report(base.withColumn("kind", F.lit(kind)), report, q, genes=g, by_score=True).first().predicted_sequence
        assert got == (rows_g[1][4] if want == "found" else "-")
