import os
import random
import time

from pyspark.sql import functions as F

from strandline.operators import calling
from strandline.sources import fasta, tables
from strandline.storage import clear_scratch, shared_folder
from strandline.streaming.incremental import CONTIGS, call_batch, call_stream


def test_fasta(spark, tmp_path):
    (tmp_path / "loc.v1.fasta").write_text(">1 first\nACGT\nacg\n>2\nTTT\n\n>1 again\nGG\n")
    (tmp_path / "other.fna").write_text(">9\r\nAAA\r\n")
    (tmp_path / "notes.txt").write_text(">no\nA\n")
    got = sorted(tuple(r) for r in fasta.read_schema(spark, str(tmp_path)).select("locus", "allele_id", "seq", "description").collect())
    assert got == [("loc", "1", "GG", "1 again"), ("loc", "2", "TTT", "2"), ("other", "9", "AAA", "9")]
    samples = sorted(tuple(r) for r in fasta.read_samples(spark, str(tmp_path)).select("sample", "contig", "seq").collect())
    assert samples[0] == ("loc.v1", "1", "GG")
    out = str(tmp_path / "out")
    fasta.write_schema(fasta.read_schema(spark, str(tmp_path)), out)
    text = spark.read.text(out + "/locus=loc").collect()
    assert [r.value for r in text] == [">2", "TTT", ">1 again", "GG"]
    genes = tmp_path / "g.fna"
    genes.write_text(">c_a_1 # 5 # 20 # 1 # ID\nATG\n")
    row = fasta.read_genes(spark, str(genes)).first()
    assert (row.contig, row.gene_start, row.gene_end, row.gene_seq) == ("c_a", 5, 20, "ATG")


def test_tables(spark, tmp_path):
    matrix = tmp_path / "m.tsv"
    matrix.write_text("Sample Name\tl1\tl2\ns1\t1\tLNF\ns2\t\t007\n")
    m = tables.read_matrix(spark, str(matrix))
    assert sorted((r.sample, r.locus, r.locus_ord, r.tag) for r in m.collect() if r.tag) == [("s1", "l1", 0, "1"), ("s1", "l2", 1, "LNF"), ("s2", "l2", 1, "007")]
    profile = tmp_path / "p.tsv"
    profile.write_text("ST\tl1\tl2\tclonal\n1\t4\t5\tx\n2\t4\t6\ty\n")
    p = tables.read_profiles(spark, str(profile), 2)
    assert sorted((r.st, r.locus, r.allele) for r in p.collect()) == [("1", "l1", "4"), ("1", "l2", "5"), ("2", "l1", "4"), ("2", "l2", "6")]
    hits = tmp_path / "h.tsv"
    hits.write_text("q\ts\t99.5\t10\t10\t0\t0\t0.001\t50\t1\t10\t1\t10\tACGT\tACGT\n")
    h = tables.read_hits(spark, str(hits)).first()
    assert (h.pident, h.sstart, h.line_no) == (99.5, 1, 1)
    ann = tmp_path / "loc.tsv"
    ann.write_text("locus_tag\tgene\tproduct\nx\tabc_1\tprotein\ny\tdef\tother\n")
    a = tables.read_annotation(spark, str(ann)).first()
    assert (a.locus, a.gene, a.product) == ("loc", "abc", "protein")
    d = tmp_path / "d.tsv"
    d.write_text("a\tb\t0.25\t0\t5/10\n")
    assert tables.read_word_distances(spark, str(d)).first().distance == 0.25
    tables.write_matrix(m, str(tmp_path / "w"), ["l1", "l2"])
    assert spark.read.csv(str(tmp_path / "w"), sep="\t", header=True).columns == ["Sample Name", "l1", "l2"]
    tables.write_summary(m, str(tmp_path / "s"))
    assert spark.read.csv(str(tmp_path / "s"), sep="\t", header=True).count() == 2
    tables.write_each(m.withColumn("x", F.lit("y")), str(tmp_path / "e"))


def test_files_without_records(spark, tmp_path):
    for name, text in (("a.fasta", ">1\nACGT\n"), ("b.fa", ""), ("c d.fna", "no record\n"), ("e.txt", "")):
        (tmp_path / name).write_text(text)
    got = {r.file: r.bytes for r in fasta.files_without_records(spark, str(tmp_path)).collect()}
    assert got["b.fa"] == 0 and "a.fasta" not in got and "e.txt" not in got and set(got) == {"b.fa", "c d.fna"}


def test_reports_under_fixed_headers(spark, tmp_path):
    columns = {"locus": "x", "sample": "s", "gene": "g", "product": "p", "tag": "INF_x_1_0", "allele": "1", "quality": "good_quality", "contig": "c", "bitscore": 9.5, "query_length": 10, "contig_length": 11, "new_length": 12, "mismatch": 1, "gaps": 0, "contig_start": 5, "contig_end": 14, "new_sequence": "ATG"}
    rows = spark.createDataFrame([tuple(columns.values()), ("a", *list(columns.values())[1:-1], None)], list(columns))
    tables.write_report(rows, str(tmp_path / "r"), "inferred")
    back = spark.read.csv(str(tmp_path / "r"), sep="\t", header=True)
    assert back.columns == ["Core Gene", "Sample Name", "INF tag", "Gene Annotation", "Product Annotation", "Allele", "Allele Quality", "Contig", "Bitscore", "Query length", "Contig length", "New sequence length", "Mismatch", "gaps", "Contig start", "Contig end", "New sequence", "Predicted Sequence"]
    got = {r["Core Gene"]: r for r in back.collect()}
    assert got["x"]["New sequence"] == "ATG" and got["a"]["New sequence"] == "-" and got["x"]["Predicted Sequence"] == "-"
    assert {k: len(v) for k, v in tables.REPORT_HEADERS.items()} == {"exact": 12, "paralog": 14, "inferred": 18, "asm": 19, "alm": 19, "plot": 12, "lnf_tpr": 14, "matching_contigs": 8}


def test_stream_calls_each_sample_once(spark, tmp_path):
    gene = "ATG" + "GCTGAACGTTCA" * 15 + "TAA"
    alleles = spark.createDataFrame([("x", "1", gene, 0)], "locus string, allele_id string, seq string, ord int")
    source = str(tmp_path / "in")
    flank = "TTGACCATTGCAGGATCCAA" * 6
    for name in ("s1", "s2"):
        spark.createDataFrame([(name, "c", flank + gene + flank)], CONTIGS).coalesce(1).write.mode("append").parquet(source)
        q = call_stream(spark, source, alleles, alleles, str(tmp_path / "out"), str(tmp_path / "ckpt"), calling.CallConfig(percent_length=20))
        assert q.awaitTermination(120) is not False
        time.sleep(0.1)
    got = sorted((r.sample, r.locus) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("s1", "x"), ("s2", "x")]


def test_three_batches_equal_one_run(spark, tmp_path):
    """New sequences keep their numbers over batches, a batch that runs again changes nothing, and no scratch is left."""
    rng = random.Random(41)

    def gene(n):
        while True:
            body = ["".join(rng.choice("ACGT") for _ in range(3)) for _ in range(n)]
            if not {"TAA", "TAG", "TGA"} & set(body):
                return "ATG" + "".join(body) + "TAA"

    g = gene(60)
    swap = lambda at: g[:at] + {"A": "C", "C": "G", "G": "C", "T": "C"}[g[at]] + g[at + 1 :]
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    early = g[:90] + "TAA" + g[93:]
    kinds = [[("a1", swap(100)), ("a2", g)], [("b1", swap(61)), ("b2", swap(100)), ("b3", early)], [("c1", swap(61)), ("c2", swap(130)), ("c3", early)]]
    alleles = spark.createDataFrame([("x", "1", g, 0)], "locus string, allele_id string, seq string, ord int")
    config = calling.CallConfig(percent_length=10, coverage=50)
    source, out = tmp_path / "in", str(tmp_path / "out")
    rows = [[(s, "c", dna(300) + seq + dna(300)) for s, seq in part] for part in kinds]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, CONTIGS).coalesce(1).write.parquet(f"{source}/part={k}")
        time.sleep(1.1)  # files are taken in the order of their times
    want = {r.sample: r.tag for r in calling.call_alleles(alleles, alleles, spark.createDataFrame(sum(rows, []), CONTIGS), config).collect()}
    assert len({t for t in want.values() if t.startswith("INF")}) == 3 and {want["b3"], want["c3"]} == {"ASM_x_1_0"}
    clear_scratch(spark)
    query = call_stream(spark, f"{source}/*", alleles, alleles, out, str(tmp_path / "ckpt"), config, files_per_batch=1)
    query.awaitTermination()
    read = lambda: {r.sample: (r.tag, r.batch) for r in spark.read.parquet(out).collect()}
    got = read()
    assert {s: t for s, (t, _) in got.items()} == want and {b for _, b in got.values()} == {0, 1, 2}
    call_batch(spark.createDataFrame(rows[1], CONTIGS), 1, alleles, alleles, out, config)
    assert read() == got
    left = [d for d, _, files in os.walk(shared_folder(spark).removeprefix("file://") + "/strandline") if files]
    assert left == []
