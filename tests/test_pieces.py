"""Pieces of contigs, the stop index and calls of alleles stored in reverse."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import calling, pieces

RNG = random.Random(23)
TURN = str.maketrans("ACGT", "TGCA")


def dna(n, letters="ACGT"):
    return "".join(RNG.choice(letters) for _ in range(n))


def rc(s):
    return s.translate(TURN)[::-1]


def final(contig, start, end, turned):
    """The rule as it is written down: from which side, then codon by codon."""
    if turned:
        onward = rc(contig[:end]) if end > start else contig[end - 1 :]
    else:
        onward = rc(contig[:start]) if start > end else contig[start - 1 :]
    for i in range(0, len(onward) - 2, 3):
        if onward[i : i + 3] in ("TAA", "TAG", "TGA"):
            return onward[: i + 3] if i else None
    return None


@pytest.mark.parametrize("size", [1 << 16, 50, 7])
def test_final_sequences(spark, monkeypatch, size):
    """Pieces of any size give what the rule gives: frames that end in another piece, at the contig's ends, never."""
    monkeypatch.setattr(pieces, "PIECE", size)
    contigs = {("s", "long"): dna(900), ("s", "rare"): dna(400, "AC") + "TAA" + dna(300, "AC") + "TTA" + dna(301, "AC"), ("s", "short"): "AT", ("t", "none"): dna(200, "C"), ("t", "odd"): dna(60) + "N" * 20 + dna(60)}
    places = []
    for (sample, contig), seq in contigs.items():
        for _ in range(60):
            a, b = RNG.randint(1, len(seq)), RNG.randint(1, len(seq))
            places.append((sample, contig, a, b, RNG.random() < 0.5))
    places = sorted(set(places))
    hits = spark.createDataFrame(places, "sample string, contig string, cstart int, cend int, turned boolean")
    table = spark.createDataFrame([(*k, v) for k, v in contigs.items()], "sample string, contig string, seq string")
    got = {tuple(r)[:5]: (r.final_seq, r.final_len) for r in pieces.final_sequences(hits, table).collect()}
    want = {p: final(contigs[p[:2]], *p[2:]) for p in places}
    assert got == {p: (v, v and len(v)) for p, v in want.items()}
    assert len({v is None for v in want.values()}) == 2


def test_cut(spark, monkeypatch):
    monkeypatch.setattr(pieces, "PIECE", 16)
    seq = dna(100)
    table = spark.createDataFrame([("s", "c", seq)], "sample string, contig string, seq string")
    places = spark.createDataFrame([("s", "c", a, b) for a in (1, 15, 16, 17, 60, 100) for b in (1, 16, 17, 33, 99, 100, 130)], "sample string, contig string, low int, high int")
    for r in pieces.cut(places, pieces.in_pieces(table, ["sample", "contig"]), ["sample", "contig"], "low", "high").collect():
        assert (r.text, r.contig_length) == (seq[r.low - 1 : r.high], 100)


def gene(n):
    while True:
        body = [dna(3) for _ in range(n)]
        if not any(c in ("TAA", "TAG", "TGA") for c in body):
            return "ATG" + "".join(body) + "TAA"


def test_calls_of_reverse_alleles(spark):
    """A locus stored in reverse is called like one stored forwards, on both strands, and its new sequence reads forwards."""
    g = gene(60)
    other = g[:30] + {"A": "C", "C": "G", "G": "C", "T": "C"}[g[30]] + g[31:]
    new = g[:100] + {"A": "C", "C": "G", "G": "C", "T": "C"}[g[100]] + g[101:]
    early = g[:90] + "TAA" + g[93:]
    while rc(g)[:3] in ("ATG", "GTG", "TTG", "ATA", "ATT"):
        g = gene(60)
    cases = {"exact": g, "new": new, "early": early}
    genomes = [(f"{name}_{strand}", "c", dna(300) + (x if strand == "plus" else rc(x)) + dna(300)) for name, x in cases.items() for strand in ("plus", "minus")]
    contigs = spark.createDataFrame(genomes, "sample string, contig string, seq string")
    config = calling.CallConfig(percent_length=10, coverage=50)
    found = {}
    for name, stored in (("forward", lambda x: x), ("reverse", rc)):
        alleles = spark.createDataFrame([("x", "1", stored(g), 0), ("x", "2", stored(other), 1)], "locus string, allele_id string, seq string, ord int")
        calls = calling.call_alleles(alleles, alleles.filter("allele_id = '1'"), contigs, config)
        found[name] = {r.sample: (r.kind, r.final_seq) for r in calls.collect()}
    for way in ("forward", "reverse"):
        for strand in ("plus", "minus"):
            assert found[way][f"exact_{strand}"][0] == "EXACT"
            assert found[way][f"new_{strand}"] == ("INF", new)
            assert found[way][f"early_{strand}"] == ("ASM", early[:93])


def test_no_contig_text_in_the_hits(spark):
    """What is collected for a cell holds places, and no text of contigs."""
    alleles = spark.createDataFrame([("x", "1", gene(50), 0)], "locus string, allele_id string, seq string, ord int")
    contigs = spark.createDataFrame([("s", "c", dna(400))], "sample string, contig string, seq string")
    calls = calling.call_alleles(alleles, alleles, contigs)
    assert "contig_seq" not in calls.columns and {f.name for f in calls.schema["hit"].dataType.fields}.isdisjoint({"contig_seq", "final_seq"})
    assert [r.kind for r in calls.select("kind").collect()] == ["LNF"] and calls.filter(F.col("final_seq").isNotNull()).count() == 0


def test_batches_of_few_letters(monkeypatch):
    """What is made of long sequences leaves in batches of about LETTERS letters, however many rows came in."""
    import pyarrow as pa

    monkeypatch.setattr(pieces, "LETTERS", 1000)
    given = pa.RecordBatch.from_pydict({"sample": [f"s{i}" for i in range(200)]})
    made = ((k, [[0], ["A" * 100]], 100) for k in range(200))
    got = list(pieces.exploded(given, ["sample"], made, ["sample", "piece", "text"], [pa.int32(), pa.string()]))
    assert [b.num_rows for b in got] == [10] * 20
    assert [x for b in got for x in b.column("sample").to_pylist()] == given.column("sample").to_pylist()
