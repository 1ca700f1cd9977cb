import math
import random

import pytest

import __spark_entry__ as entry
from strandline.functions.alignment import CALL_SCORING, align
from strandline.plans.surrogates import BASES, LETTERS


def dna(text):
    return "".join(c for c in text if c.isascii() and c.isalpha()).upper().translate(str.maketrans(LETTERS, BASES))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    head = "".join(rng.choice("abc d") for _ in range(700))
    return {0: head + "tag" * 40, 1: head + "tag" * 39 + "cat", 2: head[:350], 3: "ac" * 300 + "taa" + "gggc" * 50, 4: "".join(rng.choice("acgt") for _ in range(800))}


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    rows = [(i, t, "en", "web", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return path


def test_letters_after_300_are_read(spark, folder, texts):
    run = lambda name: entry.queries()[name](spark, folder).collect()
    seqs = {i: dna(t) for i, t in texts.items()}
    assert {r.doc_id: r.rc for r in run("reverse_complement")} == {i: x.translate(str.maketrans("ACGT", "TGCA"))[::-1] for i, x in seqs.items()}
    stops = {i: next((k for k in range(0, len(x) - 2, 3) if x[k : k + 3] in ("TAA", "TAG", "TGA")), None) for i, x in seqs.items()}
    assert {r.doc_id: r.first_stop for r in run("stop_codon")} == stops and stops[3] == 600
    assert {r.allele_id for r in run("schema_filter")} == {"0", "1", "3", "4"}
    assert [r.position for r in run("snp_list") if r.doc_id == 0] == [k + 1 for k in range(len(seqs[0])) if seqs[0][k] != seqs[1][k]]
    assert {r.id: r.score for r in run("local_alignment")}[0] == max(len(seqs[0]) - 3, align(seqs[0], seqs[1], CALL_SCORING).score)


def test_word_distances_of_all_of_a_source(spark, tmp_path):
    rng = random.Random(9)
    long = "".join(rng.choice("acgt") for _ in range(900))
    texts = {0: long, 1: long, 2: long[:400] + "a" + long[400:], 4: long[600:] + "ggtt" * 20, 5: "".join(rng.choice("acgt") for _ in range(500)), 6: "ac", 999: long[:500], 1001: long}
    source = {i: "x" if i < 1000 else "y" for i in texts}
    spark.createDataFrame([(i, t, "en", source[i], len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")

    def words(t):
        t = t.upper()
        return {min(w, w.translate(str.maketrans("ACGT", "TGCA"))[::-1]) for w in (t[i : i + 21] for i in range(len(t) - 20))}

    def distance(i, j):
        both = len(words(texts[i]) & words(texts[j]))
        share = both / max(len(words(texts[i]) | words(texts[j])), 1)
        return 0.0 if i == j else 1.0 if not both else max(0.0, -math.log(2 * share / (1 + share)) / 21)

    run = lambda name: entry.queries()[name](spark, str(tmp_path)).collect()
    want = {(source[i], str(i), str(j)): distance(i, j) for i in texts for j in texts if source[i] == source[j]}
    got = {(r.locus, r.id_1, r.id_2): r.distance for r in run("kmer_distance")}
    assert got == pytest.approx(want, abs=1e-6) and len(got) == 50
    hit = {(s, j) for (s, i, j), d in want.items() if d < 0.1 and i < j}
    assert {(r.locus, r.allele_id) for r in run("unrepresented")} == {(source[i], str(i)) for i in texts} - hit
    mean = {i: round(sum(round(distance(i, j), 6) for j in texts if source[j] == "x") / 7, 10) for i in texts if source[i] == "x"}
    good = {r.allele_id for r in entry.queries()["allele_quality"](spark, str(tmp_path)).selectExpr("cast(doc_id as string) allele_id", "quality").filter("quality = 'good_quality'").collect()}
    best = min(mean, key=lambda i: (str(i) not in good, mean[i], -i))
    assert {(r.locus, r.allele_id) for r in run("centroid")} == {("x", str(best)), ("y", "1001")}
