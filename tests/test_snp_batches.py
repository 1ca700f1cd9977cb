"""Differences in batches, against a plain letter by letter list."""

import random

import pytest

from strandline.functions.sequence import CODONS, RESIDUE_CLASSES
from strandline.operators import snps

RNG = random.Random(47)


def plain(allele, found):
    if allele is None or found is None:
        return
    theirs = found.replace("-", "")[: len(allele)].ljust(len(allele), "-")
    name = lambda r: next((c for c, rs in RESIDUE_CLASSES.items() if r and r in rs), "unknown")
    known = lambda c: CODONS.get(c, "X") if len(c) == 3 else ""
    for p in range(len(allele)):
        if allele[p] == theirs[p]:
            continue
        c = p - p % 3
        one, two = allele[c : c + 3], theirs[c : c + 3]
        a, b = ("".join(known(allele[k : k + 3]) for k in range(c, len(allele) - 2, 3)), "-") if "-" in two else (known(one), known(two))
        ca, cb = name(a[:1]), name(b[:1])
        yield (p + 1, f"{allele[p]}/{theirs[p]}", f"{one}/{two}", f"{a}/{b}", "Synonymous" if ca == cb else "Nonsense" if b == "*" else "Missense", f"{ca} / {cb}")
        if "-" in two:
            return


@pytest.mark.parametrize("rows", [1 << 17, 5])
def test_against_letters(spark, monkeypatch, rows):
    """Lengths of every rest by three, shorter and longer finds, gaps, letters that are no base or no ASCII, nulls, keys of two columns."""
    monkeypatch.setattr(snps, "ROWS", rows)
    text = lambda n, letters: "".join(RNG.choice(letters) for _ in range(n))
    pairs = [(text(RNG.randrange(30), a), text(RNG.randrange(30), b)) for a in ("ACGT", "ACGTNa", "ACGT-", "ACGé") for b in ("ACGT", "ACGT-", "ACGTné𝒳") for _ in range(12)]
    pairs += [("ACGACG", "ACGACG"), ("", "ACG"), ("ACG", ""), (None, "ACG"), ("ACG", None)]
    df = spark.createDataFrame([(i, f"k{i}", *p) for i, p in enumerate(pairs)], "id int, name string, allele_seq string, found_seq string")
    found = snps.snps(df)
    got = sorted(tuple(r) for r in found.collect())
    assert got == sorted((i, f"k{i}", *r) for i, p in enumerate(pairs) for r in plain(*p))
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
