"""Numbers within a locus that one task does not make alone."""

import random

from pyspark.sql import functions as F

from strandline.operators import calling, numbering


def test_no_locus_in_one_task(spark, monkeypatch):
    """All sequences are of one locus: their numbers are those of the order, and no task holds them all."""
    held = []
    kept = numbering.durable

    def watched(df, what="table"):
        held.append(max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()))
        return kept(df, what)

    monkeypatch.setattr(numbering, "durable", watched)
    rng = random.Random(5)
    rows = [(rng.randrange(900), "l", "INF", "".join(rng.choice("ACGT") for _ in range(5))) for _ in range(2000)]
    first = {}
    for sample, _, _, seq in rows:
        first[seq] = min(first.get(seq, sample), sample)
    place = {seq: i for i, seq in enumerate(sorted(first, key=lambda x: (first[x], x)))}
    calls = calling.numbered(spark.createDataFrame([*rows, (1, "l", "LNF", None)], "sample long, locus string, kind string, final_seq string"))
    assert {(r.final_seq, r.idx) for r in calls.filter("kind = 'INF'").collect()} == set(place.items())
    assert calls.count() == 2001 and calls.filter("idx IS NULL").count() == 1
    alleles = spark.createDataFrame([("l", "17", "AC", 4), ("m", "3", "AC", 5)], "locus string, allele_id string, seq string, ord int")
    made = calling.new_alleles(calls, alleles).collect()
    assert {(r.seq, r.allele_id, r.ord) for r in made} == {(seq, str(18 + i), 5 + i) for seq, i in place.items()}
    assert len(held) >= 4 and max(held) < len(place)  # there were two windows by locus
