"""Wide matrices and numbers in order, without a pivot and without one task for all rows."""

import glob
import random

from pyspark.sql import functions as F

from strandline.operators.numbering import numbered_in_order
from strandline.sources import tables

RNG = random.Random(43)


def test_wide_matrix(spark, tmp_path):
    """Thousands of columns, in order over the parts, and the same when read again."""
    loci, samples = [f"l{i}" for i in range(2500)], [f"s{i:03}" for i in range(60)]
    RNG.shuffle(loci)
    tags = {(s, l): RNG.choice(["1", "INF_x_1_0", "LNF", " 7 "]) for s in samples for l in loci if RNG.random() < 0.98}
    calls = spark.createDataFrame([(*k, t) for k, t in tags.items()], "sample string, locus string, tag string").repartition(5)
    tables.write_matrix(calls, str(tmp_path / "m"), loci)
    files = sorted(glob.glob(str(tmp_path / "m" / "part-*")))
    lines = [line.split("\t") for f in files for line in open(f).read().split("\n")[1:] if line]
    assert len(files) > 1 and [line[0] for line in lines] == samples
    assert all(line[1:] == [tags.get((line[0], l), "") for l in loci] for line in lines)
    assert all(open(f).readline().rstrip("\n").split("\t") == ["Sample Name", *loci] for f in files)


def test_matrix_read_again(spark, tmp_path):
    calls = spark.createDataFrame([(f"s{i}", f"l{j}", f"{i * j}") for i in range(12) for j in range(7)], "sample string, locus string, tag string")
    tables.write_matrix(calls, str(tmp_path / "m"), [f"l{j}" for j in range(7)])
    again = tables.read_matrix(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, again.select("sample", "locus", "tag").collect())) == sorted(map(tuple, calls.collect()))
    assert {r.locus_ord for r in again.collect()} == set(range(7))
    apart = spark.createDataFrame([(a, b, abs(a - b)) for a in range(5) for b in range(5)], "sample_1 int, sample_2 int, distance int")
    tables.write_distances(apart, str(tmp_path / "d"), [0, 1, 2, 3, 4])
    assert {r["3"] for r in spark.read.csv(str(tmp_path / "d"), sep="\t", header=True).filter("sample_1 = 1").collect()} == {"2"}


def test_numbers_in_order(spark):
    rows = spark.createDataFrame([(RNG.randrange(10**6), f"x{i}") for i in range(3000)], "at int, name string").repartition(7)
    made = numbered_in_order(rows, [F.col("at"), "name"])
    got = {r.name: r.number for r in made.collect()}
    assert [got[r.name] for r in sorted(rows.collect(), key=lambda r: (r.at, r.name))] == list(range(1, 3001))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert numbered_in_order(rows.filter("false"), ["at"]).collect() == []
