"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._shared import join_counted, remove, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the least node of the component.

    Rows per round stay linear in the edges, and each star's minimum is combined before the
    shuffle, and a node of very many neighbours
    is joined by a broadcast, so one huge component is no hot spot. Rounds grow with the logarithm of its diameter.
    """
    spark = edges.sparkSession
    edges, path = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    mark = None
    while mark != (now := _mark(edges)):
        mark = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least, least_path = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("degree")), "least")
        large = join_counted(both, least, "a", "degree", "inner").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        old = path
        edges, path = written(small.filter("a <> b").distinct(), "edges")
        remove(spark, old)
        remove(spark, least_path)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
