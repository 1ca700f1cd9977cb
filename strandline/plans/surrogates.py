"""Typing inputs made from general tables, so that every operator can run where no genomes are.

A locus is a document's language, an allele a document, its sequence all letters of its
text turned into ACGT; the call matrix comes from events, hits from line items, profiles from parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = "ACGTACGTACGTACGTACGTACGTAC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dna(text: Column) -> Column:
    return F.translate(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), LETTERS, BASES)


def text_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alleles(locus, allele_id, seq, ord) with whole texts as sequences."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("lang").alias("locus"), F.col("doc_id").cast("string").alias("allele_id"), F.col("text").alias("seq"), F.col("doc_id").alias("ord"))


def dna_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alleles(locus, allele_id, seq, ord) with DNA of texts."""
    return text_alleles(spark, sf_dir).withColumn("seq", dna(F.col("seq")))


def event_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """calls(sample, locus, tag): users by day of month, the greatest event type of the day, LNF for none."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("sample"), F.dayofmonth("ts").cast("long").alias("locus"), F.col("event_type").alias("tag"))
    cells = e.select("sample").distinct().crossJoin(e.select("locus").distinct())
    seen = e.groupBy("sample", "locus").agg(F.max("tag").alias("tag"))
    return cells.join(seen, ["sample", "locus"], "left").withColumn("tag", F.coalesce("tag", F.lit("LNF")))


def item_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hits(sample, contig, bitscore, hit_start, hit_end, line_no, part, supp, ship): line items as hits of their order."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    start = F.dayofyear("l_shipdate").cast("long")
    return l.select(
        F.col("l_orderkey").alias("sample"), (F.col("l_suppkey") % 3).alias("contig"), F.col("l_extendedprice").alias("bitscore"), start.alias("hit_start"),
        (start + F.col("l_quantity").cast("long")).alias("hit_end"), F.col("l_linenumber").cast("long").alias("line_no"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_shipdate").alias("ship"),
    )


def part_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """profiles(st, st_ord, locus, allele): every distinct (brand, type) of parts, by its first part, as a type of two loci."""
    p = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("st_ord"))
    loci = F.array(F.struct(F.lit("brand").alias("locus"), F.col("p_brand").alias("allele")), F.struct(F.lit("type").alias("locus"), F.col("p_type").alias("allele")))
    return p.select(F.col("st_ord").cast("string").alias("st"), "st_ord", F.explode(loci).alias("l")).select("st", "st_ord", "l.*")


def part_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """calls(sample, locus, allele): every part with its brand and type; those of size 13 lack the type."""
    p = table(spark, sf_dir, "part")
    loci = F.array(F.struct(F.lit("brand").alias("locus"), F.col("p_brand").alias("allele")), F.struct(F.lit("type").alias("locus"), F.when(F.col("p_size") != 13, F.col("p_type")).alias("allele")))
    return p.select(F.col("p_partkey").alias("sample"), F.explode(loci).alias("l")).select("sample", "l.*").filter("allele IS NOT NULL")
