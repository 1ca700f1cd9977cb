"""FASTA text as DataFrames, and back.

A schema is a folder of multi-FASTA files, one a locus (its name up to the first dot); a sample is
one file of contigs (its name without the last extension).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# File extensions that are read.
EXTENSIONS = ["fasta", "fa", "fna", "ffn", "frn"]


def _found(path: str | list[str]) -> list[str]:
    """Files as they are, folders as patterns of the extensions."""
    paths = [path] if isinstance(path, str) else path
    return [p if any(p.endswith(f".{e}") for e in EXTENSIONS) else f"{p.rstrip('/')}/*.{{{','.join(EXTENSIONS)}}}" for p in paths]


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, name, description, seq, ord) of every record, case kept; files of other extensions are left out.

    Records are split by '>' in the text reader, so one file is read by several tasks. ord is the
    record's order by its place in the file. What stands before a file's first '>' is no record.
    """
    raw = spark.read.option("lineSep", ">").text(_found(path)).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    raw = raw.withColumn("begins", F.min(F.struct("block", "place")).over(Window.partitionBy("file")))
    raw = raw.filter((F.struct("block", "place") != F.col("begins")) & (F.length(F.trim("value")) > 0))
    lines = F.split("value", r"\r?\n")
    header = F.trim(F.get(lines, F.lit(0)))
    seq = F.regexp_replace(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), ""), r"\s", "")
    rows = raw.select("file", "block", "place", F.regexp_extract(header, r"^(\S+)", 1).alias("name"), header.alias("description"), seq.alias("seq")).filter("name <> ''")
    order = F.row_number().over(Window.partitionBy("file").orderBy("block", "place")) - 1
    return rows.select(F.url_decode("file").alias("file"), "name", "description", "seq", order.cast("int").alias("ord"))


def files_without_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, bytes) of the files with a FASTA extension that hold no record: what read_records passes over in silence.

    Files are listed by name and size alone, as empty ones too must be named.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    listed = []
    for pattern in map(jvm.org.apache.hadoop.fs.Path, _found(path)):
        listed += [(x.getPath().getName(), x.getLen()) for x in pattern.getFileSystem(conf).globStatus(pattern) or []]
    files = spark.createDataFrame(listed, "file string, bytes long")
    return files.join(read_records(spark, path).select("file").distinct(), "file", "left_anti")


def locus_of(file: Column) -> Column:
    return F.split(file, r"\.")[0]


def sample_of(file: Column) -> Column:
    return F.regexp_replace(file, r"\.[^.]*$", "")


def read_schema(spark: SparkSession, path: str) -> DataFrame:
    """alleles(locus, allele_id, seq, description, ord), case kept; of a repeated id the last record counts."""
    rows = read_records(spark, path).select(locus_of(F.col("file")).alias("locus"), F.col("name").alias("allele_id"), "seq", "description", "ord")
    last = F.row_number().over(Window.partitionBy("locus", "allele_id").orderBy(F.desc("ord")))
    return rows.withColumn("r", last).filter("r = 1").drop("r")


def read_samples(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """contigs(sample, contig, seq, ord), in upper case; of a repeated id the last record counts."""
    rows = read_records(spark, path).select(sample_of(F.col("file")).alias("sample"), F.col("name").alias("contig"), F.upper("seq").alias("seq"), "ord")
    last = F.row_number().over(Window.partitionBy("sample", "contig").orderBy(F.desc("ord")))
    return rows.withColumn("r", last).filter("r = 1").drop("r")


def read_genes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """genes(sample, contig, gene_start, gene_end, gene_seq) from a gene predictor's FASTA: '<contig>_<n> # start # end # ...'."""
    rows = read_records(spark, path)
    parts = F.split("description", r"\s*#\s*")
    contig = F.regexp_replace("name", r"_[^_]*$", "")
    return rows.select(sample_of(F.col("file")).alias("sample"), contig.alias("contig"), F.get(parts, F.lit(1)).try_cast("int").alias("gene_start"), F.get(parts, F.lit(2)).try_cast("int").alias("gene_end"), F.upper("seq").alias("gene_seq"))


def write_schema(alleles: DataFrame, path: str) -> None:
    """One folder per locus (locus=X/) of FASTA text in order; a new version, never in place."""
    text = F.concat(F.lit(">"), F.coalesce(F.when(F.col("description") != "", F.col("description")), F.col("allele_id")), F.lit("\n"), F.col("seq"))
    alleles.select("locus", "ord", text.alias("value")).repartition("locus").sortWithinPartitions("locus", "ord").select("locus", "value").write.partitionBy("locus").text(path)
