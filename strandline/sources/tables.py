"""Tab-separated inputs and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strandline.operators.calling import SUMMARY_CLASSES, summary
from strandline.operators.hits import HIT_FIELDS


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hits of a tabular search, with line_no by place in the file."""
    rows = spark.read.schema(HIT_FIELDS).csv(path, sep="\t").withColumns({"_file": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()})
    return rows.withColumn("line_no", F.row_number().over(Window.partitionBy("_file").orderBy("_at"))).drop("_file", "_at")


def read_word_distances(spark: SparkSession, path: str) -> DataFrame:
    """(id_1, id_2, distance) from a sketching tool's table, of which the third column is the distance."""
    schema = "id_1 string, id_2 string, distance double, p double, shared string"
    return spark.read.schema(schema).csv(path, sep="\t").select("id_1", "id_2", "distance")


def _strings(spark: SparkSession, path: str) -> DataFrame:
    head = spark.read.csv(path, sep="\t", header=True)
    return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in head.columns])).csv(path, sep="\t", header=True)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A call matrix as (sample, locus, locus_ord, tag), every tag a string."""
    rows = _strings(spark, path)
    key, *loci = rows.columns
    order = F.create_map(*[x for i, c in enumerate(loci) for x in (F.lit(c), F.lit(i))])
    out = rows.withColumnRenamed(key, "sample").unpivot("sample", loci, "locus", "tag")
    return out.select("sample", "locus", F.element_at(order, F.col("locus")).alias("locus_ord"), "tag")


def read_profiles(spark: SparkSession, path: str, n_loci: int | None = None) -> DataFrame:
    """Sequence types as (st, st_ord, locus, allele); columns after the first n_loci loci are left out."""
    rows = _strings(spark, path)
    key, *loci = rows.columns
    loci = loci[:n_loci] if n_loci else loci
    out = rows.withColumns({"st": F.col(f"`{key}`"), "_at": F.monotonically_increasing_id()})
    out = out.withColumn("st_ord", F.row_number().over(Window.orderBy("_at")))  # one small table: a scheme's types
    return out.unpivot(["st", "st_ord"], loci, "locus", "allele")


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """(locus, gene, product): the first data row of each locus's annotation table; the gene ends at its first '_'."""
    rows = _strings(spark, path).select(F.split(F.col("_metadata.file_name"), r"\.")[0].alias("locus"), "gene", "product", F.monotonically_increasing_id().alias("at"))
    none = F.lit("Not found")
    first = rows.groupBy("locus").agg(F.min_by(F.struct("gene", "product"), "at").alias("r"))
    return first.select("locus", F.coalesce(F.split("r.gene", "_")[0], none).alias("gene"), F.coalesce("r.product", none).alias("product"))


def write_table(rows: DataFrame, path: str, order: list[str]) -> None:
    """One tab-separated report in the given order: numbered parts, each with the header."""
    columns = [F.col(f"`{c}`") for c in order]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *columns).sortWithinPartitions(*columns).write.csv(path, sep="\t", header=True)


# The headers of the reports, in order, with the columns that they name here.
_HEAD = {"Core Gene": "locus", "Sample Name": "sample"}
_NAMES = {"Gene Annotation": "gene", "Product Annotation": "product"}
_ALLELE = {"Allele": "allele", "Allele Quality": "quality", "Contig": "contig"}
_PLACE = {"Contig start": "contig_start", "Contig end": "contig_end"}
_FOUND = {"Sequence": "sequence", "Predicted Sequence": "predicted_sequence"}
_SIZES = {"Query length": "query_length", "Contig length": "contig_length", "New sequence length": "new_length"}
_NEW = _NAMES | _ALLELE | {"Bitscore": "bitscore"} | _SIZES | {"Mismatch": "mismatch", "gaps": "gaps"} | _PLACE | {"New sequence": "new_sequence"}
_MORE = {"Additional info": "info", "Predicted Sequence": "predicted_sequence"}
REPORT_HEADERS: dict[str, dict[str, str]] = {
    "exact": _HEAD | _NAMES | _ALLELE | {"Query length": "query_length"} | _PLACE | _FOUND,
    "paralog": _HEAD | _NAMES | {"Paralog Tag": "tag", "ID %": "identity"} | _ALLELE | {"Bitscore": "bitscore"} | _PLACE | _FOUND,
    "inferred": _HEAD | {"INF tag": "tag"} | _NEW | {"Predicted Sequence": "predicted_sequence"},
    "asm": _HEAD | {"ASM tag": "tag"} | _NEW | _MORE,
    "alm": _HEAD | {"ALM tag": "tag"} | _NEW | _MORE,
    "plot": _HEAD | _NAMES | _ALLELE | {"Bitscore": "bitscore"} | _PLACE | _FOUND,
    "lnf_tpr": _HEAD | _NAMES | {"Tag": "tag", "Allele": "allele", "Allele Quality": "quality", "ID %": "identity", "Blast sequence coverage %": "hit_coverage", "New sequence coverage %": "new_coverage"} | _SIZES | {"Additional info": "info"},
    "matching_contigs": {"Sample Name": "sample", "Contig": "contig", "Core Gene": "locus", "Allele": "allele", "Contig Start": "contig_start", "Contig Stop": "contig_stop", "Direction": "direction", "Codification": "tag"},
}


def headed(rows: DataFrame, kind: str) -> DataFrame:
    """A report of calling.report or matching_contigs under its fixed headers, in their order; '-' for what it has no value of."""
    none = F.lit("-")
    return rows.select(*[(F.coalesce(F.col(c).cast("string"), none) if c in rows.columns else none).alias(h) for h, c in REPORT_HEADERS[kind].items()])


def write_report(rows: DataFrame, path: str, kind: str) -> None:
    """A report under its fixed headers, ordered by its first two columns."""
    write_table(headed(rows, kind), path, list(REPORT_HEADERS[kind])[:2])


def write_wide(cells: DataFrame, path: str, row: str, column: str, value: str, columns: list[str], head: str) -> None:
    """A wide table as tab-separated lines in order of `row`, with a column for each of `columns`; a cell without a value is empty.

    Lines are made from one sorted array a row, not by a pivot, so columns may be many thousands;
    they are written in ranges of the order as numbered parts, each with the header.
    """
    names = cells.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], f"`{column}` {cells.schema[column].dataType.simpleString()}, _place int")
    placed = cells.select(row, column, F.col(value).cast("string").alias("_value")).join(names, column)
    lines = placed.groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("_place", F.coalesce("_value", F.lit(""))))).alias("_cells"))
    every = F.transform(F.sequence(F.lit(0), F.lit(len(columns) - 1)), lambda i: F.coalesce(F.try_element_at("_cells", i), F.lit(""))) if columns else F.array().cast("array<string>")
    text = F.array_join(F.concat(F.array(F.col(row).cast("string")), every), "\t").alias("\t".join([head, *map(str, columns)]))
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(parts, row).sortWithinPartitions(row).select(text)
    ordered.write.csv(path, sep="\x01", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_matrix(calls: DataFrame, path: str, loci: list[str]) -> None:
    """The wide matrix: a row per sample, a column per locus."""
    write_wide(calls, path, "sample", "locus", "tag", loci, "Sample Name")


def write_distances(distances: DataFrame, path: str, samples: list[str]) -> None:
    """The square matrix of distances."""
    write_wide(distances, path, "sample_1", "sample_2", "distance", samples, "sample_1")


def write_summary(calls: DataFrame, path: str) -> None:
    write_table(summary(calls).select(F.col("sample").alias("File"), *[F.col(f"`{c}`") for c in SUMMARY_CLASSES]), path, ["File"])


def write_each(rows: DataFrame, path: str) -> None:
    """A folder per locus and sample, for alignments and proteins."""
    rows.write.partitionBy("locus", "sample").csv(path, sep="\t", header=True)
