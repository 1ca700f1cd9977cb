"""Line dedup over levelled sorted runs of line hashes.

Lines are reduced to 128-bit hashes of their keys. Batches of documents, in descending order of
doc_id, go one by one against the runs: a batch's keys merge-anti-join every run, and only keys that
no run knows are added, as a run of their own that names each key's keeper, the largest doc_id of
the first batch to hold it. So no key is in two runs. How often every key occurs is kept
beside the runs, in tables of counts. Both are hashed into buckets and sorted; when a level holds
FANOUT tables they are compacted into one of the next level, so a batch meets a logarithmic number of
runs, and buckets meet buckets without a shuffle. Counting is pre-aggregated before each shuffle, so
a line that a third of all documents share costs one row a task.

Defined cases: a null or empty text is one empty line; each row is a document, also where doc_ids
repeat (all rows with the largest id keep the line); a null doc_id orders before all others; an
empty table gives an empty result. A document that loses all lines stays, with an empty text.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm._shared import partitions_for, remove, scratch_dir

MIN_DOCS = 3
MIN_CHARS = 20
BATCHES = 4
FANOUT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STRIPPED = " \t\n\x0b\x0c\r"
_KEY = ["h1", "h2"]
_LEAST = -(1 << 63)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_STRIPPED)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class SortedTables:
    """Tables of one row a key, bucketed and sorted by it, in levels below a shared folder."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, value: str, total: Column):
        """value: the column beside the key; total: its value from `value` and `other` of two tables, null where a key is missing."""
        self.spark, self.folder, self.buckets, self.value, self.total = spark, folder, buckets, value, total
        self.levels: dict[int, list[str]] = defaultdict(list)

    @property
    def names(self) -> list[str]:
        return [x for level in self.levels.values() for x in level]

    def write(self, rows: DataFrame, level: int = 0) -> DataFrame:
        """rows, one a key, as a new table."""
        name = f"lines_{uuid.uuid4().hex}"
        self.levels[level].append(name)
        rows.write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", f"{self.folder}/{name}").saveAsTable(name)
        return self.spark.table(name)

    def compact(self) -> None:
        """Merge the tables of each full level into one of the next."""
        level = 0
        while len(self.levels[level]) >= FANOUT:
            old = self.levels[level]
            self.write(self._merge(old), level + 1)
            self.levels[level] = []
            for name in old:
                self._drop(name)
            level += 1

    def merged(self) -> DataFrame:
        """All keys."""
        return self._merge(self.names)

    def drop(self) -> None:
        for name in self.names:
            self._drop(name)
        self.levels.clear()

    def _merge(self, names: list[str]) -> DataFrame:
        """Full merge joins; buckets meet buckets."""

        def two(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnRenamed(self.value, "other").hint("merge")
            return a.join(b, _KEY, "full").select(*_KEY, self.total.alias(self.value))

        return reduce(two, [self.spark.table(x).select(*_KEY, self.value) for x in names])

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, f"{self.folder}/{name}")


class LineRuns:
    """What is known of lines: runs (h1, h2, keeper), each key in one of them, and counts (h1, h2, n_docs)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        # no key is in two runs: the anti-joins of add() see to that, and a merge takes what there is
        self.runs = SortedTables(spark, folder, buckets, "keeper", F.coalesce("keeper", "other"))
        self.counts = SortedTables(spark, folder, buckets, "n_docs", F.coalesce("n_docs", F.lit(0)) + F.coalesce("other", F.lit(0)))

    @property
    def levels(self) -> dict[int, list[str]]:
        return self.runs.levels

    def add(self, keys: DataFrame) -> None:
        """Add a batch's keys (h1, h2, n_docs, keeper), one row a key: all to the counts, new ones as a run."""
        new = self.counts.write(keys).select(*_KEY, "keeper")
        for name in self.runs.names:
            new = new.join(self.runs.spark.table(name).select(*_KEY).hint("merge"), _KEY, "left_anti")
        self.runs.write(new)
        self.counts.compact()
        self.runs.compact()

    def merged(self) -> DataFrame:
        """All keys with their counts and keepers."""
        return self.counts.merged().join(self.runs.merged().hint("merge"), _KEY)

    def drop(self) -> None:
        self.runs.drop()
        self.counts.drop()


def _digests(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, text_hash, at, first, h1, h2) for every line long enough: its place from 0, and whether it is its key's first in the text."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    stripped = F.transform(_lines(F.col("text")), lambda x, i: F.struct(F.btrim(x, F.lit(_STRIPPED)).alias("x"), i.alias("at")))
    keyed = F.transform(F.filter(stripped, lambda s: F.length(s["x"]) >= min_chars), lambda s: F.struct(F.translate(s["x"], _UPPER, _LOWER).alias("k"), s["at"].alias("at")))
    hashed = F.transform(keyed, lambda s: F.struct(F.xxhash64(s["k"]).alias("h1"), F.xxhash64(F.lit("second"), s["k"]).alias("h2"), s["at"].alias("at")))
    found = ids.select("id", "text_hash", F.sort_array(hashed).alias("found"))
    before = F.concat(F.slice("found", 1, 1), F.slice("found", F.lit(1), F.greatest(F.size("found") - 1, F.lit(0))))
    marked = F.zip_with("found", before, lambda s, b: F.struct(s["h1"].alias("h1"), s["h2"].alias("h2"), s["at"].alias("at"), ((s["at"] == b["at"]) | (s["h1"] != b["h1"]) | (s["h2"] != b["h2"])).alias("first")))
    # outer: the planner would otherwise compute the lines a second time to test that there are any
    return found.select("id", "text_hash", F.explode_outer(marked).alias("l")).filter("l IS NOT NULL").select("id", "text_hash", "l.*")


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(id, text_hash, lost): for each (doc_id, text) that loses lines, their places in the text, ascending."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "lines")
    cuts = [] if batches < 2 else docs.select(F.col("doc_id").cast("long").alias("id")).approxQuantile("id", [i / batches for i in range(1, batches)], 0.01)
    batch = reduce(lambda a, c: a + F.when(F.col("id") <= F.lit(int(c)), 1).otherwise(0), cuts, F.lit(0))
    _digests(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/digests")
    digests = spark.read.schema("id long, text_hash long, h1 long, h2 long, at int, first boolean, batch int").parquet(f"{folder}/digests")
    runs = LineRuns(spark, folder, partitions_for(spark))
    try:
        for b in range(len(cuts) + 1):  # batch 0 has the largest ids
            runs.add(digests.filter((F.col("batch") == b) & F.col("first")).groupBy(*_KEY).agg(F.count("*").alias("n_docs"), F.max("id").alias("keeper")))
        runs.merged().filter(F.col("n_docs") >= min_docs).select(*_KEY, "keeper").write.parquet(f"{folder}/repeated")
    finally:
        runs.drop()
    repeated = spark.read.schema("h1 long, h2 long, keeper long").parquet(f"{folder}/repeated")
    lost = digests.join(repeated, _KEY).filter(F.col("id") < F.col("keeper"))
    return lost.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("lost"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(row, n_lines, n_dropped, kept): each row of docs as a struct, and its text without repeated lines."""
    lost = repeated_lines(docs.select("doc_id", "text"), min_docs, min_chars, batches)
    text = F.coalesce("row.text", F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).withColumns({"id": F.coalesce(F.col("row.doc_id").cast("long"), F.lit(_LEAST)), "text_hash": F.xxhash64(text)})
    joined = rows.join(lost, ["id", "text_hash"], "left")
    split = joined.select("row", "lost", _lines(F.col("row.text")).alias("lines"))
    # the stretches between lost lines, so that the work grows with the lines and not with lines times losses
    starts = F.concat(F.array(F.lit(0)), F.transform("lost", lambda p: p + 1))
    ends = F.concat("lost", F.array(F.size("lines")))
    stretches = F.zip_with(starts, ends, lambda s, e: F.slice(F.col("lines"), s + 1, e - s))
    whole = F.col("lost").isNull()
    return split.select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.when(whole, F.lit(0)).otherwise(F.size("lost")).cast("long").alias("n_dropped"),
        F.when(whole, text).otherwise(F.array_join(F.flatten(stretches), "\n")).alias("kept"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_lines, n_dropped, kept_sha256."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """docs with the same columns; text has lost its repeated lines and n_chars, where there, follows it."""
    out = dedup_lines(docs, min_docs, min_chars, batches)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("kept").alias(c)
        if c == "n_chars":
            return F.length("kept").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return out.select(*[column(c) for c in docs.columns])
