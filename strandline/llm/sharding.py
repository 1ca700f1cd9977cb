"""Sharding by a two-pass external shuffle.

The first pass scatters records by seeded hashes: a document's shard is the one whose hash with the
doc_id is highest (one more shard takes rows only into itself), and within the shard it goes to
one of as many buckets as the shard needs to keep a bucket near BUCKET_BYTES. The second pass puts
each bucket, one at a time, into a Fisher-Yates shuffle of its own seed and writes it. A task takes
consecutive buckets of about TASK_BYTES together (fewer while there are not yet a few tasks a core), so
that neither tasks nor files grow to one a bucket. Slots number a shard's records through its buckets.
The shard depends on doc_id and the number of shards alone (law `key`); the bucket also on the text
and the row's place, so repeated rows spread over their shard's buckets. Which task takes a bucket
changes nothing in the order of records.

Defined cases: a null text has size 1 and crc 0; a null doc_id is a key of its own; repeated rows
share a shard; an empty table writes no file. Input columns named shard, bucket or place are
replaced, all others kept. Reading order must be repeatable (files are), as lost tasks are run again.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strandline.llm._shared import scratch_dir

SHARDS = 16
SEED = 20_240_229
BUCKET_BYTES = 16 << 20
TASK_BYTES = 512 << 20

_MADE = ("shard", "bucket", "place")


def shard_of(key: Column, n: int) -> Column:
    """The shard among n whose hash with the key is highest."""
    return F.array_max(F.array(*[F.struct(F.xxhash64(F.lit(f"shard {s}"), key).alias("h"), F.lit(s).alias("s")) for s in range(n)]))["s"]


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _kept(docs: DataFrame) -> list[T.StructField]:
    return [f for f in docs.schema.fields if f.name.lower() not in _MADE]


def write_shards(docs: DataFrame, folder: str, n_shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write docs below folder as shard=K/ files, with bucket and place (the order within a shard)."""
    kept = _kept(docs)
    rows = docs.select(F.struct(*[f"`{f.name}`" for f in kept]).alias("row"))
    scattered = rows.withColumn("shard", shard_of(F.col("row.doc_id"), n_shards))
    held = dict(scattered.groupBy("shard").agg(F.sum(record_size(F.col("row.text")))).collect())  # n_shards rows at most
    buckets = [max(1, -(-held.get(s, 0) // bucket_bytes)) for s in range(n_shards)]
    first = [0, *itertools.accumulate(buckets)]
    at = (F.col("shard") + 1).cast("int")
    deal = F.xxhash64(F.lit(seed), F.col("row.doc_id"), F.col("row.text"), F.monotonically_increasing_id())
    own = F.element_at(F.array(*map(F.lit, first)), at) + F.pmod(F.col("deal"), F.element_at(F.array(*map(F.lit, buckets)), at)).cast("int")
    scattered = scattered.withColumn("deal", deal).withColumn("bucket", own)
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType())])

    def fisher_yates(key: tuple, table: pa.Table) -> pa.Table:
        table = table.take(np.argsort(table.column("deal").to_numpy(), kind="stable"))
        order = np.random.default_rng([seed, key[0].as_py()]).permutation(table.num_rows)
        return table.take(order).append_column("place", pa.array(np.arange(len(order)))).select(out.names)

    cores = docs.sparkSession.sparkContext.defaultParallelism
    together = max(1, min(TASK_BYTES // bucket_bytes, first[-1] // (4 * cores)))
    dealt = scattered.withColumn("task", F.floor(F.col("bucket") / together).cast("int"))
    dealt = dealt.repartitionById(-(-first[-1] // together), "task")
    shuffled = dealt.groupBy("task", "bucket").applyInArrow(lambda key, table: fisher_yates(key[1:], table), out)
    shuffled.select("row.*", *_MADE).sortWithinPartitions("shard", "bucket", "place").write.partitionBy("shard").parquet(folder)


def read_shards(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """The written records of docs with shard, bucket and place."""
    schema = T.StructType([*_kept(docs), T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(folder)


def with_slots(records: DataFrame, written: DataFrame) -> DataFrame:
    """records, rows of written or made from them, with slot, the record's number in its shard, for bucket and place."""
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = written.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    return records.join(offsets, "bucket").withColumn("slot", F.col("before") + F.col("place")).drop("before", "place", "bucket")


def shard_report(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """One row per written record: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "shards")
    docs = docs.select("doc_id", "text")
    write_shards(docs, folder, n_shards)
    written = read_shards(spark, folder, docs)
    digests = written.select(  # before the join, which then moves no text
        "doc_id", record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "bucket", "place",
        shard_of(F.col("doc_id"), n_shards + 1).alias("grown_shard"),
    )
    return with_slots(digests, written).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
