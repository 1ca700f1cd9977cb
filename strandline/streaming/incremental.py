"""Calling of samples as they arrive: a stream of contigs, called batch by batch into a growing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandline.operators.calling import CallConfig, SchemaIndex, call_alleles, schema_index
from strandline.storage import durable, scratch_scope

CONTIGS = "sample string, contig string, seq string"
#: New sequences with their numbers, by the batch that first showed them.
REGISTRY = "locus string, kind string, final_seq string, idx int"


def stored_index(alleles: DataFrame, references: DataFrame, folder: str, config: CallConfig = CallConfig()) -> SchemaIndex:
    """The schema's index below folder, written there if it is not there yet; a folder belongs to one schema and configuration."""
    spark, made = alleles.sparkSession, schema_index(alleles, references, config)
    tables = {}
    for name in ("first", "weak", "second"):
        table = getattr(made, name)
        table.write.mode("ignore").parquet(f"{folder}/{name}")
        tables[name] = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
    return SchemaIndex(**tables)


def call_batch(batch: DataFrame, number: int, alleles: DataFrame, references: DataFrame, out_path: str, config: CallConfig = CallConfig(), index: SchemaIndex | None = None) -> None:
    """Call the samples of one batch: its calls go to out_path/batch=N, its new sequences to out_path/_registry/batch=N.

    Numbers continue those of the batches before, whatever later ones hold, so a batch that runs
    again writes the same rows over its own. Its intermediate tables are deleted when it is written.
    """
    spark = batch.sparkSession
    registry = f"{out_path}/_registry"
    spark.createDataFrame([], REGISTRY).write.mode("ignore").parquet(f"{registry}/batch=-1")
    with scratch_scope(spark):
        earlier = spark.read.schema(f"{REGISTRY}, batch int").option("basePath", registry).parquet(registry).filter(f"batch < {number}").drop("batch")
        known = durable(earlier, "registry")
        calls = durable(call_alleles(alleles, references, durable(batch, "contigs"), config, index, known).select("sample", "locus", "tag", "kind", "final_seq", "idx"), "batch")
        new = calls.filter("idx IS NOT NULL").select("locus", "kind", "final_seq", "idx").distinct().join(known, ["locus", "kind", "final_seq"], "left_anti")
        new.write.mode("overwrite").parquet(f"{registry}/batch={number}")
        calls.select("sample", "locus", "tag").write.mode("overwrite").parquet(f"{out_path}/batch={number}")


def call_stream(
    spark: SparkSession, contigs_path: str, alleles: DataFrame, references: DataFrame, out_path: str, checkpoint: str, config: CallConfig = CallConfig(), files_per_batch: int | None = None
) -> StreamingQuery:
    """Call every sample whose contigs arrive as Parquet files; a batch's calls are written below out_path/batch=N.

    New sequences are numbered across batches: one that an earlier batch has shown keeps its name.
    With samples that arrive in order, the tags are those of one run over all of them. The schema's words
    are indexed once, in out_path/_index. A batch that runs again after a failure overwrites its
    own folders, so calls are neither lost nor doubled. All contigs of a sample must arrive in one batch.
    """
    reader = spark.readStream.schema(CONTIGS)
    arriving = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(contigs_path)
    index = stored_index(alleles, references, f"{out_path}/_index", config)

    def call(batch: DataFrame, number: int) -> None:
        call_batch(batch, number, alleles, references, out_path, config, index)

    return arriving.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
