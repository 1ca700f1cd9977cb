"""Plumbing that the operators share: Arrow columns and filters, joins on keys that may be hot."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text
from strandline.storage import clear_scratch, durable, remove, scratch_dir, shared_folder, written  # noqa: F401

#: A key with more than one in HEAVY of all rows is heavy; there are fewer than HEAVY of them.
HEAVY = 2048
#: Places of a filter of marks, which has a bit for each: 8 MB.
MARKS = 1 << 26


def arrow_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column, or a field of a struct column as in row.text."""
    top, _, field = name.partition(".")
    return batch.column(top).field(field) if field else batch.column(top)


def append_columns(
    df: DataFrame, fields: list[T.StructField], fn: Callable[[pa.RecordBatch], list[pa.Array]], keep: Iterable[str] | None = None
) -> DataFrame:
    """df with the columns that fn makes for each Arrow batch; same-named columns of df are replaced.

    With keep only those columns of df come back from Python.
    """
    new = {f.name.lower() for f in fields}
    only = None if keep is None else {k.lower() for k in keep}
    kept = [f for f in df.schema.fields if f.name.lower() not in new and (only is None or f.name.lower() in only)]
    at = [i for i, f in enumerate(df.schema.fields) if f in kept]
    names = [f.name for f in kept] + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in at], *fn(b)], names=names)
        _text.release()

    return df.mapInArrow(run, T.StructType(kept + fields))


def keep_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The rows of df for which fn, called on each Arrow batch, holds; the others do not leave Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(fn(b))
        _text.release()

    return df.mapInArrow(run, df.schema)


def marks(values: DataFrame, of: F.Column) -> np.ndarray:
    """The places of longs, their remainders by MARKS, as bits: a filter of fixed size for a broadcast."""
    place = F.pmod(of, F.lit(MARKS).cast("long")) + 1
    pieces = values.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(MARKS // 8, np.uint8)
    for piece, found in pieces.collect():  # MARKS bits at most, whatever the number of values
        bits[(piece - 1) * len(found) : piece * len(found)] = np.frombuffer(found, np.uint8)
    return bits


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each long's place is marked: it is for all that were marked, and for few others while there are few marks."""
    place = values & (8 * len(bits) - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def join_counted(rows: DataFrame, table: DataFrame, key: str, size: str, how: str = "left") -> DataFrame:
    """rows joined with table, which has one row a key and in `size` the number of rows with that key.

    Keys with more than one in HEAVY of all rows are joined by a broadcast of their fewer than
    HEAVY table rows, so that no task gets all rows of a hot key; the others by a merge, also where
    table is small, so that the plan is the same at every size. table should be a written one: it is
    read three times.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    heavy = F.broadcast(table.filter(F.col(size) * HEAVY > F.lit(total)))
    hot = rows.join(heavy, key)
    rest = rows.join(heavy.select(key), key, "left_anti").join(table.filter(F.col(size) * HEAVY <= F.lit(total)).hint("merge"), key, how)
    return hot.unionByName(rest)


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    """The session's number of shuffle partitions, and least at the least."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> F.Column:
    return F.coalesce(F.col(col), F.lit(""))
