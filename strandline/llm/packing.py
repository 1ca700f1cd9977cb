"""Best-fit packing of token sequences with a fixed number of open bins.

Documents are encoded and cut where they lie; only piece descriptions (no ids) are shuffled, into
groups of about GROUP pieces by a hash. Each group is packed by online best-fit: open bins are kept
in a bitset keyed by free space, a piece goes to the fullest open bin that holds it, and when more
than OPEN_BINS are open the fullest one closes. A group is fed its pieces in seeded random order,
ROUND at a time by falling length: long pieces then meet the short ones that fill them up while
their bins are open, and memory does not depend on the group.

Ids come from the tokenizer's own library, unit by unit (see _tokens).

Defined cases: a null or empty text is the end token alone; repeated rows are packed row by row;
an empty table gives no pieces. Ties of the random order are broken by all columns of a piece.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text, _tokens
from strandline.llm._shared import scratch_dir

LENGTH = 1024
END = 2
OPEN_BINS = 8192
#: Pieces that are ordered by length together; at most OPEN_BINS, else bins close before short pieces come.
ROUND = 8192
#: Pieces that one task packs at a time.
GROUP = 250_000

_PIECES = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
     T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
)
_PACKED = T.StructType([*_PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first may be shorter, the others are full."""
    first = n % length or length
    return [(0, min(n, first)), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces of every document (doc_id, text): doc_id, piece, start, length, ids_crc32."""

    last = np.uint32(end).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in _PIECES}
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), _tokens.encoded(b.column("text"), path), strict=True):
                own = ids + last
                for k, (start, n) in enumerate(cut(len(own) >> 2, length)):
                    row = (doc_id, k, start, n, zlib.crc32(memoryview(own)[4 * start : 4 * (start + n)]))
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)], names=list(out))
        _text.release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


def best_fit(lengths: list[int], size: int, open_bins: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each piece, met in the order given."""
    free: dict[int, list[int]] = defaultdict(list)  # open bins by free space
    bits, n_open, n_bins = 0, 0, 0
    bins, offsets = [], []
    for need in lengths:
        fits = bits >> need
        if fits:
            space = need + ((fits & -fits).bit_length() - 1)
            own = free[space].pop()
            if not free[space]:
                bits &= ~(1 << space)
            n_open -= 1
        else:
            space, own = size, n_bins
            n_bins += 1
        bins.append(own)
        offsets.append(size - space)
        if left := space - need:
            free[left].append(own)
            bits |= 1 << left
            n_open += 1
            if n_open > open_bins:  # the fullest closes
                least = (bits & -bits).bit_length() - 1
                free[least].pop()
                if not free[least]:
                    bits &= ~(1 << least)
                n_open -= 1
    return bins, offsets


def pack(pieces_df: DataFrame, size: int = LENGTH, open_bins: int = OPEN_BINS, group: int = GROUP) -> DataFrame:
    """pieces_df with sequence_id and offset."""
    n = max(1, math.ceil(pieces_df.count() / group))
    if n >= 1 << 30:
        raise ValueError(f"{n} groups; raise group above {group}")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("deal", *_PIECES.names)]).select(_PIECES.names)
        lengths = table.column("length").to_numpy()
        order = np.lexsort((-lengths, np.arange(len(lengths)) // ROUND))
        table = table.take(order)
        bins, offsets = best_fit(lengths[order].tolist(), size, open_bins)
        ids = np.array(bins, np.int64) + (key[0].as_py() << 32)
        return table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))

    deal = F.xxhash64(*_PIECES.names, F.monotonically_increasing_id())  # repeated rows are dealt apart
    dealt = pieces_df.withColumn("deal", deal).withColumn("part", F.pmod("deal", F.lit(n)))
    return dealt.groupBy("part").applyInArrow(run, _PACKED)


def packing_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    folder = scratch_dir(docs.sparkSession, "pieces")
    pieces(docs, path or _tokens.tokenizer_path()).write.parquet(folder)
    return pack(docs.sparkSession.read.schema(_PIECES).parquet(folder))
