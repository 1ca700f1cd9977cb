"""Filter interaction audit: what each filter of a cascade removes, in every order of the filters.

A packed bitmap index is made partition by partition: one NumPy bitset for each filter (the rows
that fail it), each label and the rows of each part. For each subset of the filters, which is what
stands before a filter in some order, the rows that pass are the AND-NOT of its bitsets; their
popcounts, for all rows and for each label, are summed over the partitions. Every figure of every
order follows from those 2^k sums a part.

Defined cases: a null text is empty; an empty text has no words, fails A and passes B, C and D; a
null part is the empty string, one part with it; a null doc_id has no smaller id and is none, so
such a row never fails E, and it has no labels; rows repeated with one doc_id are not copies of each
other; of several labels of a document one that says 1 is enough; an empty table has no parts and
gives no rows; other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

import itertools
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text
from strandline.llm._shared import durable, join_counted, text_or_empty

#: Parts whose sums a task holds before it passes them on.
MOST_PARTS = 4096
#: The filters of the audit of web texts, by letter.
WEB_FILTERS = ["A", "B", "C", "D", "E"]

_SIGNS = re.compile(rb"[#$%&*|]")


def failures(text: bytes) -> int:
    """Bits 0 to 3: under 50 words; distinct words under 65 %; capitals over 5 % of the code points; any of #$%&*|."""
    n, seen = 0, set()
    for piece in _text.pieces(text):
        words = piece.split()
        n += len(words)
        seen.update(words)
    distinct = len(seen)
    data = np.frombuffer(text, np.uint8)
    capitals = np.count_nonzero((data >= 65) & (data <= 90))
    points = len(data) - np.count_nonzero((data & 0xC0) == 0x80)
    return (n < 50) | (100 * distinct < 65 * n) << 1 | bool(100 * capitals > 5 * points) << 2 | bool(_SIGNS.search(text)) << 3


def web_failures(docs: DataFrame) -> DataFrame:
    """(part, doc_id, fails) of each document row, fails an int with a bit for each of WEB_FILTERS.

    E, a text that a smaller doc_id has too, is found by the texts' SHA-256: the least id of each
    text that occurs again is joined back, hot texts by a broadcast.
    """
    rows = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = _text.strings(b.column("text"))
            fails = [failures(data[i:j].tobytes()) for i, j in itertools.pairwise(offsets.tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fails, pa.int32())], names=["part", "doc_id", "digest", "fails"])
        _text.release()

    rows = durable(rows.mapInArrow(run, "part string, doc_id long, digest binary, fails int"), "fails")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    rows = join_counted(rows, durable(first, "copies"), "digest", "copies")
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    return rows.select("part", "doc_id", F.col("fails").bitwiseOR(again).alias("fails"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with the booleans good and toxic of their doc_id; false where there is no label."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[(F.col(c) == 1).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    marks = marks.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def _counts(part: pa.Array, fails: np.ndarray, labels: list[np.ndarray], k: int) -> tuple[list[str], np.ndarray]:
    """The parts of some rows and, for each part and subset of the k filters, the rows that pass it: all, and of each label."""
    codes = part.dictionary_encode()
    names, codes = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
    sizes = np.bincount(codes, minlength=len(names))
    words = (sizes + 63) // 64  # every part begins a new word of the bitsets
    starts = np.concatenate([[0], np.cumsum(words)])
    order = np.argsort(codes, kind="stable")
    ranks = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = starts[codes[order]] * 64 + ranks

    def bitset(rows: np.ndarray) -> np.ndarray:
        bits = np.zeros(int(starts[-1]) * 64, bool)
        bits[place] = rows[order]
        return np.packbits(bits).view(np.uint64)

    failing = [bitset((fails >> f) & 1 != 0) for f in range(k)]
    of = [None, *[bitset(x) for x in labels]]
    passing = [bitset(np.ones(len(codes), bool))]
    out = np.zeros((len(names), 1 << k, len(of)), np.int64)
    for s in range(1 << k):
        if s:
            low = (s & -s).bit_length() - 1
            passing.append(passing[s & (s - 1)] & ~failing[low])
        for i, own in enumerate(of):
            bits = passing[s] if own is None else passing[s] & own
            out[:, s, i] = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), starts[:-1])
    return names, out


def subset_counts(rows: DataFrame, k: int, labels: list[str]) -> DataFrame:
    """(part, subset, passed, passed_<label>...) from rows(part string, fails int, labels boolean): one row for each part and subset of the k filters, a bit mask."""
    made = ["passed", *[f"passed_{x}" for x in labels]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            values = np.concatenate(list(held.values())) if held else np.zeros((0, len(made)), np.int64)
            names = pa.array(list(held), pa.string()).take(pa.array(np.repeat(np.arange(len(held)), 1 << k)))
            subsets = pa.array(np.tile(np.arange(1 << k, dtype=np.int32), len(held)))
            held.clear()
            return pa.RecordBatch.from_arrays([names, subsets, *[pa.array(values[:, i]) for i in range(len(made))]], names=["part", "subset", *made])

        for b in batches:
            if b.num_rows:
                flags = [b.column(x).to_numpy(zero_copy_only=False) for x in labels]
                names, found = _counts(b.column("part"), b.column("fails").to_numpy(zero_copy_only=False), flags, k)
                for name, x in zip(names, found, strict=True):
                    held[name] = held[name] + x if name in held else x
            if len(held) >= MOST_PARTS:
                yield out()
        yield out()

    each = rows.select("part", "fails", *labels).mapInArrow(run, T.StructType([T.StructField("part", T.StringType()), T.StructField("subset", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in made]]))
    return each.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in made])


def interaction_audit(rows: DataFrame, filters: list[str], labels: list[str]) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, <label>_lost and shapley.

    rows(part string, fails int, labels boolean); bit i of fails says that the row fails filters[i].
    """
    k = len(filters)
    full = (1 << k) - 1
    counts = subset_counts(rows, k, labels)
    of_part = counts.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", *counts.columns[2:]))).alias("c"))  # 2^k entries
    at = lambda mask, name="passed": F.get("c", mask)[name]
    steps = [{"o": "".join(filters[f] for f in order), "step": i + 1, "f": f, "before": sum(1 << x for x in order[:i])} for order in itertools.permutations(range(k)) for i, f in enumerate(order)]
    weighed = []
    for f in range(k):
        others = [m for m in range(full + 1) if not m >> f & 1]
        terms = [(at(F.lit(m)) - at(F.lit(m | 1 << f))) * (math.factorial(m.bit_count()) * math.factorial(k - 1 - m.bit_count())) for m in others]
        weighed.append(sum(terms[1:], terms[0]))
    of_part = of_part.withColumn("shapley", F.array(*weighed))
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<o:string,step:int,f:int,before:int>>")
    each = of_part.withColumn("s", F.explode(plan))
    before, after, bit = F.col("s.before"), F.expr("s.before | shiftleft(1, s.f)"), F.expr("shiftleft(1, s.f)")
    removed = at(before) - at(after)
    return each.select(
        "part", F.col("s.o").alias("filter_order"), F.col("s.step").alias("step"), at(after).alias("kept"), removed.alias("removed"),
        (at(F.lit(0)) - at(bit) - removed).alias("redundant"), (at(F.lit(full) - bit) - at(F.lit(full))).alias("unique_fails"),
        *[(at(before, f"passed_{x}") - at(after, f"passed_{x}")).alias(f"{x}_lost") for x in labels], F.get("shapley", F.col("s.f")).alias("shapley"),
    )


def filter_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of WEB_FILTERS over documents, with what each step loses of good and toxic ones."""
    return interaction_audit(with_labels(web_failures(docs), labels), WEB_FILTERS, ["good", "toxic"])
