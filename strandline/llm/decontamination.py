"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Benchmark texts are cut into windows of n words in tasks; their hashes become sorted arrays, with a
bitmap before them and the normalised words beside them. Each document's windows are hashed in numpy
and looked up, and every hit is verified word by word.

What is broadcast is checked by its own size (arrays and words, not the benchmark's text): up to
MOST_BYTES it is one index. A larger benchmark is dealt into indexes of that size, one after
another. Documents are then numbered and written once, each index makes a table of hits alone, and
these are joined in the end: the documents are read once for each index but written once. A long
item is cut into segments of windows, so no item is too long.

Defined cases: a null or empty text has no words and no hits; a null item_id marks hits but is
not listed among items; repeated item rows count once; an empty benchmark leaves all clean;
repeated document rows are handled row by row. Columns of the input with the names of result
columns (n_words, hit_spans, hit_items) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text
from strandline.llm._shared import append_columns, arrow_column, durable, keep_rows

N = 10
#: Bytes of an index that may be broadcast at once.
MOST_BYTES = 64 << 20
#: Windows of one item that make a row on the way to an index.
SEGMENT = 1 << 14

_SPAN = T.StructType(
    [T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
     T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)
_SPANS_ARROW = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_N_WORDS, _HITS = T.StructField("n_words", T.LongType()), [T.StructField("hit_spans", T.ArrayType(_SPAN)), T.StructField("hit_items", T.ArrayType(T.StringType()))]
_SEGMENT = "item_id string, size int, words binary, hashes binary, starts binary, ends binary"
_BITS = 22

Span = tuple[int, int, int, int]


def _segments(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows of _SEGMENT: the windows of each item as hashes and as places in its words, joined by spaces."""
    names = [x.split()[0] for x in _SEGMENT.split(", ")]
    for batch in batches:
        rows = []
        for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
            w = _text.words(*_text.strings(pa.array([text.as_py()], pa.string())))
            size = min(n, len(w.start))
            wins = _text.windows(w.hashes(), size) if size else []
            for lo in range(0, len(wins), SEGMENT):
                hi = min(lo + SEGMENT, len(wins))
                own = [w.word(i) for i in range(lo, hi + size - 1)]
                at = np.concatenate([[0], np.cumsum([len(x) + 1 for x in own])])
                starts, ends = at[: hi - lo], at[size : size + hi - lo] - 1
                rows.append((item_id, size, b" ".join(own), wins[lo:hi].tobytes(), starts.astype("<u4").tobytes(), ends.astype("<u4").tobytes()))
        kinds = [pa.string(), pa.int32(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


class _Index:
    """Windows of a part of the benchmark: for each window length sorted hashes, places of their words, item numbers."""

    def __init__(self, segments: list[Row]):
        self.ids = sorted({s.item_id for s in segments}, key=lambda x: (x is not None, x))
        number = {x: i for i, x in enumerate(self.ids)}
        self.words = b"".join(s.words for s in segments)
        base = np.concatenate([[0], np.cumsum([len(s.words) for s in segments])])
        self.lengths = []
        for size in sorted({s.size for s in segments}):
            own = [(i, s) for i, s in enumerate(segments) if s.size == size]
            keys = np.concatenate([np.frombuffer(s.hashes, np.uint64) for _, s in own])
            starts = np.concatenate([np.frombuffer(s.starts, "<u4") + base[i] for i, s in own])
            ends = np.concatenate([np.frombuffer(s.ends, "<u4") + base[i] for i, s in own])
            items = np.concatenate([np.full(len(s.hashes) >> 3, number[s.item_id], np.int32) for _, s in own])
            order = np.lexsort((items, keys))
            keys, starts, ends, items = keys[order], starts[order], ends[order], items[order]
            again = np.flatnonzero((keys[1:] == keys[:-1]) & (items[1:] == items[:-1])) + 1
            same = [i for i in again.tolist() if self._at(starts, ends, i) == self._at(starts, ends, i - 1)]
            keys, starts, ends, items = (np.delete(x, same) for x in (keys, starts, ends, items))
            bitmap = np.zeros(1 << _BITS, dtype=bool)
            bitmap[keys >> np.uint64(64 - _BITS)] = True
            self.lengths.append((size, keys, bitmap, starts, ends, items))

    def _at(self, starts: np.ndarray, ends: np.ndarray, i: int) -> bytes:
        return self.words[starts[i] : ends[i]]

    def hits(self, w: _text.Words, h: np.ndarray) -> Iterator[tuple[int, int, set[str | None]]]:
        """(first word, words, item ids) of every verified window, in the words of w."""
        for size, keys, bitmap, starts, ends, items in self.lengths:
            wins = _text.windows(h, size)
            at = np.flatnonzero(bitmap[wins >> np.uint64(64 - _BITS)])
            lo, hi = np.searchsorted(keys, wins[at]), np.searchsorted(keys, wins[at], side="right")
            text = np.searchsorted(w.per_text, at, side="right") - 1
            good = (hi > lo) & (at + size <= w.per_text[text + 1])
            for i, a, b in zip(at[good].tolist(), lo[good].tolist(), hi[good].tolist(), strict=True):
                joined = b" ".join(w.word(k) for k in range(i, i + size))
                ids = {self.ids[items[c]] for c in range(a, b) if self._at(starts, ends, c) == joined}
                if ids:
                    yield i, size, ids


def _scan(column: pa.Array, index: _Index) -> tuple[np.ndarray, list[list[Span]], list[set[str | None]]]:
    """Words, hit spans and items of each text."""
    data, offsets = _text.strings(column)
    n_words = np.zeros(len(offsets) - 1, np.int64)
    spans: list[list[Span]] = [[] for _ in n_words]
    items: list[set[str | None]] = [set() for _ in n_words]
    for lo, hi in _text.blocks(offsets):
        w = _text.words(data, offsets[lo : hi + 1])
        n_words[lo:hi] = np.diff(w.per_text)
        for first, size, ids in index.hits(w, w.hashes()):
            t = int(np.searchsorted(w.per_text, first, side="right")) - 1
            base, last = int(w.per_text[t]), first + size - 1
            start = int(w.start[first] + offsets[lo] - offsets[lo + t])
            end = int(w.end[last] + offsets[lo] - offsets[lo + t])
            spans[lo + t].append((first - base, last - base, start, end))
            items[lo + t] |= ids
    return n_words, spans, items


def _merged(spans: list[Span]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for first, last, start, end in sorted(spans):
        if out and first <= out[-1]["last"]:
            if last > out[-1]["last"]:
                out[-1] |= {"last": last, "end": end}
        else:
            out.append({"first": first, "last": last, "start": start, "end": end})
    return out


def _as_arrow(spans: list[list[Span]], items: list[set[str | None]]) -> list[pa.Array]:
    return [pa.array([_merged(x) for x in spans], _SPANS_ARROW), pa.array([sorted(i for i in x if i is not None) for x in items], pa.list_(pa.string()))]


def _indexes(benchmark: DataFrame, n: int, most_bytes: int) -> tuple[bool, Iterator[_Index]]:
    """Whether one index is enough, and the indexes, of which the driver holds one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    segments = durable(items.mapInArrow(lambda batches: _segments(batches, n), _SEGMENT), "segments")
    size = F.octet_length("words") + 3 * F.octet_length("hashes")  # a window's hash, places and item
    total = segments.agg(F.sum(size)).first()[0] or 0

    def make() -> Iterator[_Index]:
        held, own = 0, []
        for s in segments.toLocalIterator():
            more = len(s.words) + 3 * len(s.hashes)
            if own and held + more > most_bytes:
                yield _Index(own)
                held, own = 0, []
            held += more
            own.append(s)
        yield _Index(own)

    return total <= most_bytes, make()


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text", most_bytes: int = MOST_BYTES, keep: list[str] | None = None) -> DataFrame:
    """docs, or its columns in keep, with n_words, hit_spans and hit_items.

    hit_spans: disjoint spans of hit words, by word numbers (first, last) and by UTF-8 byte
    offsets (start, end) of the text; hit_items: sorted ids, as strings, of items that occur.
    """
    sc = docs.sparkSession.sparkContext
    one, indexes = _indexes(benchmark, n, most_bytes)
    if one:
        index = sc.broadcast(next(indexes))

        def scan(batch: pa.RecordBatch) -> list[pa.Array]:
            n_words, spans, items = _scan(arrow_column(batch, text_col), index.value)
            return [pa.array(n_words), *_as_arrow(spans, items)]

        return append_columns(docs, [_N_WORDS, *_HITS], scan, keep)

    top = text_col.partition(".")[0]
    own = [c for c in docs.columns if c.lower() not in ("n_words", "hit_spans", "hit_items")]
    rows = durable(docs.select(F.struct(*[f"`{c}`" for c in dict.fromkeys([*own, top])]).alias("all"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("number")), "documents")
    found = []
    for index in indexes:
        shared = sc.broadcast(index)

        def hits(batch: pa.RecordBatch, shared=shared) -> list[pa.Array]:
            _, spans, items = _scan(batch.column("text"), shared.value)
            return _as_arrow(spans, items)

        found.append(durable(append_columns(rows.select("number", "text"), _HITS, hits, ["number"]).filter(F.size("hit_spans") > 0), "hits"))
        shared.unpersist()
    both = found[0]
    for f in found[1:]:
        both = both.unionByName(f)
    both = both.groupBy("number").agg(F.flatten(F.collect_list("hit_spans")).alias("s"), F.flatten(F.collect_list("hit_items")).alias("i"))
    joined = rows.join(both, "number", "left").drop("number")

    def merge(batch: pa.RecordBatch) -> list[pa.Array]:
        spans = [[(x["first"], x["last"], x["start"], x["end"]) for x in s or []] for s in batch.column("s").to_pylist()]
        data, offsets = _text.strings(batch.column("text"))
        n_words = [np.diff(_text.words(data, offsets[lo : hi + 1]).per_text) for lo, hi in _text.blocks(offsets)]
        return [pa.array(np.concatenate([np.zeros(0, np.int64), *n_words])), *_as_arrow(spans, [set(i or []) for i in batch.column("i").to_pylist()])]

    out = append_columns(joined, [_N_WORDS, *_HITS], merge, ["all"])
    kept = [c for c in own if keep is None or c in keep]
    return out.select(*[F.col(f"all.`{c}`") for c in kept], "n_words", "hit_spans", "hit_items")


def drop_leaking_documents(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text") -> DataFrame:
    """docs without those in which a window of the benchmark occurs; same columns."""
    one, indexes = _indexes(benchmark, n, MOST_BYTES)
    if one:
        index = docs.sparkSession.sparkContext.broadcast(next(indexes))
        return keep_rows(docs, lambda batch: pa.array([not s for s in _scan(batch.column(text_col), index.value)[1]], pa.bool_()))
    work = docs.select(F.struct("*").alias("row"))
    return find_leaks(work, benchmark, n, f"row.{text_col}").filter(F.size("hit_spans") == 0).select("row.*")


def cut_leaking_spans(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text") -> DataFrame:
    """docs with the hit spans cut out of their texts; same columns."""
    work = docs.select(F.struct("*").alias("row"))

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        kept = []
        for text, spans in zip(arrow_column(batch, f"row.{text_col}").to_pylist(), batch.column("hit_spans").to_pylist(), strict=True):
            if spans:
                raw, parts, at = text.encode(), [], 0
                for s in spans:
                    parts.append(raw[at : s["start"]])
                    at = s["end"]
                text = b"".join([*parts, raw[at:]]).decode()
            kept.append(text)
        return [pa.array(kept, pa.string())]

    out = append_columns(find_leaks(work, benchmark, n, f"row.{text_col}"), [T.StructField("kept_text", T.StringType())], cut)
    return out.select("row.*", "kept_text").select(*[F.col("kept_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def leak_report(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, n, keep=["doc_id"])
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"] + 1).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )
