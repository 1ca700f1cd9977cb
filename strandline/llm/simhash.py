"""SimHash near-dedup: fingerprints within a few bits of each other, by a segment-popcount embedding.

A fingerprint's bit is 1 if it is set in over half of the XXH64 of the text's word shingles. The
embedding of a fingerprint is its number of ones in each of 32 segments of two bits; the Manhattan
distance of two embeddings never exceeds the differing bits. Two fingerprints at d <= 3 bits have
one half of 16 segments with a Manhattan distance of at most 1, so the range join is laid over a
unit grid of each half: a fingerprint stands in the cell of its half and asks in the cells one
step up in each segment (the lower of two asks, so a pair meets once a half). In a cell the distance
over all 32 segments goes first, as the lower bound, and then the bits are compared.

Fingerprints are joined, not documents: copies meet in one fingerprint. What a cell yields is a
spanning forest of its links, never all its pairs, and components are found from those. A
cell of more than BLOCK fingerprints is cut into blocks, and every two blocks meet in a task of
their own, so that a cell is never larger than memory and no link is lost.

Defined cases: a null text is empty; a text without words has fingerprint zero and is linked like
any other; one of fewer words than a shingle has one shingle, all its words; repeated rows are
rows of one fingerprint; component_id is the smallest doc_id that is not null, null if there is none; an empty
table gives no rows; other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import _text
from strandline.llm._components import components
from strandline.llm._shared import durable, join_counted, partitions_for, text_or_empty

SEED = 42
SHINGLE = 3
#: Differing bits at which fingerprints are linked; the grid below holds for up to 3.
DISTANCE = 3
#: Fingerprints that stand in a cell, and about as many that ask in it, in one task.
BLOCK = 1 << 14
#: Pairs that are compared at once.
PAIRS = 1 << 20

_PAIR_ONES = np.uint64(0x5555555555555555)


def _ones(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of each stretch of hashes (from one start to the next) have each bit, lowest first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int32)


def _bits(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _shingles(words: list[bytes], size: int) -> list[int]:
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    return [digest(text[i:j], SEED) for i, j in zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)]


def _long(text: bytes, size: int) -> int:
    """The fingerprint of one long text, piece by piece; a piece ends at white space and hands its last words on."""
    ones, n, held = np.zeros(64, np.int64), 0, []
    for piece in _text.pieces(text):
        words = held + piece.split()
        hashes = _shingles(words, size) if len(words) >= size else []
        if hashes:
            ones += _ones(np.array(hashes, np.uint64), np.zeros(1, np.int64))[0]
            n += len(hashes)
        held = words[-(size - 1) :] if size > 1 else []
    if not n:
        hashes = _shingles(held, size)
        return hashes[0] if hashes else 0
    return int(_bits(ones[None], np.array([n]))[0])


def simhashes(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """Fingerprints of texts as unsigned 64-bit numbers."""
    data, offsets = _text.strings(texts)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for lo, hi in _text.blocks(offsets):
        if offsets[hi] - offsets[lo] > 2 * _text.BLOCK:
            out[lo] = _long(data[offsets[lo] : offsets[hi]].tobytes().lower(), size)
            continue
        hashes: list[int] = []
        ends = []
        low = data[offsets[lo] : offsets[hi]].tobytes().lower()
        for i in range(lo, hi):
            hashes += _shingles(low[offsets[i] - offsets[lo] : offsets[i + 1] - offsets[lo]].split(), size)
            ends.append(len(hashes))
        n = np.diff([0, *ends])
        some = np.flatnonzero(n)
        if len(some):
            starts = np.array([0, *ends])[some]
            out[lo + some] = _bits(_ones(np.array(hashes, np.uint64), starts), n[some])
    return out


def embedding(half: Column) -> Column:
    """The ones of each two-bit segment of half a fingerprint (below 2^32), as a two-bit number in the segment's place."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))


def _thermometer(fp: np.ndarray) -> np.ndarray:
    """The embedding with each segment's 0, 1, 2 as 00, 01, 11: the ones of two such codes' XOR are their Manhattan distance."""
    low, high = fp & _PAIR_ONES, (fp >> np.uint64(1)) & _PAIR_ONES
    return (low | high) | (low & high) << np.uint64(1)


def _forest(stand: np.ndarray, ask: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two sets of fingerprints (or, if equal, within one).

    Every node is compared only with those that are not of its tree yet: those that it reaches at
    once leave the rest, so that a dense cell costs about its size times what is not yet reached.
    """
    found: list[tuple[int, int]] = []
    left = {0: np.unique(stand), 1: np.unique(ask)}
    codes = {k: _thermometer(v) for k, v in left.items()}
    one = len(left[0]) == len(left[1]) and bool((left[0] == left[1]).all())
    if one:
        left[1], codes[1] = left[0], codes[0]

    def take(side: int, x: np.uint64) -> np.ndarray:
        """Those left on a side that are linked with x; they are left no more."""
        own = np.flatnonzero(np.bitwise_count(codes[side] ^ _thermometer(x)) <= most)
        own = own[np.bitwise_count(left[side][own] ^ x) <= most]
        near = left[side][own]
        left[side], codes[side] = np.delete(left[side], own), np.delete(codes[side], own)
        if one:
            left[1 - side], codes[1 - side] = left[side], codes[side]
        return near

    while len(left[0]) and len(left[1]):
        first = left[0][0]
        left[0], codes[0] = left[0][1:], codes[0][1:]
        if one:
            left[1], codes[1] = left[0], codes[0]
        front = [(0, first)]
        while front and (len(left[0]) or len(left[1])):
            side, x = front.pop()
            near = take(0 if one else 1 - side, x)
            found += [(int(x), int(y)) for y in near if x != y]
            front += [(0 if one else 1 - side, y) for y in near]
    return found


def _small(at: np.ndarray, fp: np.ndarray, asks: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in small cells, all of them at once: at has the first row of each cell and the end, standing rows first."""
    n = np.diff(at)
    row = np.repeat(np.arange(len(n)), n)
    stands = np.bincount(row[~asks], minlength=len(n))
    place = np.arange(len(fp)) - at[row]
    # a standing row meets those after it, in its cell, asking ones too
    times = np.where(asks, 0, n[row] - 1 - place)
    some = np.flatnonzero((times > 0) & (stands[row] > 0))
    x = np.repeat(some, times[some])
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(times[some]) - times[some], times[some])
    code = _thermometer(fp)
    near = np.bitwise_count(code[x] ^ code[y]) <= most
    x, y = x[near], y[near]
    near = (np.bitwise_count(fp[x] ^ fp[y]) <= most) & (fp[x] != fp[y])
    return fp[x[near]], fp[y[near]]


def _links(cells: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], most: int) -> Iterator[pa.RecordBatch]:
    """Links from (cell, fingerprint, asks) sorted by cell with standing rows first; a cell may reach over batches."""

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (np.minimum(a, b), np.maximum(a, b))], names=["a", "b"])

    def whole(cell: np.ndarray, fp: np.ndarray, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.concatenate([[0], np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1, [len(cell)]]) if len(cell) else np.zeros(1, np.int64)
        n = np.diff(at)
        large = np.flatnonzero(n > 64)
        for i in large.tolist():
            own, asked = fp[at[i] : at[i + 1]], asks[at[i] : at[i + 1]]
            pairs = _forest(own[~asked], own[~asked], most) + _forest(own[~asked], own[asked], most)
            if pairs:
                yield out(*np.array(pairs, np.uint64).T)
        rest = np.repeat(n <= 64, n)
        fp, asks, n = fp[rest], asks[rest], n[n <= 64]
        at = np.concatenate([[0], np.cumsum(n)])
        cost = np.concatenate([[0], np.cumsum(n * n)])
        lo = 0
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(cost, cost[lo] + PAIRS, side="right")) - 1)
            yield out(*_small(at[lo : hi + 1] - at[lo], fp[at[lo] : at[hi]], asks[at[lo] : at[hi]], most))
            lo = hi

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for own in cells:
        if not len(own[1]):
            continue
        if held and not (held[0][0][0] == own[0][-1]).all():
            cut = int(np.flatnonzero((own[0] != own[0][-1]).any(axis=1))[-1]) + 1 if (own[0] != own[0][-1]).any() else 0
            yield from whole(*(np.concatenate([h[i] for h in held] + [own[i][:cut]]) for i in range(3)))
            held = []
            own = tuple(v[cut:] for v in own)
        held.append(own)
    if held:
        yield from whole(*(np.concatenate([h[i] for h in held]) for i in range(3)))


def linked(prints: DataFrame, most: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the fingerprints fp (long, distinct) at `most` (up to 3) bits or fewer, enough for their components."""
    if not 0 <= most <= 3:
        raise ValueError("the grid of two halves holds for up to 3 bits")
    halves = [F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)]
    cells = F.array(*[F.struct(F.lit(i).alias("half"), embedding(h).alias("cell")) for i, h in enumerate(halves)])
    stand = prints.select("fp", F.explode(cells).alias("h")).select("fp", "h.half", "h.cell")
    room = lambda i: F.shiftright("cell", 2 * i).bitwiseAND(F.lit(3)) < 2
    steps = F.explode(F.array_compact(F.array(*[F.when(room(i), F.col("cell") + F.lit(1 << 2 * i)) for i in range(16)]))).alias("cell")
    rows = stand.withColumn("asks", F.lit(False)).unionByName(stand.select("fp", "half", steps, F.lit(True).alias("asks")))
    # blocks of cells that are large, and of the askers of cells beside those of which 16 can be more than a block
    sizes = durable(stand.groupBy("half", "cell").agg(F.count("*").alias("n")).filter(F.col("n") * 16 > block), "cells")
    asked = sizes.select("half", steps, "n").groupBy("half", "cell").agg(F.sum("n").alias("n_asks"))
    large = sizes.filter(F.col("n") > block).join(asked, ["half", "cell"], "full")
    parts = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / block).cast("int")
    large = durable(large.select("half", "cell", F.greatest(parts("n"), F.lit(1)).alias("s"), (parts("n_asks") + 1).alias("a")), "large")
    rows = rows.join(large, ["half", "cell"], "left").fillna({"s": 1, "a": 1})
    mark = F.xxhash64("fp", F.lit(7))
    own = F.pmod(mark, F.when(F.col("asks"), F.col("a")).otherwise(F.col("s"))).cast("int")
    rows = rows.select("half", "cell", "fp", "asks", "s", "a", own.alias("own"))
    # unit (x, y): block x stands; block y < x of those that stand asks, or block y - x of those that ask
    unit = lambda x, y, asks: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(asks).alias("asks"))
    stands_in = F.transform(F.sequence(F.lit(0), F.col("own") + F.col("a") - 1), lambda y: unit(F.col("own"), y, False))
    asks_too = F.when(F.col("own") + 1 < F.col("s"), F.transform(F.sequence(F.col("own") + 1, F.col("s") - 1), lambda x: unit(x, F.col("own"), True))).otherwise(F.array().cast("array<struct<x:int,y:int,asks:boolean>>"))
    asks_in = F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda x: unit(x, x + F.col("own"), True))
    rows = rows.select("half", "cell", "fp", F.explode(F.when(F.col("asks"), asks_in).otherwise(F.concat(stands_in, asks_too))).alias("u"))
    rows = rows.select("half", "cell", "u.x", "u.y", "u.asks", "fp")
    rows = rows.repartition(partitions_for(prints.sparkSession), "half", "cell", "x", "y").sortWithinPartitions("half", "cell", "x", "y", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for b in batches:
                cell = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("half", "cell", "x", "y")], axis=1)
                yield cell, b.column("fp").to_numpy().view(np.uint64), b.column("asks").to_numpy(zero_copy_only=False)

        yield from _links(columns(), most)
        _text.release()

    return rows.mapInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, most: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of each document row, fp the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(simhashes(b.column(1), size).view(np.int64))], names=["doc_id", "fp"])
        _text.release()

    rows = durable(rows.mapInArrow(run, "doc_id long, fp long"), "fingerprints")
    prints = durable(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "prints")
    roots = components(linked(prints.select("fp"), most)).withColumnRenamed("node", "fp")
    rooted = durable(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = durable(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members")), "least")
    named = durable(join_counted(rooted.select("fp", "n", "root"), least, "root", "members", "inner").select("fp", "n", "component_id"), "named")
    return join_counted(rows, named, "fp", "n", "inner").select("doc_id", "fp", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of each document row."""
    out = simhash_groups(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
