"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is its sequence of words, and of occurrence-labelled shingles: windows of K words, each with
the number of its earlier occurrences in the document (fewer than K words: one window of them all). For
each of BANDS hash functions the PICK least shingles are put back in text order and hashed: two documents
share such a sketch the likelier the more shingles they hold in the same order. Documents that share a
sketch are aligned word by word: the similarity is 1 - d / max(n, m) for n and m words and an edit distance
of d (insertions, deletions, substitutions of words), found within the band that SIMILARITY allows. Linked
are those at SIMILARITY or more; groups are the connected components.

Texts of equal words are one class from the start, so copies never meet. Sketch buckets that hold the
same classes are visited once. A bucket goes to a task whole up to BLOCK classes. A larger one comes of a
passage that many share: the shingles that half of the members hold in its parts, by parts that have half of
its members (all members count). Its members get AGAIN new sketches
each, from the shingles outside the passages of their large buckets, so that similar ones meet again and pages
alike in a passage alone do not. Those of which a passage is half or more stay in its bucket as well. What is
still larger than BLOCK is dealt into blocks, each with some LEADERS of the bucket and linked in itself; a
class takes part in the largest of its large buckets. All this only finds most links early: then those outside
the largest component of a large bucket, as it was at first or came of the new sketches, meet the members of
all, so that every two that share a sketch are compared. FEW of them at a time are broadcast, and every member
is compared with them where it lies. More than ROUNDS times as many meet whom they may be similar to by an
exact prefix filter: an edit changes two pairs
of neighbouring words, so two documents at SIMILARITY or more share three fifths of their pairs, and, in any
fixed order of pairs, their first two fifths share one. The order puts pairs first that are rare. All
comparisons begin with the number of shared pairs. The tasks return spanning links, never pairs of documents.

Defined cases: texts without words group by equal text (null: empty); repeated rows are classed row
by row; class_id is the least doc_id of the group (null where all are null); an empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strandline.llm import _text
from strandline.llm._components import components
from strandline.llm._shared import durable, join_counted, keep_rows, marked, marks, partitions_for, scratch_dir
from strandline.storage import remove

K = 5
SIMILARITY = 0.8
BANDS = 24
PICK = 2
#: Classes, and bytes of their words, that a task takes of one bucket at a time.
BLOCK = 512
BLOCK_BYTES = 32 << 20
#: Classes, and bytes of their words, that are broadcast at most.
FEW = 4096
FEW_BYTES = 32 << 20
#: Broadcasts, one after another, at most.
ROUNDS = 64
#: New sketches of a member of a large bucket.
AGAIN = 8
#: Classes of a large bucket, about, that stand in each of its blocks.
LEADERS = 32
#: Classes, and the most bytes of words of each, in the sample that orders the word pairs of large buckets.
SAMPLE = 2048
SAMPLE_BYTES = 1 << 14
#: Classes, at least, that a task compares with the few that are broadcast.
ROWS_A_TASK = 64
#: Links that a task puts together before the rounds of the components.
LINKS = 1 << 18
#: Words that an anchor of an alignment has.
ANCHOR = 3
#: Shingles per document and band that are expected under the first cut for the least ones.
_FEW = 32
_SEEDS = _text.mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)

_DIGEST = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("cls", T.BinaryType()), T.StructField("n_words", T.IntegerType()),
     T.StructField("sketches", T.ArrayType(T.LongType())), T.StructField("words", T.BinaryType())]
)
_LINK = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def shingles(h: np.ndarray, per_text: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(occurrence-labelled shingle hashes of all texts, offsets per text) from word hashes."""
    counts = np.diff(per_text)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(offsets[-1], np.uint64)
    text = np.repeat(np.arange(len(n)), n)
    at = per_text[:-1][text] + np.arange(len(out)) - offsets[:-1][text]
    whole = counts[text] >= k
    wins = _text.windows(h, k)
    out[whole] = wins[at[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < k)).tolist():
        out[offsets[i]] = _text.windows(h[per_text[i] : per_text[i + 1]], int(counts[i]))[0]
    order = np.argsort(out, kind="stable")
    s, t = out[order], text[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    if not fresh.all():
        rank = np.arange(len(s))
        occurrence = np.zeros(len(s), np.uint64)
        occurrence[order] = rank - np.maximum.accumulate(np.where(fresh, rank, 0))
        again = occurrence > 0
        out[again] = _text.mix(out[again] + occurrence[again] * np.uint64(0xA0761D6478BD642F))
    return out, offsets


def sketches(s: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of BANDS sketches per text: the PICK least shingles of each band, hashed in text order."""
    n = np.diff(offsets)
    full = np.flatnonzero(n)  # texts with shingles
    out = np.zeros((len(n), BANDS), np.uint64)
    if not len(full):
        return out
    text = np.repeat(np.arange(len(n)), n)
    cut = np.where(n <= 2 * _FEW, float(_MOST), float(_FEW) / np.maximum(n, 1) * 2.0**64)
    cut = np.where(cut >= 2.0**64, _MOST, np.minimum(cut, 2.0**63 * 1.9).astype(np.uint64))
    cuts = cut[text]
    for b in range(BANDS):
        v = (s ^ _SEEDS[b]) * _SEEDS[b]
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        few = np.flatnonzero(v <= cuts)
        got = np.bincount(text[few], minlength=len(n))
        if len(short := np.flatnonzero(got < np.minimum(n, PICK))):  # too few under the cut: take all
            few = np.flatnonzero((v <= cuts) | np.isin(text, short))
        t = text[few]
        order = np.lexsort((v[few], t))
        few, t = few[order], t[order]
        rank = np.arange(len(t)) - np.searchsorted(t, t)
        few = np.sort(few[rank < PICK])  # in text order again
        t = text[few]
        rank = np.arange(len(t)) - np.searchsorted(t, t)
        h = np.zeros(len(n), np.uint64)
        for r in range(PICK):
            own = few[rank == r]
            h[text[own]] = _text.mix(h[text[own]] * np.uint64(0xD6E8FEB86659FD93) + s[own])
        out[:, b] = _text.mix(h + np.uint64(b))
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        data, offsets = _text.strings(batch.column("text"))
        for lo, hi in _text.blocks(offsets):
            w = _text.words(data, offsets[lo : hi + 1])
            h = w.hashes()
            s, at = shingles(h, w.per_text)
            sk = sketches(s, at).view(np.int64)
            n = np.diff(w.per_text)
            small = (h >> np.uint64(32)).astype("<u4")
            words = [small[a:b].tobytes() for a, b in zip(w.per_text[:-1], w.per_text[1:], strict=True)]
            rows = batch.slice(lo, hi - lo)
            cls = [c if k else t for c, k, t in zip(_class_ids(h, w.per_text), n.tolist(), rows.column("text_cls").to_pylist(), strict=True)]
            number += len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number - len(n), number)), rows.column("doc_id"), rows.column("text_hash"), pa.array(cls, pa.binary()), pa.array(n, pa.int32()),
                 pa.array([x if k else [] for x, k in zip(sk, n.tolist(), strict=True)], pa.list_(pa.int64())), pa.array(words, pa.binary())],
                names=_DIGEST.names,
            )
    _text.release()


def _class_ids(h: np.ndarray, per_text: np.ndarray) -> list[bytes]:
    """128 bits for each text's whole sequence of words."""
    lo, hi, counts = per_text[:-1], per_text[1:], np.diff(per_text)
    place = np.arange(len(h)) - np.repeat(lo, counts)
    out = []
    for seed in (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3):
        x = _text.mix(h ^ (place.astype(np.uint64) * np.uint64(seed)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        out.append(_text.mix(total[hi] - total[lo] + counts.astype(np.uint64)))
    return [bytes(x) for x in np.stack(out, axis=1).view(np.uint8).reshape(len(counts), 16)]


def _chain(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A longest subsequence of the points (i, j), i rising, in which j rises too."""
    if len(j) < 2 or (j[1:] > j[:-1]).all():
        return i, j
    tails: list[int] = []  # least ends of rising runs of each length
    at: list[int] = []  # their points
    before = np.full(len(j), -1)
    for k, v in enumerate(j.tolist()):
        n = bisect_left(tails, v)
        before[k] = at[n - 1] if n else -1
        if n == len(tails):
            tails.append(v)
            at.append(k)
        else:
            tails[n], at[n] = v, k
    k, taken = at[-1], []
    while k >= 0:
        taken.append(k)
        k = before[k]
    taken.reverse()
    return i[taken], j[taken]


def _anchored(x: np.ndarray, y: np.ndarray) -> int:
    """The cost of one alignment of x and y: along runs of ANCHOR words that each has once. No less than their edit distance."""
    n, m = len(x), len(y)
    gx, gy = (np.unique(_text.windows(v.astype(np.uint64), ANCHOR), return_index=True, return_counts=True) for v in (x, y))
    (vx, ix, cx), (vy, iy, cy) = gx, gy
    _, a, b = np.intersect1d(vx[cx == 1], vy[cy == 1], assume_unique=True, return_indices=True)
    if not len(a):
        return max(n, m)
    i, j = ix[cx == 1][a], iy[cy == 1][b]
    order = np.argsort(i)
    i, j = _chain(i[order], j[order])
    di, dj = np.diff(i), np.diff(j)
    run = np.minimum(ANCHOR, np.minimum(di, dj))
    return int(max(i[0], j[0]) + (np.maximum(di, dj) - run).sum() + max(n - i[-1] - ANCHOR, m - j[-1] - ANCHOR))


def _banded(x: np.ndarray, y: np.ndarray, most: int) -> int:
    """The edit distance of x and y if it is at most `most`, else more than that: rows of the band about the diagonal."""
    n, m, far = len(x), len(y), 1 << 29
    width = 2 * most + 1
    place = np.arange(width)
    padded = np.concatenate([np.full(most, -1, np.int64), y.astype(np.int64), np.full(n + width, -1, np.int64)])
    row = np.where((place >= most) & (place <= m + most), place - most, far)
    for i in range(1, n + 1):
        cost = row + (padded[i - 1 : i - 1 + width] != x[i - 1])
        np.minimum(cost[:-1], row[1:] + 1, out=cost[:-1])
        if i <= most:  # the column before y begins
            cost[: most - i] = far
            cost[most - i] = i
        row = np.minimum.accumulate(cost - place) + place
        if (last := m - i + most) < width - 1:  # nothing lies beyond the end of y
            row[max(last + 1, 0) :] = far
        if i % 16 == 0 and row.min() > most:
            return most + 1
    return int(row[m - n + most])


def distance_within(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether the edit distance of two sequences of words is at most `most`."""
    if abs(len(x) - len(y)) > most:
        return False
    for _ in range(2):  # equal beginnings, then equal ends
        k = min(len(x), len(y))
        same = x[:k] == y[:k]
        k = k if same.all() else int(same.argmin())
        x, y = x[k:][::-1], y[k:][::-1]
    if max(len(x), len(y)) <= most:
        return True
    if min(len(x), len(y)) >= ANCHOR and _anchored(x, y) <= most:
        return True
    return _banded(x, y, most) <= most


def edits(n: int, m: int, least: float) -> int:
    """The greatest edit distance of n and m words at which they are similar."""
    return int(np.floor((1 - least) * max(n, m) + 1e-9))


def labelled(words: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(occurrence-labelled windows of k words of all texts, offsets per text); texts of fewer words have none."""
    seqs = [np.frombuffer(x, "<u4") for x in words]
    seqs = [x if len(x) >= k else x[:0] for x in seqs]
    per = np.concatenate([[0], np.cumsum([len(x) for x in seqs])]).astype(np.int64)
    return shingles(_text.mix(np.concatenate([np.zeros(0, "<u4"), *seqs]).astype(np.uint64) + np.uint64(1)), per, k)


def prefixes(text: np.ndarray, rank: np.ndarray, token: np.ndarray, n: np.ndarray, least: float) -> np.ndarray:
    """Which word pairs stand in their text's prefix, in the order of (rank, token); n: pairs of each text.

    Of n + 1 words at most 1 - least may change, and each changes two pairs: all but that many are
    shared by a text that is similar (and not shorter). The prefix is all but as many as are shared, and one.
    """
    order = np.lexsort((token, rank, text))
    starts = np.concatenate([[0], np.cumsum(n)])[:-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order)) - np.repeat(starts, n)
    shared = np.maximum(np.ceil((2 * least - 1) * (n + 1) - 1 - 1e-9), 1).astype(np.int64)
    return place < np.repeat(n - shared + 1, n)


class _Rows:
    """Texts that are asked for: their words, and which of them hold each labelled word pair and each labelled word."""

    def __init__(self, words: list[bytes]):
        self.seqs = [np.frombuffer(x, "<u4") for x in words]
        self.n = np.array([len(x) for x in self.seqs], np.int64)
        self.tokens, self.starts, self.index = [], [], []
        for k in (1, 2):
            s, at = labelled(words, k)
            order = np.argsort(s, kind="stable")
            self.tokens.append(s)
            self.starts.append(at)
            self.index.append((s[order], np.repeat(np.arange(len(self.n)), np.diff(at))[order]))

    def of(self, x: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, labelled words and labelled word pairs of row x."""
        return self.seqs[x], *(t[at[x] : at[x + 1]] for t, at in zip(self.tokens, self.starts, strict=True))

    def _met(self, k: int, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each row holds."""
        held, holder = self.index[k - 1]
        lo, hi = np.searchsorted(held, tokens), np.searchsorted(held, tokens, side="right")
        return np.bincount(np.concatenate([np.zeros(0, np.int64), *[holder[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if b > a]]), minlength=len(self.n))

    def near(self, single: np.ndarray, pairs: np.ndarray, other: np.ndarray, least: float) -> np.ndarray:
        """Rows, among those where other holds, that a text of these labelled words and pairs may be similar to, most alike first."""
        n = len(single)
        most = np.maximum(self.n, n)
        met = self._met(2, pairs)
        rows = np.flatnonzero(other & (met >= np.maximum((2 * least - 1) * most - 1, 1) - 1e-9) & (np.minimum(self.n, n) >= least * most - 1e-9))
        if len(rows):
            met = self._met(1, single)
            rows = rows[met[rows] >= most[rows] - np.floor((1 - least) * most[rows] + 1e-9)]
        return rows[np.argsort(-met[rows], kind="stable")]

    def similar(self, x: int, words: np.ndarray, least: float) -> bool:
        return distance_within(self.seqs[x], words, edits(self.n[x], len(words), least))


def _links(words: list[bytes], asks: np.ndarray, group: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
    """Spanning links among rows: each row that asks against all others of another group. group: components known so far."""
    rows = _Rows(words)
    group = group.copy()
    for x in np.flatnonzero(asks).tolist():
        seq, single, pairs = rows.of(x)
        for y in rows.near(single, pairs, group != group[x], least).tolist():
            if group[y] != group[x] and not (asks[y] and y < x) and rows.similar(y, seq, least):
                group[group == group[y]] = group[x]
                yield x, y


def _link_table(table: pa.Table, least: float) -> pa.Table:
    cls = table.column("cls").to_pylist()
    group = np.unique(table.column("root").to_pylist(), return_inverse=True)[1]
    found = list(_links(table.column("words").to_pylist(), np.array(table.column("asks").to_pylist()), group, least))
    if table.num_rows >= BLOCK // 2:
        _text.release()
    return pa.table({"a": pa.array([cls[x] for x, _ in found], pa.binary()), "b": pa.array([cls[y] for _, y in found], pa.binary())})


def near_groups(docs: DataFrame, least: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, n_words, cls, root, class_id, class_size): for each row of docs (doc_id, text) its class of equal words, its group's root, least doc_id and rows."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "near")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"), F.unhex(F.md5(F.concat(F.lit("text "), text))).alias("text_cls"))
    rows.mapInArrow(_digest, _DIGEST).write.option("compression", "zstd").parquet(f"{folder}/digests")
    digests = spark.read.schema(_DIGEST).parquet(f"{folder}/digests")
    roots = _roots(digests, f"{folder}", least, block)

    classes = digests.groupBy("cls").agg(F.count("*").alias("rows"), F.min("doc_id").alias("least_id")).join(roots.withColumnRenamed("node", "cls").hint("merge"), "cls", "left")
    classes = durable(classes.withColumn("root", F.coalesce("root", "cls")), "classes")
    groups = durable(classes.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("rows").alias("class_size"), F.count("*").alias("n_classes")), "groups")
    classes = durable(join_counted(classes, groups, "root", "n_classes").select("cls", "root", "rows", "class_id", "class_size"), "classes")
    return join_counted(digests.select("doc_id", "text_hash", "n_words", "cls"), classes, "cls", "rows").drop("rows")


def _roots(digests: DataFrame, folder: str, least: float, block: int) -> DataFrame:
    """(node, root) for every class that is linked with another."""
    spark = digests.sparkSession
    one = digests.filter("n_words > 0").groupBy("cls").agg(F.first("sketches").alias("sketches"), F.first("n_words").alias("n"), F.min("row").alias("row"))
    one.select("cls", "n", "row", F.array_distinct("sketches").alias("sketches")).write.option("compression", "zstd").parquet(f"{folder}/one")
    one = spark.read.schema("cls binary, n int, row long, sketches array<long>").parquet(f"{folder}/one")
    members = _members(_held(one), least, block)
    remove(spark, f"{folder}/one")  # members are written
    _marked_rows(digests.select("row", "cls", "words"), members).write.option("compression", "zstd").parquet(f"{folder}/words")
    words = spark.read.schema("row long, cls binary, words binary").parquet(f"{folder}/words")
    large = whole = members.filter("blocks > 1")
    if large.limit(1).count():
        wanted = large.select("row", "cls").distinct()
        large_words = durable(_marked_rows(words, wanted).join(wanted.hint("merge"), ["row", "cls"], "left_semi").select("cls", "words"), "words")
        again = _members(_sketched_again(large, large_words), least, block)
        members = members.filter("blocks = 1").unionByName(again)

    part = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    ranked = F.row_number().over(Window.partitionBy("cls", F.col("blocks") > 1).orderBy(F.desc("size"), "key"))
    firsts = members.withColumn("rank", ranked).filter("blocks = 1 OR rank = 1")
    leads = (F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit("leader"), "cls"), F.col("size")) < LEADERS)
    parts = F.when(leads, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(part))
    dealt = firsts.select("key", "cls", "row", F.explode(parts).alias("part"), F.lit(True).alias("asks"), F.col("cls").alias("root")).join(words, ["row", "cls"]).drop("row")
    links = durable(dealt.groupBy("key", "part").applyInArrow(lambda t: _link_table(t, least), _LINK), "links")
    roots = components(_contracted(links))
    # the large buckets as they were first, so that none who left one for new sketches is without a comparison
    large = durable(whole.unionByName(members.filter("blocks > 1")).select("key", "cls").distinct(), "large")
    if large.limit(1).count():
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(_across_blocks(large, large_words, roots, least, block))
        roots = components(_contracted(links))
    return roots


def _held(one: DataFrame) -> DataFrame:
    """held (key, cls, n, row) of one (cls, n, row, sketches): the keys that two classes hold, and few others.

    Most keys are held once. They are counted alone, without their classes; those held twice are marked,
    and only what is marked leaves the place where it lies.
    """
    twice = one.select(F.explode("sketches").alias("key")).groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    known = one.sparkSession.sparkContext.broadcast(marks(twice, F.col("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sketches_ = b.column("sketches")
            keys = sketches_.flatten().to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(marked(known.value, keys))
            of = pc.list_parent_indices(sketches_).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(keys[kept]), *b.select(["cls", "n", "row"]).take(pa.array(of[kept])).columns], names=["key", "cls", "n", "row"])

    return durable(one.mapInArrow(run, "key long, cls binary, n int, row long"), "held")


def _marked_rows(rows: DataFrame, of: DataFrame) -> DataFrame:
    """The rows whose number `row` is in `of`, and few others; they are not shuffled."""
    mark = F.xxhash64("row")
    known = rows.sparkSession.sparkContext.broadcast(marks(of, mark))
    return keep_rows(rows.withColumn("mark", mark), lambda b: pa.array(marked(known.value, b.column("mark").to_numpy()))).drop("mark")


def _contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components: about LINKS go to a task, which returns each node's link with the least it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))
        names = pc.unique(pa.chunked_array([*table.column("a").chunks, *table.column("b").chunks], pa.binary()))
        names = names.take(pc.sort_indices(names))
        a, b = (pc.index_in(table.column(c), value_set=names).to_numpy().astype(np.int64) for c in "ab")
        least, before = np.arange(len(names)), None
        while before is None or (least != before).any():
            before = least
            reached, least = np.minimum(before[a], before[b]), before.copy()
            for at in (a, b, before[a], before[b]):
                np.minimum.at(least, at, reached)
            least = least[least]
        moved = np.flatnonzero(least != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([names.take(pa.array(moved)), names.take(pa.array(least[moved]))], names=["a", "b"])

    return links.repartition(max(1, -(-links.count() // LINKS))).mapInArrow(run, _LINK)


def _members(held: DataFrame, least: float, block: int) -> DataFrame:
    """(key, cls, n, row, size, blocks): the classes of each bucket of held (key, cls, n, row) in which a pair may be similar; buckets of the same classes once."""
    alike = F.col("least_n") >= F.lit(least) * F.col("most_n") - 1e-9  # what lies further apart can't reach the threshold
    stats = held.groupBy("key").agg(F.count("*").alias("size"), *_marks("cls"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.sum(F.col("n").cast("long") * 4).alias("bytes"))
    stats = stats.filter((F.col("size") > 1) & ((F.col("size") > 2) | alike))
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    buckets = durable(stats.groupBy("size", "m1", "m2").agg(F.min("key").alias("key"), F.first("bytes").alias("bytes")).select("key", "size", blocks.alias("blocks")), "buckets")
    return durable(join_counted(held.select("key", "cls", "n", "row"), buckets, "key", "size", "inner").select("key", "cls", "n", "row", "size", "blocks"), "members")


def _sketched_again(large: DataFrame, words: DataFrame) -> DataFrame:
    """held (key, cls, n, row) of the members of large buckets: new keys within each bucket, and the old one for those of which the bucket's passage is half or more."""
    rows = large.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).join(words, "cls").select("key", "part", "cls", "n", "row", "words", "size", "blocks")

    def passage(key: tuple, table: pa.Table) -> pa.Table:
        """The shingles that half of a part's members hold, with the number of its members."""
        s, at = labelled(table.column("words").to_pylist(), K)
        values, times = np.unique(s, return_counts=True)
        shared = values[2 * times >= len(at) - 1].view(np.int64)
        same = lambda c: pa.chunked_array([pa.array(np.full(len(shared), table.column(c)[0].as_py()), pa.int64())])
        return pa.table({"key": same("key"), "size": same("size"), "blocks": same("blocks"), "members": pa.array(np.full(len(shared), len(at) - 1), pa.int64()), "shingle": pa.array(shared)})

    votes = rows.groupBy("key", "part").applyInArrow(passage, "key long, size long, blocks long, members long, shingle long")
    shared = votes.groupBy("key", "shingle").agg(F.sum("members").alias("members"), F.first("size").alias("size"), F.first("blocks").alias("blocks")).filter(2 * F.col("members") >= F.col("size"))
    shared = shared.groupBy("key").agg(F.collect_list("shingle").alias("shared"), F.first("blocks").cast("int").alias("blocks"))  # twice a part's list at most
    shared = shared.select("key", "shared", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))
    names = ["key", "cls", "n", "row", "stays", "inside"]

    def inside(own: pa.Table, found: pa.Table) -> pa.Table:
        """For each member whether it stays, and which of its shingles lie in the passage, as bits."""
        known = np.array(found.column("shared")[0].as_py() if found.num_rows else [], np.int64).view(np.uint64)
        s, at = labelled(own.column("words").to_pylist(), K)
        held = np.isin(s, known)
        own_bits = [held[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        columns = [*own.select(names[:4]).columns, pa.array([2 * int(x.sum()) >= len(x) for x in own_bits], pa.bool_()), pa.array([np.packbits(x).tobytes() for x in own_bits], pa.binary())]
        return pa.table(columns, names=names)

    met = rows.groupBy("key", "part").cogroup(shared.groupBy("key", "part")).applyInArrow(inside, "key long, cls binary, n int, row long, stays boolean, inside binary")
    met = durable(met, "passages")
    of_class = met.groupBy("cls").agg(F.first("n").alias("n"), F.first("row").alias("row"), F.collect_list("inside").alias("inside")).join(words, "cls")  # BANDS passages at most

    def resketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, at = labelled(b.column("words").to_pylist(), K)
            held = [np.unpackbits(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in bits]))[: hi - lo].astype(bool) for bits, lo, hi in zip(b.column("inside").to_pylist(), at[:-1], at[1:], strict=True)]
            other = ~np.concatenate([np.zeros(0, bool), *held])
            left = np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at))[other], minlength=len(at) - 1)
            keys = _text.mix(sketches(s[other], np.concatenate([[0], np.cumsum(left)]).astype(np.int64))[:, :AGAIN] + np.uint64(1)).view(np.int64)
            some = np.flatnonzero(left)
            taken = b.select(["cls", "n", "row"]).take(pa.array(np.repeat(some, AGAIN)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].ravel()), *taken.columns], names=names[:4])

    fresh = of_class.mapInArrow(resketch, "key long, cls binary, n int, row long").distinct()
    return durable(met.filter("stays").select(*names[:4]).unionByName(fresh), "again")


def _marks(of: str) -> list[Column]:
    """Two numbers of a set of values, m1 and m2."""
    return [F.bit_xor(F.xxhash64(of)).alias("m1"), F.bit_xor(F.xxhash64(F.lit("again"), of)).alias("m2")]


def _across_blocks(members: DataFrame, words: DataFrame, roots: DataFrame, least: float, block: int, few: int | None = None) -> DataFrame:
    """Links of the members outside each large bucket's largest component with members of large buckets.

    `few` (FEW) askers at a time go to all members, in up to ROUNDS rounds; if there are more, members meet in sub-buckets, one for each word pair of their prefixes. The order of pairs is by
    their number in a sample of at most SAMPLE members; any order is exact, this one makes small
    sub-buckets.
    """
    spark = members.sparkSession
    labelled_ = durable(members.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")), "labelled")
    largest = labelled_.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("largest"), F.sum("c").alias("rows"), (F.sum("c") - F.max("c")).alias("outside"))
    largest = durable(largest.filter("outside > 0"), "largest")
    rows = join_counted(labelled_.select("key", "cls", "root"), largest, "key", "rows", "inner")
    rows = durable(rows.groupBy("cls").agg(F.first("root").alias("root"), F.max(F.col("root") != F.col("largest")).alias("asks")).join(words, "cls"), "rows")
    askers, held = rows.filter("asks").agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    few = FEW if few is None else few
    rounds = max(-(-askers // few), -(-held // FEW_BYTES), 1) if few else ROUNDS + 1
    if rounds <= ROUNDS:
        return reduce(DataFrame.unionByName, [_asked(rows, least, k, rounds) for k in range(rounds)])
    sample = rows.select("cls", "words").filter(F.octet_length("words") <= SAMPLE_BYTES).orderBy(F.xxhash64("cls")).limit(SAMPLE).collect()
    seen, times = np.unique(labelled([r.words for r in sample], 2)[0], return_counts=True)
    common = spark.sparkContext.broadcast((seen[times > 1], times[times > 1]))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, ranks = common.value
        for b in batches:
            s, at = labelled(b.column("words").to_pylist(), 2)
            rank = np.zeros(len(s), np.int64)
            if len(values):
                i = np.minimum(np.searchsorted(values, s), len(values) - 1)
                rank = np.where(values[i] == s, ranks[i], 0)
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            first = prefixes(row, rank, s, n, least)
            taken = b.select(["cls", "root", "asks"]).take(pa.array(row[first]))
            yield pa.RecordBatch.from_arrays([pa.array(s[first].view(np.int64)), *taken.columns], names=["token", "cls", "root", "asks"])

    found = durable(rows.select("cls", "root", "asks", "words").mapInArrow(tokens, "token long, cls binary, root binary, asks boolean"), "prefixes")
    stats = found.groupBy("token").agg(F.count("*").alias("size"), F.count_if("asks").alias("n_asks"), (F.min("root") != F.max("root")).alias("apart"), *_marks("cls")).filter("size > 1 AND n_asks > 0 AND apart")
    blocks, ask_blocks = F.ceil(F.col("size") / block).cast("int"), F.ceil(F.col("n_asks") / block).cast("int")
    stats = durable(stats.groupBy("size", "n_asks", "m1", "m2").agg(F.min("token").alias("token")).select("token", "size", blocks.alias("blocks"), ask_blocks.alias("ask_blocks")), "stats")
    met = durable(join_counted(found, stats, "token", "size", "inner"), "met")
    at = F.xxhash64(F.lit("across"), "cls")
    name = ["token", "cls", "root"]
    asked = met.select(*name, F.pmod(at, F.col("blocks")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1)).alias("ask"), (F.col("asks") & (F.col("blocks") == 1)).alias("asks"))
    asking = met.filter("asks AND blocks > 1").select(*name, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.pmod(at, F.col("ask_blocks")).cast("int").alias("ask"), F.lit(True).alias("asks"))
    both = asked.unionByName(asking).join(words, "cls")
    return durable(both.groupBy("token", "part", "ask").applyInArrow(lambda t: _link_table(t, least), _LINK), "links")


def _asked(rows: DataFrame, least: float, k: int = 0, rounds: int = 1) -> DataFrame:
    """Links of the k-th of `rounds` parts of the rows (cls, root, words, asks) that ask with all rows of another root; spanning within a batch."""
    asking = rows.filter("asks").filter(F.pmod(F.xxhash64(F.lit("round"), "cls"), F.lit(rounds)) == k).select("cls", "root", "words").collect()
    number = {r: i for i, r in enumerate({bytes(r.root) for r in asking})}
    known = rows.sparkSession.sparkContext.broadcast(([bytes(r.cls) for r in asking], [bytes(r.root) for r in asking], [bytes(r.words) for r in asking], number))
    index: list[_Rows] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, root, words, groups = known.value
        if not index:
            index.append(_Rows(words))
        asked = index[0]
        of_ask, before = np.array([groups[r] for r in root], np.int64), np.array(cls, object)
        for b in batches:
            own = _Rows(b.column("words").to_pylist())
            found, roots, names, asks = [], b.column("root").to_pylist(), b.column("cls").to_pylist(), b.column("asks").to_pylist()
            met_roots = {r: groups.get(r, -1 - i) for i, r in enumerate(dict.fromkeys(roots))}
            group = of_ask.copy()
            for y in range(len(names)):
                mine = met_roots[roots[y]]
                seq, single, pairs = own.of(y)
                # of two that ask, in whatever rounds, the lesser class meets the other
                other = (group != mine) & (before > names[y]) if asks[y] else group != mine
                for x in asked.near(single, pairs, other, least).tolist():
                    if group[x] != mine and asked.similar(x, seq, least):
                        old = group[x]
                        group[group == old] = mine
                        met_roots = {r: mine if g == old else g for r, g in met_roots.items()}
                        found.append((cls[x], names[y]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([c for _, c in found], pa.binary())], names=["a", "b"])

    # few rows, much work; each task makes an index of those that ask, so there are no more tasks than that is worth
    rows = rows.repartition(min(partitions_for(rows.sparkSession), max(1, rows.count() // ROWS_A_TASK)))
    links = durable(rows.select("cls", "root", "words", "asks").mapInArrow(run, _LINK), "links")
    known.destroy()
    return links


def near_report(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document row: doc_id, class_id (least doc_id of its group), class_size, n_words."""
    return near_groups(docs.select("doc_id", "text"), least).select("doc_id", "class_id", "class_size", F.col("n_words").cast("long").alias("n_words"))


def one_of_each_group(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group: that of the least (doc_id, text hash), nulls last; among rows equal in these the one with the least hash of its other columns.

    A row that is alone in its group stays where it lies; only rows marked as those that stay of larger groups are shuffled.
    """
    groups = durable(near_groups(docs.select("doc_id", "text"), least).select("doc_id", "text_hash", "root", "class_size"), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = groups.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash"))
    kept = durable(kept, "kept")
    several, one = (docs.sparkSession.sparkContext.broadcast(x) for x in (marks(groups.filter("class_size > 1"), F.xxhash64("doc_id", "text_hash")), marks(kept, F.xxhash64("kept_id", "kept_hash"))))
    known = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    known = known.withColumn("mark", F.xxhash64("id", "hash"))
    alone = keep_rows(known, lambda b: pa.array(~marked(several.value, m := b.column("mark").to_numpy()) & marked(one.value, m)))
    rows = keep_rows(known, lambda b: pa.array(marked(several.value, m := b.column("mark").to_numpy()) & marked(one.value, m)))
    others = [F.to_json(f"row.`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"row.`{f.name}`") for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    rows = rows.withColumn("tie", F.xxhash64(*others or [F.lit(0)]))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    return alone.select("row.*").unionByName(rows.groupBy("id", "hash").agg(F.min_by("row", "tie").alias("row")).select("row.*"))
