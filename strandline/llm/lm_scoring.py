"""Masked pseudo-likelihood by a bidirectional window network.

Every word of every text is predicted from both its sides; the sum of the log-probabilities is the
text's score. The network has two parts.

The dense part is trained in numpy. Its inputs are the SIDE words on either side, one embedding a word
scaled by place, then a tanh layer. Its outputs are a group of words and, within the group, a word:
VOCABULARY words at most, the commonest by counts over all documents, in GROUPS groups (small ones of common
words, large ones of rare words), and one more group for all other words, which are spelled by a byte-pair
table gathered from them. So every word, known or not, has a probability. Training passes over every word of the corpus once, in ROUNDS parts:
each task trains its own copy, copies are averaged by the words they saw in a tree of FAN, and the
average starts the next round.

The sparse part has a unit for every pair of neighbouring words (left, right) of the corpus, with the
words seen between them and their counts. As the predicted word is masked, its own occurrence is
taken from the counts. With m other occurrences of the pair, t kinds of words among them and c of them
the word itself, its probability is (c + t p) / (m + t), p that of the dense part; a pair not met elsewhere
leaves p. A pair of two frequent words (each more than one in FREQUENT of all words, or a text's end) has no
unit, the dense part knows these well: a unit thus holds at most one in FREQUENT of all words.

Units are far too many to broadcast. Each task sends its words to shards of about SHARD_TOKENS, by a hash
of the pair, as packed arrays (14 bytes a word, keys of 44 bits for the pair within its shard and 20 for the word); a
shard counts, and returns what its words gain, summed by text, where that is not nothing.

Defined cases: null and empty texts have 0 words, score 0 and no mean; repeated rows are trained on
and scored row by row; an empty table gives an empty result; columns other than doc_id and text are left
out. Equal counts of words are ordered by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text
from strandline.llm._shared import durable, partitions_for

VOCABULARY = 20_480
#: The classes that the dense part knows: the edge of a text, all other words, and the vocabulary.
CLASSES = VOCABULARY + 2
GROUPS = 80
FREQUENT = 4096
SIDE = 2
HIDDEN = 16
ROUNDS = 2
BATCH = 16_384
RATE = 0.05
#: Greatest output weight, by size: HIDDEN of them stay far below the exponential's limit.
LARGEST = 4
FAN = 16
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 1 << 20
#: Words that a scoring task packs together, and that a shard has, about.
CHUNK_TOKENS = 1 << 19
SHARD_TOKENS = 1 << 20

_EDGE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = 257
_WORD_BITS = np.uint64(20)
_MEMBER = [("n", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64()))]


@dataclass
class Vocabulary:
    """hashes: sorted word hashes; classes: the class of each, 2 and up by falling count; counts: by class; total: words of the corpus."""

    hashes: np.ndarray
    classes: np.ndarray
    counts: np.ndarray
    total: int
    groups: int = GROUPS

    @staticmethod
    def of(word: np.ndarray, n: np.ndarray, total: int, groups: int = GROUPS) -> Vocabulary:
        """Of words (hashes as int64) and their counts; of equal counts the lesser hash comes first."""
        order = np.lexsort((word, -n))
        hashes, classes = word[order].view(np.uint64), np.arange(2, len(order) + 2)
        by_hash = np.argsort(hashes)
        return Vocabulary(hashes[by_hash], classes[by_hash], n[order], total, groups)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Class of each word hash; 1 for words outside the vocabulary."""
        out = np.ones(len(h), np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == h, self.classes[at], out)
        return out

    def starts(self) -> np.ndarray:
        """The first word of each group, and the number of words: groups have about equal sums of the roots of their counts, which keeps sums over groups and over words short."""
        roots = np.cumsum(np.sqrt(self.counts))
        if not len(roots):
            return np.zeros(1, np.int64)
        cuts = np.searchsorted(roots, roots[-1] * np.arange(1, self.groups) / self.groups)
        return np.unique(np.concatenate([[0], cuts, [len(roots)]]))


class Network:
    """The dense part: views of one vector of weights."""

    def __init__(self, flat: np.ndarray | None, starts: np.ndarray):
        self.starts, self.words, self.groups = starts, int(starts[-1]), len(starts)
        shapes = [(self.words + 2, HIDDEN), (2 * SIDE, HIDDEN), (HIDDEN,), (HIDDEN, self.groups), (self.groups,), (self.words, HIDDEN), (self.words,)]
        at = np.concatenate([[0], np.cumsum([int(np.prod(s)) for s in shapes])])
        self.flat = np.zeros(at[-1], np.float32) if flat is None else flat
        self.embed, self.scale, self.bias, self.group, self.group_bias, self.word, self.word_bias = (self.flat[a:b].reshape(s) for a, b, s in zip(at[:-1], at[1:], shapes, strict=True))
        #: Group of each class; the last is that of class 1, all words outside the vocabulary.
        self.group_of = np.full(self.words + 2, self.groups - 1, np.int16)
        self.group_of[2:] = np.repeat(np.arange(self.groups - 1), np.diff(starts))

    @staticmethod
    def fresh(known: Vocabulary, seed: int = 11) -> Network:
        """Small random weights; biases that give each word its share of the corpus."""
        net = Network(None, known.starts())
        rng = np.random.default_rng(seed)
        for w, spread in ((net.embed, 0.3), (net.group, 0.05), (net.word, 0.05)):
            w[:] = rng.normal(0, spread, w.shape)
        net.scale[:] = 1
        net.word_bias[:] = np.log(known.counts)
        for a, b in zip(net.starts[:-1], net.starts[1:], strict=True):
            net.word_bias[a:b] -= np.log(known.counts[a:b].sum())
        mass = np.bincount(net.group_of[2:], known.counts, net.groups)
        mass[-1] = known.total - mass.sum()
        net.group_bias[:] = np.log(np.maximum(mass, 0.5) / max(known.total, 1))
        return net

    def forward(self, ids: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]]:
        """(hidden layer, exponentials and reciprocal sums of the groups' outputs, and for each group of words its rows, its words and their exponentials and reciprocal sums); ids sorted by group."""
        inner = np.broadcast_to(self.bias, (len(ids), HIDDEN)).copy()
        more = np.empty_like(inner)
        for k in range(2 * SIDE):
            np.take(self.embed, context[k], axis=0, out=more)
            more *= self.scale[k]
            inner += more
        hidden = np.tanh(inner, out=inner)
        at = np.searchsorted(self.group_of[ids], np.arange(self.groups))

        def within() -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
            for g in range(self.groups - 1):
                if at[g] < at[g + 1]:
                    rows, words = slice(at[g], at[g + 1]), slice(self.starts[g], self.starts[g + 1])
                    yield rows, words, *_exponentials(hidden[rows] @ self.word[words].T, self.word_bias[words])

        return hidden, *_exponentials(hidden @ self.group, self.group_bias), within()

    def log_probabilities(self, ids: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Of each class in its place; of class 1 that the word is none of the vocabulary."""
        out = np.empty(len(ids))
        for lo in range(0, len(ids), BATCH):
            own = ids[lo : lo + BATCH]
            order = np.argsort(self.group_of[own], kind="stable")
            own = own[order]
            _, e, share, within = self.forward(own, context[:, lo : lo + BATCH][:, order])
            p = (e[np.arange(len(own)), self.group_of[own]] * share).astype(np.float64)
            for rows, words, e, share in within:
                p[rows] *= e[np.arange(len(e)), own[rows] - 2 - words.start] * share
            out[lo + order] = np.log(np.maximum(p, 1e-30))
        return out


def _exponentials(x: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(x + bias), in place of x, and the reciprocals of its rows' sums; LARGEST keeps them finite."""
    x += bias
    np.exp(x, out=x)
    return x, 1 / np.maximum(x @ np.ones(x.shape[1], np.float32), 1e-30)


class Trainer:
    """Adagrad on a private copy of the network, and the byte pairs of words outside the vocabulary."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray):
        self.net, self.squares = Network(flat.copy(), starts), Network(None, starts)
        self.squares.flat += 1e-8
        self.pairs = np.zeros(_BYTES * _BYTES, np.int64)
        self.seen = 0

    def learn(self, ids: np.ndarray, context: np.ndarray) -> None:
        for lo in range(0, len(ids), BATCH):
            self._learn(ids[lo : lo + BATCH], context[:, lo : lo + BATCH])

    def _step(self, name: str, at: slice | np.ndarray, g: np.ndarray, n: int) -> None:
        """One step on some rows of a part, along its gradient summed over n words."""
        g /= n
        squares, weights = getattr(self.squares, name), getattr(self.net, name)
        s = squares[at] + g * g
        squares[at] = s
        g /= np.sqrt(s)
        g *= RATE
        if name in ("word", "group"):
            weights[at] = np.clip(weights[at] - g, -LARGEST, LARGEST)
        else:
            weights[at] -= g

    def _learn(self, ids: np.ndarray, context: np.ndarray) -> None:
        net, n, all_ = self.net, len(ids), slice(None)
        order = np.argsort(net.group_of[ids], kind="stable")
        ids, context = ids[order], context[:, order]
        hidden, e, share, within = net.forward(ids, context)
        # share scales the rows of e; it is put to what is multiplied with them, which is narrower
        e[np.arange(n), net.group_of[ids]] -= 1 / share
        back = (e @ net.group.T) * share[:, None]
        steps = [("group", all_, (hidden * share[:, None]).T @ e), ("group_bias", all_, share @ e)]
        for rows, words, e, share in within:
            e[np.arange(len(e)), ids[rows] - 2 - words.start] -= 1 / share
            back[rows] += (e @ net.word[words]) * share[:, None]
            self._step("word", words, e.T @ (hidden[rows] * share[:, None]), n)
            self._step("word_bias", words, share @ e, n)
        back *= 1 - hidden * hidden
        embed, scale, touched = np.zeros_like(net.embed), np.empty((2 * SIDE, HIDDEN), np.float32), np.zeros(net.words + 2, bool)
        for k in range(2 * SIDE):  # sums of back by class at this place
            own = context[k].astype(np.int16 if net.words < 1 << 15 else np.int32)
            order = np.argsort(own, kind="stable")
            own = own[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            kinds, sums = own[first], np.add.reduceat(back[order], first, axis=0)
            scale[k] = (sums * net.embed[kinds]).sum(0)
            embed[kinds] += sums * net.scale[k]
            touched[kinds] = True
        steps += [("bias", all_, back.sum(0)), ("scale", all_, scale), ("embed", (at := np.flatnonzero(touched)), embed[at])]
        for name, at, g in steps:
            self._step(name, at, g, n)
        self.seen += n


def windows(ids: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """(2 * SIDE, words): the classes of each word's neighbours, farthest left first, the edge class 0 beyond the text."""
    counts = np.diff(per_text)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(ids))
    lo, hi = per_text[:-1][text], per_text[1:][text]
    out = np.zeros((2 * SIDE, len(ids)), np.int64)
    for k, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = place + step
        inside = (at >= lo) & (at < hi)
        out[k, inside] = ids[at[inside]]
    return out


def byte_pairs(w: _text.Words, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs within the words numbered rare, offsets per word, pairs at their ends); a pair is 257 * first + second, 256 a word's beginning or end."""
    start, size = w.start[rare], w.end[rare] - w.start[rare]
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    before = w.low[np.maximum(at - 1, 0)].astype(np.int64)
    before[offsets[:-1]] = 256
    return before * _BYTES + w.low[at], offsets, w.low[w.end[rare] - 1].astype(np.int64) * _BYTES + 256


def spelling(pairs: np.ndarray) -> np.ndarray:
    """Log-probabilities of byte pairs from their counts."""
    n = pairs.reshape(_BYTES, _BYTES) + 0.5
    return np.log(n / n.sum(1, keepdims=True)).ravel()


def spelled(w: _text.Words, rare: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log-probability of each word numbered rare, given that it is none of the vocabulary."""
    if not len(rare):
        return np.zeros(0)
    inside, offsets, end = byte_pairs(w, rare)
    return np.add.reduceat(table[inside], offsets[:-1]) + table[end]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, _text.Words, np.ndarray]]:
    data, offsets = _text.strings(batch.column("text"))
    for lo, hi in _text.blocks(offsets):
        w = _text.words(data, offsets[lo : hi + 1])
        yield lo, hi, w, w.hashes()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the hash of every word of all documents, and how often it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["word", "n"])

        for b in batches:
            for _, _, _, h in _texts(b):
                more, n = np.unique(h, return_counts=True)
                words, at = np.unique(np.concatenate([words, more]), return_inverse=True)
                times = np.bincount(at, np.concatenate([times, n]), len(words)).astype(np.int64)
                if len(words) > HELD_WORDS:
                    yield batch()
                    words, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield batch()

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, most: int = VOCABULARY, groups: int = GROUPS) -> Vocabulary:
    """The words above the least frequency that at most `most` words reach, and 2 or more."""
    counts = durable(word_counts(docs), "words")
    # whole counts up to 1023, sixteenths of a doubling above: under 2,000 rows whatever the corpus
    level = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.floor(1024 + 16 * (F.log2(F.col("n").cast("double")) - 10))).cast("long")
    held = {r.level: (r.words, r.tokens) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()}
    least, taken = None, 0
    for x in sorted(held, reverse=True):
        taken += held[x][0]
        if x < 2 or taken > most:
            break
        least = x
    rows = [] if least is None else counts.filter(level >= least).collect()  # `most` at most
    total = sum(tokens for _, tokens in held.values())
    return Vocabulary.of(np.array([r.word for r in rows], np.int64), np.array([r.n for r in rows], np.int64), total, groups)


def train(docs: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(the dense part's weights, counts of byte pairs) after one pass over all documents."""
    sc = docs.sparkSession.sparkContext
    starts = known.starts()
    flat, pairs = Network.fresh(known).flat, np.zeros(_BYTES * _BYTES, np.int64)
    schema = "part long, seen long, weights binary, pairs binary"
    names = ["part", "seen", "weights", "pairs"]
    for r in range(rounds):
        model = sc.broadcast((flat, known))

        def learn(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            start, vocabulary = model.value
            own = Trainer(start, starts)
            for b in batches:
                for _, _, w, h in _texts(b):
                    ids = vocabulary.ids(h)
                    own.learn(ids, windows(ids, w.per_text))
                    inside, _, end = byte_pairs(w, np.flatnonzero(ids == 1))
                    own.pairs += np.bincount(np.concatenate([inside, end]), minlength=len(own.pairs))
            if own.seen:
                row = [TaskContext.get().partitionId(), own.seen, own.net.flat.tobytes(), own.pairs.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=names)

        def mean(table: pa.Table) -> pa.Table:
            seen = table.column("seen").to_numpy()
            total, counts = np.zeros(len(flat)), np.zeros(_BYTES * _BYTES, np.int64)
            for n, x, p in zip(seen, table.column("weights"), table.column("pairs"), strict=True):
                total += n / seen.sum() * np.frombuffer(x.as_py(), np.float32)
                counts += np.frombuffer(p.as_py(), np.int64)
            return pa.table({"part": [table.column("part")[0].as_py() // FAN], "seen": [int(seen.sum())], "weights": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "pairs": pa.array([counts.tobytes()], pa.binary())})

        part = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == r).select("text")
        copies = durable(part.mapInArrow(learn, schema), "copies")
        n = (copies.agg(F.max("part")).first()[0] or 0) + 1
        while n > 1:  # a tree of FAN
            copies = copies.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(mean, schema)
            n = -(-n // FAN)
        if got := copies.collect():  # one row
            flat, pairs = np.frombuffer(got[0].weights, np.float32), pairs + np.frombuffer(got[0].pairs, np.int64)
        model.unpersist()
    return flat, pairs


def unit_keys(h: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the pair of neighbours of each word, key of that pair and the word)."""
    left, right = np.empty_like(h), np.empty_like(h)
    left[1:], right[:-1] = h[:-1], h[1:]
    some = per_text[:-1][np.diff(per_text) > 0]
    left[some] = _EDGE
    right[per_text[1:][np.diff(per_text) > 0] - 1] = _EDGE
    pair = _text.mix(_text.mix(left * np.uint64(0xD6E8FEB86659FD93)) + right)
    return pair, (pair >> _WORD_BITS << _WORD_BITS) | (h >> (np.uint64(64) - _WORD_BITS))


def gains(keys: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """What each word's log-probability gains by the sparse part; keys and logp are of all words of a shard."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = k[1:] != k[:-1]
    kind = np.cumsum(fresh) - 1  # number of the (pair, word)
    c = np.bincount(kind)
    pair = (k >> _WORD_BITS)[fresh]
    other = np.ones(len(pair), bool)
    other[1:] = pair[1:] != pair[:-1]
    unit = np.cumsum(other) - 1
    m, t = np.bincount(unit, c)[unit][kind] - 1, np.bincount(unit)[unit][kind]
    c = c[kind]
    t = t - (c == 1)
    own = np.exp(np.maximum(logp[order].astype(np.float64), -700))
    out = np.zeros(len(k))
    met = m > 0
    p = (c[met] - 1 + t[met] * own[met]) / (m[met] + t[met])
    # where the word is not among the others, p is a share of the dense part's, however small that is
    gain = np.where(c[met] == 1, np.log(t[met] / (m[met] + t[met])), np.log(np.maximum(p, 1e-300)) - logp[order][met])
    out[order[met]] = gain
    return out


def score(docs: DataFrame, flat: np.ndarray, pairs: np.ndarray, known: Vocabulary, frequent: int = FREQUENT, chunk_tokens: int = CHUNK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) of docs (doc_id, text)."""
    spark = docs.sparkSession
    shards = partitions_for(spark, -(-known.total // shard_tokens))
    first_rare = 2 + int((known.counts * frequent > known.total).sum())  # of the classes, which fall by count
    model, starts = spark.sparkContext.broadcast((flat, spelling(pairs), known)), known.starts()
    id_type = docs.schema["doc_id"].dataType
    member = [T.StructField("ids", T.ArrayType(id_type)), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("sums", T.ArrayType(T.DoubleType()))]
    packed = [T.StructField("places", T.BinaryType()), T.StructField("values", T.BinaryType())]
    sent = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("keys", T.BinaryType()), *packed, *member])
    back = T.StructType([T.StructField("chunk", T.LongType()), *packed, *member])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, table, vocabulary = model.value
        net = Network(weights, starts)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            """One row of the chunk's texts, to a shard of its own, and a row of words for each shard."""
            ids, n, sums = pa.concat_arrays([x[0] for x in held]), np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            base = np.cumsum([0, *[len(x[1]) for x in held]])
            pair, keys, logp = (np.concatenate([x[i] for x in held]) for i in (3, 4, 5))
            place = np.concatenate([x[6] + b for x, b in zip(held, base, strict=False)]).astype("<u2" if len(n) <= 1 << 16 else "<u4")
            shard = (pair % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            at = np.searchsorted(shard[order], np.arange(shards + 1))
            some = [s for s in range(shards) if at[s] < at[s + 1]]
            cut = [order[at[s] : at[s + 1]] for s in some]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), x) for x in (ids, pa.array(n), pa.array(sums))]
            rows = [
                pa.array([number] * (len(some) + 1)), pa.array([shards + number % shards, *some], pa.int64()),
                pa.array([None, *[keys[c].tobytes() for c in cut]], pa.binary()), pa.array([None, *[place[c].tobytes() for c in cut]], pa.binary()), pa.array([None, *[logp[c].tobytes() for c in cut]], pa.binary()),
                *[pa.concat_arrays([x, pa.nulls(len(some), x.type)]) for x in lists],
            ]
            yield pa.RecordBatch.from_arrays(rows, names=sent.names)

        tokens = 0
        for b in batches:
            for lo, hi, w, h in _texts(b):
                ids = vocabulary.ids(h)
                context = windows(ids, w.per_text)
                logp = net.log_probabilities(ids, context)
                rare = np.flatnonzero(ids == 1)
                logp[rare] += spelled(w, rare, table)
                n = np.diff(w.per_text)
                text = np.repeat(np.arange(hi - lo), n)
                near = context[SIDE - 1 : SIDE + 1]
                unit = np.flatnonzero(~((near != 1) & (near < first_rare)).all(0))
                pair, keys = unit_keys(h, w.per_text)
                held.append((b.column("doc_id").slice(lo, hi - lo), n, np.bincount(text, logp, hi - lo).astype(np.float64), pair[unit], keys[unit], logp[unit].astype(np.float32), text[unit]))
                tokens += len(h)
                if tokens >= chunk_tokens:
                    yield from flush()
                    held, tokens, number = [], 0, number + 1
        if held:
            yield from flush()

    def count(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() >= shards:  # the chunks' texts
            return table.select(back.names)
        keys = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("keys")]
        gain = gains(np.concatenate(keys), np.concatenate([np.frombuffer(x.as_py(), np.float32) for x in table.column("values")]))
        places, values, lo = [], [], 0
        for own, p in zip(keys, table.column("places"), strict=True):
            mine = gain[lo : lo + len(own)]
            lo += len(own)
            place = np.frombuffer(p.as_py(), "<u2" if len(p.as_py()) == 2 * len(own) else "<u4")
            got = np.flatnonzero(mine)
            text, at = np.unique(place[got], return_inverse=True)
            places.append(text.astype("<u4").tobytes())
            values.append(np.bincount(at, mine[got], len(text)).tobytes())
        out = [table.column("chunk"), pa.array(places, pa.binary()), pa.array(values, pa.binary()), *[pa.nulls(len(keys), table.schema.field(f.name).type) for f in member]]
        return pa.table(out, names=back.names).filter(pa.array([len(p) > 0 for p in places], pa.bool_()))

    def gather(table: pa.Table) -> pa.Table:
        of_texts = table.filter(table.column("ids").is_valid())
        ids, n, sums = (of_texts.column(f.name).combine_chunks().flatten() for f in member)
        total = sums.to_numpy().copy()
        for p, v in zip(table.column("places"), table.column("values"), strict=True):
            if p.is_valid:
                total[np.frombuffer(p.as_py(), "<u4")] += np.frombuffer(v.as_py(), np.float64)
        n = n.to_numpy()
        mean = pa.array(np.where(n > 0, total / np.maximum(n, 1), np.nan), mask=n == 0)
        return pa.table([ids, pa.array(n), pa.array(total), mean], names=out.names)

    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()), T.StructField("log_likelihood", T.DoubleType()), T.StructField("mean_log_likelihood", T.DoubleType())])
    gained = docs.select("doc_id", "text").mapInArrow(scatter, sent).groupBy("shard").applyInArrow(count, back)
    return gained.groupBy("chunk").applyInArrow(gather, out)


def score_report(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, log_likelihood, mean_log_likelihood."""
    docs = docs.select("doc_id", "text")
    known = vocabulary(docs)
    return score(docs, *train(docs, known), known)
