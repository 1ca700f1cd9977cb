"""Quality classifier by positive-unlabelled learning.

Texts are described by byte and word statistics and by hashed words and word pairs of their whole text.
A small network separates trusted positives from unlabelled text; from its scores on rows it has not
seen, the share of positives in unlabelled text is estimated (the least ratio of the two samples'
shares above a score). A second network then minimises the non-negative unbiased risk with that prior,
and its sigmoid is the score. Negative labels are never used, nor are labels, lang, source or doc_id
inputs of a score.

Unlabelled are all documents outside the held-out fold (crc32(doc_id as text) mod 5 = 0), whatever their
number: their descriptions are written once, and each pass over them trains a copy in each task, in numpy;
the copies' average, weighted by rows, starts the next pass. Means, deviations and the prior's shares
come from passes over all of them too. Only the positives, labelled rows, are a bounded sample: one text
(the one with the least description) of each of at most MOST_POSITIVE ids, those whose hashes are least.

Defined cases: null and empty texts are scored as the empty text; a doc_id whose label rows
disagree is no positive; without positives or unlabelled rows every score is 0.5; repeated rows
score alike; an empty table gives an empty result; columns named like result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm import _text
from strandline.llm._shared import append_columns, arrow_column, durable, keep_rows

MOST_POSITIVE = 20_000
THRESHOLD = 0.3
FOLDS = 5
HIDDEN = 16
#: Buckets of hashed words, and as many of hashed word pairs; they are scaled down by DAMPED, as few positives can't settle their weights.
HASHED = 64
DAMPED = 8
#: Passes over the unlabelled rows, times that a pass goes over the rows it holds, and its least number of steps.
ROUNDS = 4
EPOCHS = 8
LEAST_STEPS = 40
BATCH = 512
RATE = 5e-3
DECAY = 1e-2
#: Rows that a task trains on at a time, and that there are at least for each copy.
ROWS = 16_384
LEAST_ROWS = 8192
FAN = 64

_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum()])


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text, float16."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    hist = np.bincount(row * 256 + data[offsets[0] : offsets[-1]], minlength=n * 256).reshape(n, 256)
    share = hist / np.maximum(size, 1)[:, None]
    w = _text.words(data, offsets)
    h = w.hashes()
    count = np.diff(w.per_text)
    text = np.repeat(np.arange(n), count)
    length = (w.end - w.start).astype(np.float64)
    some = np.maximum(count, 1)
    mean = np.bincount(text, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(text, length * length, n) / some - mean * mean, 0))
    _, first, times = np.unique(_text.mix(h ^ _text.mix(text.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
    kinds = np.bincount(text[first], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, text[first], times)
    follows = text[1:] == text[:-1]
    same = np.bincount(text[1:][(h[1:] == h[:-1]) & follows], minlength=n)
    long_ = np.bincount(text[length > 20], minlength=n)
    columns = [
        np.log1p(size), np.log1p(count), mean, spread, kinds / some, np.log1p(kinds) / np.log1p(some), np.sqrt(top / some), np.sqrt(same / some), np.sqrt(long_ / some),
        np.log1p(size / (hist[:, 10] + 1)), np.sqrt(share[:, 65:91].sum(1)), share[:, 97:123].sum(1), np.sqrt(share[:, 48:58].sum(1)), np.sqrt(share[:, 32]), np.sqrt(share[:, 10]), share[:, 128:].sum(1),
        np.sqrt(share[:, :32].sum(1)),
    ]
    one = np.bincount(text * HASHED + (h % np.uint64(HASHED)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
    pair = _text.mix(h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:])[follows]
    two = np.bincount(text[1:][follows] * HASHED + (pair % np.uint64(HASHED)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
    grams = np.sqrt(np.concatenate([one, two], 1) / some[:, None])
    return np.minimum(np.concatenate([np.stack(columns, 1), np.sqrt(share[:, _MARKS]), grams], axis=1), 60_000).astype(np.float16)


N_FEATURES = 17 + len(_MARKS) + 2 * HASHED


def _described(texts: pa.Array) -> np.ndarray:
    data, offsets = _text.strings(texts)
    parts = [features(data, offsets[lo : hi + 1]) for lo, hi in _text.blocks(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), np.float16)


def _rows(column: pa.Array) -> np.ndarray:
    """Descriptions from a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, N_FEATURES)


@dataclass
class Net:
    """One hidden layer on standardised features; flat: w1, b1, w2, b2."""

    mean: np.ndarray
    scale: np.ndarray
    flat: np.ndarray

    @staticmethod
    def fresh(mean: np.ndarray, scale: np.ndarray, seed: int) -> Net:
        rng, d = np.random.default_rng(seed), len(mean)
        return Net(mean, scale, np.concatenate([rng.normal(0, d**-0.5, d * HIDDEN), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]))

    def weights(self) -> list[np.ndarray]:
        """Views of flat."""
        d = len(self.mean) * HIDDEN
        return [self.flat[:d].reshape(-1, HIDDEN), self.flat[d : d + HIDDEN], self.flat[d + HIDDEN : d + 2 * HIDDEN], self.flat[-1:]]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x.astype(np.float64) - self.mean) / self.scale, -8, 8)

    def forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.weights()
        hidden = np.tanh(z @ w1 + b1)
        return hidden, hidden @ w2 + b2[0]

    def backward(self, z: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> np.ndarray:
        inner = slope[:, None] * self.weights()[2] * (1 - hidden * hidden)
        return np.concatenate([(z.T @ inner).ravel(), inner.sum(0), hidden.T @ slope, slope.sum(keepdims=True)])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(self.standard(x))[1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def slopes(fp: np.ndarray, fu: np.ndarray, prior: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the risk by the outputs of positives and unlabelled rows: non-negative unbiased with a prior, without one of telling them apart."""
    if prior is None:
        return -_sigmoid(-fp) / len(fp), _sigmoid(fu) / len(fu)
    negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
    if negative >= 0:
        return prior * (-_sigmoid(-fp) - _sigmoid(fp)) / len(fp), _sigmoid(fu) / len(fu)
    # the unlabelled part may not fall below zero: step back on it
    return prior * _sigmoid(fp) / len(fp), -_sigmoid(fu) / len(fu)


def descend(net: Net, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int) -> None:
    """Adam on net, in place, over standardised rows."""
    rng, batch = np.random.default_rng(seed), min(BATCH, len(positive), len(unlabelled))
    first, second = np.zeros_like(net.flat), np.zeros_like(net.flat)
    op, ou = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    for step in range(max(LEAST_STEPS, EPOCHS * len(unlabelled) // batch)):
        at = np.arange(step * batch, (step + 1) * batch)
        zp, zu = positive[np.take(op, at, mode="wrap")], unlabelled[np.take(ou, at, mode="wrap")]
        (hp, fp), (hu, fu) = net.forward(zp), net.forward(zu)
        sp, su = slopes(fp, fu, prior)
        g = net.backward(zp, hp, sp) + net.backward(zu, hu, su) + DECAY * net.flat
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        net.flat -= RATE * (first / (1 - 0.9 ** (step + 1))) / (np.sqrt(second / (1 - 0.999 ** (step + 1))) + 1e-8)


def least_ratio(qp: np.ndarray, qu: np.ndarray, n_positive: int, n_unlabelled: int) -> float:
    """The share of positives among unlabelled rows from both samples' shares above some scores: the least ratio, at its best confidence."""
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (n_positive**-0.5 + n_unlabelled**-0.5)
    best = np.argmin((qu + 2 * slack) / qp)
    return float(np.clip(qu[best] / qp[best], 0.02, 0.98))


def _cuts(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores to look at, and the positives' shares above them."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.99, 200)))
    return cuts, np.array([(positive >= c).mean() for c in cuts])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled scores."""
    cuts, qp = _cuts(positive)
    return least_ratio(qp, np.array([(unlabelled >= c).mean() for c in cuts]), len(positive), len(unlabelled))


def _sums(rows: DataFrame, fn: Callable[[np.ndarray, int], np.ndarray]) -> np.ndarray | None:
    """The sum over all rows of fn(descriptions, a number of the piece), an array of one size; added up in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n, piece = None, [], 0, 0
        part = TaskContext.get().partitionId()

        def add() -> None:
            nonlocal total, held, n, piece
            more = fn(np.concatenate(held), part + (piece << 24))
            total, held, n, piece = more if total is None else total + more, [], 0, piece + 1

        for b in batches:
            held.append(_rows(b.column("x")))
            n += len(held[-1])
            if n >= ROWS:
                add()
        if n:
            add()
        _text.release()
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.astype(np.float64).tobytes()], pa.binary())], names=["part", "total"])

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("total"))
        return pa.table({"part": [table.column("part")[0].as_py() // FAN], "total": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, total binary"
    sums = durable(rows.select("x").mapInArrow(run, schema), "sums")
    n = (sums.agg(F.max("part")).first()[0] or 0) + 1
    while n > 1:
        sums = sums.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(merge, schema)
        n = -(-n // FAN)
    got = sums.collect()  # one row
    return np.frombuffer(got[0].total, np.float64) if got else None


def _pass(rows: DataFrame, net: Net, positive: np.ndarray, prior: float | None, seed: int) -> Net:
    """net after a pass over rows: the average of its trained copies, weighted by rows."""
    model = rows.sparkSession.sparkContext.broadcast((net, positive))

    def learn(x: np.ndarray, piece: int) -> np.ndarray:
        start, good = model.value
        own = Net(start.mean, start.scale, start.flat.copy())
        if len(x) > 1:
            descend(own, own.standard(good), own.standard(x), prior, seed + 7919 * piece)
        return np.append(own.flat * len(x), len(x))

    got = _sums(rows, learn)
    model.unpersist()
    return net if got is None else Net(net.mean, net.scale, got[:-1] / got[-1])


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of docs (doc_id, text): the texts' descriptions, written once."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([x.tobytes() for x in _described(batch.column("text"))], pa.binary())]

    return durable(append_columns(docs.select("doc_id", "text"), [T.StructField("x", T.BinaryType())], run, ["doc_id"]), "descriptions")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _positives(described: DataFrame, labels: DataFrame, most: int) -> np.ndarray:
    """Descriptions of the documents of at most `most` ids that labels.quality calls good, outside the held-out fold."""
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).filter("q = 1").select("id").filter(~held_out("id"))
    total = good.count()
    if total > 2 * most:  # the least hashes alone, so that a limit has little to order
        good = good.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * 1.5 * most / total))
    chosen = F.broadcast(good.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").limit(most))
    rows = described.join(chosen, described["doc_id"] == chosen["id"], "left_semi").groupBy("doc_id").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    return np.frombuffer(b"".join(r.x for r in rows), np.float16).reshape(-1, N_FEATURES)


def fit_on(described: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, seed: int = 7) -> Net | None:
    """The network for described (doc_id, x); None where there is nothing to learn from."""
    positive = _positives(described, labels, most_positive)
    rows = described.filter(F.col("doc_id").isNotNull() & ~held_out())
    moments = _sums(rows, lambda x, _: np.concatenate([[len(x)], x.astype(np.float64).sum(0), (x.astype(np.float64) ** 2).sum(0)]))
    if moments is None or moments[0] < 2 or len(positive) < 2:
        return None
    n, d = moments[0], N_FEATURES
    mean = moments[1 : d + 1] / n
    scale = np.maximum(np.sqrt(np.maximum(moments[d + 1 :] / n - mean**2, 0)), 1e-3)
    scale[-2 * HASHED :] *= DAMPED
    few = rows.coalesce(max(1, int(n // LEAST_ROWS)))
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))

    apart = _pass(few.filter(half == 0), Net.fresh(mean, scale, seed), positive[::2], None, seed)
    cuts, qp = _cuts(apart.score(positive[1::2]))
    counts = _sums(few.filter(half == 1), lambda x, _: np.append([(apart.score(x) >= c).sum() for c in cuts], len(x)))
    prior = 0.5 if counts is None else least_ratio(qp, counts[:-1] / counts[-1], len(positive) // 2, int(counts[-1]))

    net = Net.fresh(mean, scale, seed + 1)
    for r in range(ROUNDS):
        net = _pass(few, net, positive, prior, seed + r)
    return net


def _scores(net: Net | None, x: np.ndarray) -> np.ndarray:
    return np.full(len(x), 0.5) if net is None else net.score(x)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted."""
    described = describe(docs)
    model = docs.sparkSession.sparkContext.broadcast(fit_on(described, labels))
    out = append_columns(described, [T.StructField("score", T.DoubleType())], lambda b: [pa.array(_scores(model.value, _rows(b.column("x"))), pa.float64())], ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def with_scores(docs: DataFrame, net: Net | None, text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1) from the whole texts."""
    model = docs.sparkSession.sparkContext.broadcast(net)
    return append_columns(docs, [T.StructField("score", T.DoubleType())], lambda b: [pa.array(_scores(model.value, _described(arrow_column(b, text_col))), pa.float64())])


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with a score of threshold or more; same columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit_on(describe(docs), labels))
    return keep_rows(docs, lambda b: pa.array(_scores(model.value, _described(b.column("text"))) >= threshold, pa.bool_()))
