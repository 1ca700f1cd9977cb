"""Spelling variants: words one edit apart, grouped under their most frequent form.

Of two words at distance one the edit lies in one half of either, so the other half stands unchanged
at the same end. Every word puts its two halves into automaton shards (Aho-Corasick, by hash of
the half, its side and the word's length), and all words are scanned by the automata of the shards
that may hold a half of a near word: its own beginnings and ends of the lengths that words one
letter shorter, as long or longer have. A match counts if the half lies at its own end of the
scanned word and the lengths agree; then the distance is verified. A half that more than BLOCK
words share is split over several shards, each of which its words visit; within a shard, what is
left of many words with one half is looked up by its deletions, so no list is gone through pair by
pair. Only counts and the best form leave a shard, never pairs.

Forms are followed to the last by pointer doubling; a form has at least twice the occurrences of
its word, so a chain is no longer than the logarithm of the largest count.

Defined cases: a null text has no words; a null doc_id reads as nothing before the colon; repeated
rows count each; ties go to the word first in code-point order; an empty table gives no rows; other
columns of the input play no part, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import _text
from strandline.llm._shared import durable, partitions_for, remove, written

#: Code points of a word, and its occurrences overall, at the least.
LENGTH = 5
TIMES = 3
#: One in SPOILT runs loses a letter.
SPOILT = 97
#: Words with one half in a shard; halves in a shard, about.
BLOCK = 4096
SHARD = 1 << 15
#: Words with one half from which on the rest is looked up by its deletions.
LISTED = 32
#: Words that a task counts before it passes them on.
HELD = 1 << 17

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LENGTH)


def word_counts(docs: DataFrame, least: int = TIMES) -> DataFrame:
    """(word, n): words of at least LENGTH code points with at least `least` occurrences."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for b in batches:
            data, offsets = _text.strings(b.column("text"))
            for k, doc_id in enumerate(b.column("doc_id").to_pylist()):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in _text.pieces(data[offsets[k] : offsets[k + 1]].tobytes().lower()):
                    for word, n in Counter(_RUN.findall(piece.decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % SPOILT == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < LENGTH:
                                continue
                        held[word] += n
                    if len(held) > HELD:
                        yield out()
        yield out()
        _text.release()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point lies between a and b."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def _deletions(rest: str) -> set[str]:
    return {rest[:i] + rest[i + 1 :] for i in range(len(rest))}


class _Half:
    """The words that share one half: what is left of each, and how often it occurs."""

    def __init__(self) -> None:
        self.words: list[tuple[str, str, int]] = []
        self.index: dict[str, list[tuple[str, str, int]]] | None = None

    def add(self, rest: str, word: str, n: int) -> None:
        self.words.append((rest, word, n))

    def near(self, rest: str) -> list[tuple[str, int]]:
        """Those whose rest is one edit from rest."""
        if len(self.words) <= LISTED:
            return [(w, n) for r, w, n in self.words if one_edit(r, rest)]
        if self.index is None:
            self.index = {}
            for own in self.words:
                for v in {own[0]} | _deletions(own[0]):
                    self.index.setdefault(v, []).append(own)
        met = {own for v in {rest} | _deletions(rest) for own in self.index.get(v, ())}
        return [(w, n) for r, w, n in met if one_edit(r, rest)]


class _Shard:
    """An automaton over the halves of some words; ends holds for each half the words that begin and that end with it."""

    def __init__(self, words: list[str], counts: list[int], sides: list[int]) -> None:
        self.automaton = ahocorasick.Automaton()
        halves: dict[str, tuple[dict[int, _Half], dict[int, _Half]]] = {}
        for word, n, side in zip(words, counts, sides, strict=True):
            cut = len(word) // 2
            half, rest = (word[cut:], word[:cut]) if side else (word[:cut], word[cut:])
            halves.setdefault(half, ({}, {}))[side].setdefault(len(word), _Half()).add(rest, word, n)
        for half, own in halves.items():
            self.automaton.add_word(half, (len(half), own))
        if halves:
            self.automaton.make_automaton()
        self.some = bool(halves)

    def near(self, word: str) -> list[tuple[str, int]]:
        """The words that are one edit from word, each once: by its beginning, or by its end if the beginning differs."""
        out: list[tuple[str, int]] = []
        size = len(word)
        for end, (length, (begins, ends)) in self.automaton.iter(word) if self.some else ():
            if end == length - 1:
                for m in (size - 1, size, size + 1):
                    if m in begins:
                        out += begins[m].near(word[length:])
            if end == size - 1:
                for m in (size - 1, size, size + 1):
                    if m in ends:
                        out += [x for x in ends[m].near(word[: size - length]) if not word.startswith(x[0][: m // 2])]
        return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): of each word with near words their number, and the most frequent of them, from words(word, n)."""
    spark = words.sparkSession
    total = words.count()
    shards = max(partitions_for(spark), 2 * total // SHARD)
    size = F.length("word")
    key = lambda side, m: F.struct(F.lit(side).alias("side"), m.cast("int").alias("m"), (F.substring("word", F.lit(1), F.floor(m / 2).cast("int")) if side == 0 else F.right("word", (m - F.floor(m / 2)).cast("int"))).alias("half"))
    stand = words.select("word", "n", F.explode(F.array(key(0, size), key(1, size))).alias("k")).select("word", "n", "k.*", F.lit(False).alias("asks"))
    asked = F.array(*[key(side, size + d) for side in (0, 1) for d in (-1, 0, 1)])
    ask = words.select("word", "n", F.explode(asked).alias("k")).select("word", "n", "k.*", F.lit(True).alias("asks")).filter(F.col("m") >= LENGTH)
    large = stand.groupBy("side", "m", "half").agg(F.count("*").alias("held")).filter(F.col("held") > BLOCK)
    large = durable(large.select("side", "m", "half", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")), "halves")
    rows = stand.unionByName(ask).join(large, ["side", "m", "half"], "left").fillna({"blocks": 1})
    block = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")))
    rows = rows.withColumn("block", F.explode(block)).select(F.pmod(F.xxhash64("side", "m", "half", "block"), F.lit(shards)).alias("shard"), "asks", "word", "n", "side")
    rows = rows.repartition(partitions_for(spark), "shard").sortWithinPartitions("shard", "asks", "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, automaton, last = None, ([], [], []), None, None
        for b in batches:
            found: list[tuple[str, int, int, str]] = []
            for own, asks, word, n, side in zip(*[b.column(c).to_pylist() for c in ("shard", "asks", "word", "n", "side")], strict=True):
                if own != shard:
                    shard, held, automaton, last = own, ([], [], []), None, None
                if not asks:
                    for x, v in zip(held, (word, n, side), strict=True):
                        x.append(v)
                    continue
                if word == last:
                    continue
                last = word
                automaton = automaton or _Shard(*held)
                if near := automaton.near(word):
                    best, best_n = min(near, key=lambda x: (-x[1], x[0]))
                    found.append((word, len(near), best_n, best))
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["word", "n_near", "best_n", "best"])
        _text.release()

    each = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms(word, form) of each word lead in the end, by pointer doubling."""
    spark = forms.sparkSession
    up, path = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = up.join(up.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        following, new = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        remove(spark, path)
        up, path = following.select("word", "root"), new
        if following.filter("moved").isEmpty():
            return up


def spelling_groups(docs: DataFrame) -> DataFrame:
    """Each word with its form and root (the word itself if it has no form), n, n_near and form_n."""
    words = durable(word_counts(docs), "words")
    near = words.join(near_words(words), "word", "left")
    has = F.col("best_n") >= 2 * F.col("n")
    near = durable(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "near")
    roots = last_forms(near.filter("form IS NOT NULL"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
