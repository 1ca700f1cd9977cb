"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text's terms are its lower-cased words (a text without any is one term), weighted by their
counts. For each of SAMPLES positions a term of weight w draws from its hash r and c, gamma(2, 1),
and b, uniform; with t = floor(ln w / r + b) its value is a = c exp(-r (t - b + 1)), and the term
with the least value is sampled. Two fingerprints agree at a position with the probability of the
texts' generalised Jaccard similarity. A position keeps 16 bits of a hash of (term, t), written as
4 hex digits.

Most values need not be computed: see _picks. Where that leaves a position without any value, all values
of the text are computed in a second pass, so fingerprints are exact.

Documents are dealt into ranges of doc_id of about PARTITION_BYTES of text, so that one shuffle of
the texts serves the search for the next document and both aggregations: CELLS quantiles of doc_id from
one pass over the table, each cut into ranges of equal width where more are needed. Each range also holds
the first document of the next one, marked, and drops it after use.

Defined cases: null and empty texts are one empty term; rows of equal doc_id follow each other in
the order of a hash, and a doc_id with very many rows spans several ranges; a null doc_id comes
first; a single document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm._shared import durable, scratch_dir

SAMPLES = 64
FAR = 20
PARTITION_BYTES = 8 << 20
CELLS = 1024
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SIDE = ["range", "seq", "side"]


def _bits(u: Column, shift: int, n: int) -> Column:
    return (F.shiftrightunsigned(u, shift) if shift else u).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _uniform(u: Column, shift: int, n: int) -> Column:
    """A number strictly between 0 and 1 from n bits of u."""
    return (_bits(u, shift, n).cast("double") + 0.5) * 2.0**-n


def _picks(counts: DataFrame, keys: list[str], samples: int, far: float | None) -> DataFrame:
    """counts(*keys, n, term, w), n the text's words, to one row per keys with p0, p1, ...: the least of the terms' values of each position.

    A value is a long: a in units of 2^-42 above 16 bits of (term, t). One hash of 64 bits gives
    the five uniform numbers of a draw, a product of two standing for a gamma variable. The least a
    of a text is exponential with rate n; a value whose lower bound, c >= 1 - exp(-c) and
    r (t - b + 1) <= r + ln w, already lies above far / n is not computed. If the least of the computed ones is
    at most far / n, it is the least of all; else, with a chance of exp(-far), the position is null. far None computes all.
    """
    least = []
    for j in range(samples):
        u = F.xxhash64("term", F.lit(j))
        exp_r = _uniform(u, 0, 12) * _uniform(u, 12, 12)  # exp(-r)
        exp_c = _uniform(u, 24, 12) * _uniform(u, 36, 12)  # exp(-c)
        log_r = F.ln(exp_r)
        b = _uniform(u, 48, 16)
        t = F.floor(b - F.col("log_w") / log_r)
        value = (F.ln(exp_c) * F.exp(log_r * (t - b + 1)) * -float(1 << 42)).cast("long")
        mark = (F.shiftrightunsigned(u, 48) + t * 40503).bitwiseAND(F.lit(0xFFFF).cast("long"))
        marked = F.shiftleft(value, 16).bitwiseOR(mark)
        near = None if far is None else (1 - exp_c) * exp_r <= F.col("most")
        least.append(F.min(marked if near is None else F.when(near, marked)).alias(f"p{j}"))
    drawn = counts.select(*keys, "n", "term", F.ln(F.col("w").cast("double")).alias("log_w"), (F.col("w") * float(far or 0) / F.col("n")).alias("most"))
    out = drawn.groupBy(*keys, "n").agg(*least)
    if far is None:
        return out
    sure = lambda p: F.shiftright(p, 16) <= far * float(1 << 42) / F.col("n")
    return out.select(*keys, *[F.when(sure(F.col(f"p{j}")), F.col(f"p{j}")).alias(f"p{j}") for j in range(samples)])


def _hex(packed: list[Column]) -> Column:
    """4 hex digits a position; null if any is null."""
    return F.concat(*[F.lpad(F.lower(F.hex(p.bitwiseAND(F.lit(0xFFFF).cast("long")))), 4, "0") for p in packed])


def likeness(a: Column, b: Column, n: int = SAMPLES) -> Column:
    """Share of positions at which two fingerprints agree."""
    same = [F.when(F.substring(a, 4 * j + 1, 4) == F.substring(b, 4 * j + 1, 4), 1).otherwise(0) for j in range(n)]
    return sum(same[1:], same[0]) / F.lit(float(n))


def _place(x: Column, u: Column, cuts: list[int], lo: int, hi: int, parts: int) -> Column:
    """The range of doc_id x, u from 0 to 1 its row's tie: the cell between two cuts, times parts, and the part of the cell's width.

    Equal cuts are cells of one doc_id; its rows are dealt over them by u.
    """
    step = max(1, math.isqrt(len(cuts)))
    fine = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = F.size(F.filter(F.lit([f[-1] for f in fine]), lambda c: c < x)) if cuts else F.lit(0)  # whole groups of cuts below
    cell = below * step + F.coalesce(F.size(F.filter(F.get(F.array(*[F.lit(f) for f in fine]), below), lambda c: c < x)), F.lit(0)) if cuts else F.lit(0)
    if len(set(cuts)) < len(cuts):
        equal = F.greatest(F.size(F.filter(F.lit(cuts), lambda c: c == x)), F.lit(1))
        cell = cell + F.least(F.floor(u * equal).cast("int"), equal - 1)
        u = u * equal - F.floor(u * equal)
    cell = F.least(cell, F.lit(len(cuts)))
    if parts == 1:
        return cell.cast("int")
    left, right = F.get(F.lit([lo - 1, *cuts]), cell), F.get(F.lit([*cuts, hi]), cell)
    share = F.when(right - left > 1, (x - left - 1) / (right - left)).otherwise(u)
    return (cell * parts + F.least(F.floor(share * parts).cast("int"), F.lit(parts - 1))).cast("int")


def _ranged(docs: DataFrame, partition_bytes: int) -> tuple[DataFrame, int]:
    """(doc_id, text, tie, range), and the number of ranges; ranges follow (doc_id, tie)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text", F.monotonically_increasing_id()))
    at = [i / CELLS for i in range(1, CELLS)]
    stats = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.percentile_approx("doc_id", at, 100 * CELLS).alias("cuts")).first()
    n = max(1, math.ceil((stats.bytes or 0) / partition_bytes))
    cells, parts = min(n, CELLS), -(-n // CELLS)
    if n == 1 or stats.lo is None:
        return rows.withColumn("range", F.lit(0)), 1
    cuts = [stats.cuts[round(i * CELLS / cells) - 1] for i in range(1, cells)]
    place = _place(F.col("doc_id"), F.col("tie") / F.lit(2.0**64) + 0.5, cuts, stats.lo, stats.hi, parts)
    return rows.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place)), cells * parts


def with_next(docs: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(range, seq, marked, doc_id, text, next_text) partitioned by range; marked rows belong to the next range."""
    rows, n = _ranged(docs, partition_bytes)
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "tie")
    heads = durable(rows.groupBy("range").agg(F.min_by(F.struct("doc_id", "text", "tie"), key).alias("head")), "heads")
    # the numbers of the ranges alone are put in a circle in one task
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    circle = heads.select("range", before.alias("before"))
    heads = heads.join(circle, "range").select(F.col("before").alias("range"), "head.*").withColumn("marked", F.lit(True))
    both = rows.withColumn("marked", F.lit(False)).unionByName(heads).repartitionById(n, "range")
    order = Window.partitionBy("range").orderBy("marked", F.col("doc_id").asc_nulls_first(), "tie")
    return both.select("range", "marked", "doc_id", "text", F.row_number().over(order).alias("seq"), F.lead("text").over(order).alias("next_text"))


def _edited(rows: DataFrame) -> DataFrame:
    """rows of with_next with size and edited, the edited text (null for marked rows)."""
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    return rows.withColumns({"size": size, "edited": F.when(~F.col("marked"), edited)})


def _prints(rows: DataFrame, samples: int, far: float | None) -> DataFrame:
    """(range, seq, side, print): fingerprints of text (side 0) and edited (side 1); null where far leaves a position without a value."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))
    found = F.array_remove(F.split(F.lower("s.t"), _NO_WORD), "")
    words = rows.select("range", "seq", F.explode(sides).alias("s")).filter("s.t IS NOT NULL").select("range", "seq", "s.side", "s.t", found.alias("found"))
    words = words.select(*_SIDE, F.greatest(F.size("found"), F.lit(1)).alias("n"), F.explode_outer(F.when(F.size("found") > 0, F.col("found")).otherwise(F.array("t"))).alias("term"))
    counts = words.groupBy(*_SIDE, "n", F.xxhash64("term").alias("term")).agg(F.count("*").alias("w"))
    return _picks(counts, _SIDE, samples, far).select(*_SIDE, _hex([F.col(f"p{j}") for j in range(samples)]).alias("print"))


def fingerprint_report(docs: DataFrame, samples: int = SAMPLES, partition_bytes: int = PARTITION_BYTES, far: float | None = FAR) -> DataFrame:
    """One row per document row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    docs = docs.select("doc_id", "text")
    rows = _edited(with_next(docs, partition_bytes))
    facts = rows.select("range", "seq", "marked", "doc_id", F.col("size").cast("long").alias("n_chars"), F.when(~F.col("marked"), F.sha2("edited", 256)).alias("edited_sha256"))
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("print")))
    pairs = _prints(rows, samples, far).groupBy("range", "seq").agg(of(0).alias("fingerprint"), of(1).alias("edited_fingerprint"))
    folder = scratch_dir(docs.sparkSession, "prints")
    found = facts.join(pairs, ["range", "seq"])
    found.write.parquet(folder)
    found = docs.sparkSession.read.schema(found.schema).parquet(folder)
    open_ = found.filter("fingerprint IS NULL OR (edited_fingerprint IS NULL AND NOT marked)").select("range", "seq")
    if open_.limit(1).count():
        again = _prints(rows.join(open_, ["range", "seq"], "left_semi"), samples, None).groupBy("range", "seq").agg(of(0).alias("f"), of(1).alias("e"))
        found = found.join(again, ["range", "seq"], "left").withColumns({"fingerprint": F.coalesce("f", "fingerprint"), "edited_fingerprint": F.coalesce("e", "edited_fingerprint")})
    found = found.withColumn("next", F.lead("fingerprint").over(Window.partitionBy("range").orderBy("seq"))).filter("NOT marked")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next"), samples).alias("near_next"),
    )
