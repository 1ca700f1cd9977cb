"""Differences between alleles and found sequences, base by base."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import CODONS, RESIDUE_CLASSES, ungapped
from strandline.operators.align import SPREAD
from strandline.operators.pieces import fields

#: Differences of an Arrow batch, about.
ROWS = 1 << 17

_BASES = "ACGT"
_CODE = np.full(256, 64, np.int64)
_CODE[np.frombuffer(_BASES.encode(), np.uint8)] = np.arange(4)
_CLASS = {r: c for c, rs in RESIDUE_CLASSES.items() for r in rs}
_NAMES = ["bases", "codons", "residues", "kind", "classes"]


def _known(codon: str) -> str:
    return CODONS.get(codon, "X") if len(codon) == 3 else ""


def _values(ours: str, theirs: str, i: int, a: str, b: str) -> tuple[str, str, str, str, str]:
    """The texts of the difference at letter i of two codons with residues a and b."""
    ca, cb = _CLASS.get(a[:1], "unknown"), _CLASS.get(b[:1], "unknown")
    kind = "Synonymous" if ca == cb else "Nonsense" if b == "*" else "Missense"
    return f"{ours[i]}/{theirs[i]}", f"{ours}/{theirs}", f"{a}/{b}", kind, f"{ca} / {cb}"


def _tables() -> list[pa.Array]:
    """_values of every two codons of bases, the first's number before the second's; of bases, those of every two bases."""
    codons = [a + b + c for a in _BASES for b in _BASES for c in _BASES]
    rows = [_values(x, y, 0, _known(x), _known(y)) for x in codons for y in codons]
    return [pa.array([f"{x}/{y}" for x in _BASES for y in _BASES]), *[pa.array(c) for c in list(zip(*rows, strict=True))[1:]]]


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _differences(allele: str, found: str) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Places from 0 and codon pairs of differences between whole codons of bases, and (place, *_values) of all others up to the first in a codon with a '-'."""
    size, held = len(allele), min(len(found), len(allele))
    x, y = _letters(allele), np.full(size, ord("-"), np.uint32)
    y[:held] = _letters(found)[:held]
    at = np.flatnonzero(x != y)
    end = size if held == size else held // 3 * 3  # from here on codons hold a '-'
    whole, broken = at[at < end], at[at >= end][:1]
    n = end // 3 * 3
    codes = [np.where(v[:n] < 256, _CODE[np.minimum(v[:n], 255)], 64).reshape(-1, 3) for v in (x, y)]
    numbers = [c @ np.array([16, 4, 1]) for c in codes]
    good = ((codes[0] < 4) & (codes[1] < 4)).all(axis=1)
    inside = whole[whole < n]
    fast = inside[good[inside // 3]]
    rest = [*inside[~good[inside // 3]].tolist(), *whole[whole >= n].tolist()]
    rows = []
    theirs = found[:size].ljust(size, "-")
    for p in rest:
        c = p // 3 * 3
        one, two = allele[c : c + 3], theirs[c : c + 3]
        rows.append((p, *_values(one, two, p - c, _known(one), _known(two))))
    for p in broken.tolist():
        c = p // 3 * 3
        tail = "".join(_known(allele[k : k + 3]) for k in range(c, size - 2, 3))
        rows.append((p, *_values(allele[c : c + 3], theirs[c : c + 3], p - c, tail, "-")))
    return fast, numbers[0][fast // 3] * 64 + numbers[1][fast // 3], rows


def snps(pairs: DataFrame) -> DataFrame:
    """pairs(*keys, allele_seq, found_seq) to one row per difference.

    found_seq loses its gaps and is padded with '-' to the allele's length; what goes beyond is
    ignored. A pair's list ends with the first difference in a codon that holds a '-'. Rows have
    position (from 1), bases, codons, residues (allele/found), kind and classes; Synonymous means
    the same residue class. Pairs with a null sequence have no rows. Letters are compared as arrays, in Arrow
    batches; the texts of two codons of bases are looked up. The work grows with the length.
    """
    keys = [c for c in pairs.columns if c not in ("allele_seq", "found_seq")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables()
        shift = np.array([16, 4, 1])  # of the letter in its codon
        for b in batches:
            owners, places, twos, slow, held = [], [], [], [], 0

            def out(b: pa.RecordBatch = b) -> Iterator[pa.RecordBatch]:
                if places:
                    owner, place, two = (np.concatenate(c) for c in (owners, places, twos))
                    step = shift[place % 3]
                    bases = two // 64 // step % 4 * 4 + two % 64 // step % 4
                    key = b.select(keys).take(pa.array(owner))
                    values = [tables[0].take(pa.array(bases)), *[t.take(pa.array(two)) for t in tables[1:]]]
                    yield pa.RecordBatch.from_arrays([*key.columns, pa.array(place + 1, pa.int32()), *values], names=[*keys, "position", *_NAMES])
                if slow:
                    columns = list(zip(*slow, strict=True))
                    key = b.select(keys).take(pa.array(columns[0], pa.int64()))
                    values = [pa.array(c, pa.string()) for c in columns[2:]]
                    yield pa.RecordBatch.from_arrays([*key.columns, pa.array([p + 1 for p in columns[1]], pa.int32()), *values], names=[*keys, "position", *_NAMES])

            for k, (allele, found) in enumerate(zip(b.column("allele_seq"), b.column("found_seq"), strict=True)):
                if not (allele.is_valid and found.is_valid):
                    continue
                fast, two, rows = _differences(allele.as_py(), found.as_py())
                owners.append(np.full(len(fast), k))
                places.append(fast)
                twos.append(two)
                slow.extend((k, *r) for r in rows)
                held += len(fast) + len(rows)
                if held >= ROWS:
                    yield from out()
                    owners, places, twos, slow, held = [], [], [], [], 0
            yield from out()

    rows = pairs.select(*keys, "allele_seq", ungapped(F.col("found_seq")).alias("found_seq"))
    rows = rows.repartition(SPREAD * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)  # a pair makes many times its bytes
    return rows.mapInArrow(run, ", ".join([fields(pairs, keys), "position int", *[f"{c} string" for c in _NAMES]]))
