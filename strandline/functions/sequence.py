"""Nucleotide functions as Column expressions; nothing here leaves the JVM.

Null in, null out, unless a function says otherwise. Sequences are upper-case DNA; other letters
are kept by reverse_complement and read as X by translate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start and stop codons, as read forwards and on the reverse strand.
STARTS = ["ATG", "ATA", "ATT", "GTG", "TTG"]
STOPS = ["TAA", "TAG", "TGA"]
REVERSE_STARTS = ["CAT", "TAT", "AAT", "CAC", "CAA"]
REVERSE_STOPS = ["TTA", "CTA", "TCA"]
# Codons that also count as a start in the quality class.
QUALITY_STARTS = [*STARTS, "CTG"]
QUALITY_REVERSE_STARTS = [*REVERSE_STARTS, "CAG"]
# Start codons of genetic code 11.
CODE_11_STARTS = ["TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"]
# Residues of the standard code, codons in TCAG order.
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# Residue classes.
RESIDUE_CLASSES = {"polar": "STYQNC", "nonpolar": "FLIMPVAWG", "acidic": "DE", "basic": "HKR", "Stop codon": "*", "-----": "-"}

CODONS = {a + b + c: STANDARD_CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTRYKMBVDHacgtrykmbvdh", "TGCAYRMKVBHDtgcayrmkvbhd"))


def ungapped(seq: Column) -> Column:
    return F.replace(seq, F.lit("-"), F.lit(""))


def first_codon(seq: Column) -> Column:
    return F.substring(seq, 1, 3)


def last_codon(seq: Column) -> Column:
    return F.right(seq, F.lit(3))


def direction(seq: Column) -> Column:
    """forward, reverse or Error, by the codons at both ends."""
    first, last = first_codon(seq), last_codon(seq)
    return F.when(seq.isNull(), None).when(first.isin(STARTS) | last.isin(STOPS), "forward").when(last.isin(REVERSE_STARTS) | first.isin(REVERSE_STOPS), "reverse").otherwise("Error")


#: Whole codons from the beginning up to the first stop codon; one pass, without going back.
_UNSTOPPED = r"^(?:(?!TAA|TAG|TGA)(?s:...))*+"


def codons(seq: Column) -> Column:
    """The whole codons of a sequence, in order."""
    return F.regexp_extract_all(seq, F.lit("(?s)..."), F.lit(0))


def first_stop(seq: Column) -> Column:
    """Index from 0 of the first in-frame stop codon; null if there is none."""
    before = F.length(F.regexp_extract(seq, _UNSTOPPED, 0))
    return F.when(before + 3 <= F.length(seq), before)


def quality_class(seq: Column) -> Column:
    """One of good_quality and four bad_quality classes; no in-frame stop counts as multiple_stop."""
    first, last = first_codon(seq), last_codon(seq)
    start = first.isin(QUALITY_STARTS) | last.isin(QUALITY_REVERSE_STARTS)
    stop = last.isin(STOPS) | first.isin(REVERSE_STOPS)
    oriented = F.when(direction(seq) == "reverse", reverse_complement(seq)).otherwise(seq)
    at = first_stop(oriented)
    whole = F.when(at.isNull() | (at < F.length(seq) - 3), "bad_quality: multiple_stop").otherwise("good_quality")
    return (
        F.when(seq.isNull(), None)
        .when(start & stop, whole)
        .when(start, "bad_quality: no_stop")
        .when(stop, "bad_quality: no_start")
        .otherwise("bad_quality: no_start_stop")
    )


QUALITY_CLASSES = ["good_quality", "bad_quality: no_start", "bad_quality: no_stop", "bad_quality: no_start_stop", "bad_quality: multiple_stop"]


def translate(seq: Column) -> Column:
    """Residues of all whole codons; X for codons with other letters."""
    code = _map(CODONS)
    return F.array_join(F.transform(codons(seq), lambda c: F.coalesce(F.try_element_at(code, c), F.lit("X"))), "")


def coding_protein(seq: Column) -> Column:
    """The protein of a whole coding sequence of code 11 in its own direction, or '-' where it is none."""
    oriented = F.when(direction(seq) == "reverse", reverse_complement(seq)).otherwise(seq)
    size = F.length(oriented)
    good = (size % 3 == 0) & first_codon(oriented).isin(CODE_11_STARTS) & (first_stop(oriented) == size - 3)
    return F.when(seq.isNull(), None).when(good, F.concat(F.lit("M"), translate(F.substring(oriented, F.lit(4), F.greatest(size - 6, F.lit(0)))))).otherwise("-")


def residue_class(residue: Column) -> Column:
    by_residue = {r: c for c, rs in RESIDUE_CLASSES.items() for r in rs}
    return F.coalesce(F.try_element_at(_map(by_residue), residue), F.lit("unknown"))


def residue(codon: Column) -> Column:
    """The residue of one codon; X for codons with other letters."""
    return F.coalesce(F.try_element_at(_map(CODONS), codon), F.lit("X"))


def allele_number(allele_id: Column) -> Column:
    """The number at the end of an id such as 12 or locus_12; null where there is none."""
    return F.try_to_number(F.element_at(F.split(allele_id, "_"), -1), F.lit("999999999999")).cast("long")


def contig_name(subject_id: Column) -> Column:
    """A subject id such as gnl|contig|x without its outer parts."""
    parts = F.split(subject_id, r"\|")
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), "|")).otherwise(subject_id)


def final_sequence(contig: Column, start: Column, end: Column, turned: Column | None = None) -> Column:
    """The gene from a hit's start on its strand to the first in-frame stop codon; null without one, or where it is the first codon.

    For an allele stored in reverse (turned) it is read from the hit's end on the other strand.
    """
    turned = F.lit(False) if turned is None else turned
    begin = F.when(turned, end).otherwise(start)
    back = F.when(turned, end > start).otherwise(start > end)
    onward = F.when(back, reverse_complement(F.substring(contig, F.lit(1), begin))).otherwise(F.substring(contig, begin, F.length(contig)))
    stop = first_stop(onward)
    return F.when(stop > 0, F.substring(onward, F.lit(1), stop + 3))


# The texts of a mutation's effect and of its net result.
DELETION = "Global effect: DELETION. BLAST sequence length shorter than matching allele sequence length"
SUBSTITUTION = "Global effect: BASE SUBSTITUTION. BLAST sequence length equal to matching allele sequence length"
INSERTION = "Global effect: INSERTION. BLAST sequence length longer than matching allele sequence length"
NET_RESULT = " / Net result: {tag}. Final gene sequence length {size} than matching allele sequence length"


def mutation_effect(found_length: Column, allele_length: Column, tag: Column) -> Column:
    """Text for ASM and ALM calls."""
    what = F.when(found_length < allele_length, DELETION).when(found_length == allele_length, SUBSTITUTION).otherwise(INSERTION)
    net = F.when(tag == "ASM", NET_RESULT.format(tag="ASM", size="shorter")).otherwise(NET_RESULT.format(tag="ALM", size="longer"))
    return F.concat(what, net)
