"""Nucleotide codes as sets of bases: a symbol's place in CODES is the bit mask of its bases."""

from __future__ import annotations

from math import log2

from pyspark.sql import Column
from pyspark.sql import functions as F

# A=1, C=2, G=4, T=8; the symbol of mask m is the m-th of CODES.
CODES = "ACMGRSVTWYHKDBN"
PAIRED = "TGKCYSBAWRDMHVN"  # complements, in the order of CODES


def normalize(seq: Column) -> Column:
    return F.upper(seq)


def invalid_position(seq: Column) -> Column:
    """1-based place of the first symbol outside the alphabet; 0 where there is none."""
    return F.regexp_instr(F.upper(seq), F.lit(f"[^{CODES}]"))


def normalize_or_raise(seq: Column, context: Column | str) -> Column:
    """Upper-case sequence; an invalid symbol fails the query, naming its place but not the sequence."""
    where = invalid_position(seq)
    said = F.concat(F.lit("invalid nucleotide code at position "), where.cast("string"), F.lit(" in "), context if isinstance(context, Column) else F.lit(context))
    return F.when(where == 0, F.upper(seq)).otherwise(F.raise_error(said).cast("string"))


def mask(symbol: Column) -> Column:
    """Bit mask of a symbol's bases; 0 for anything outside the alphabet."""
    return F.when(F.length(symbol) == 1, F.call_function("instr", F.lit(CODES), symbol)).otherwise(F.lit(0))


def mask_at(seq: Column, i: Column) -> Column:
    return F.call_function("instr", F.lit(CODES), F.substr(seq, i, F.lit(1)))


def symbol(mask_: Column) -> Column:
    """The least symbol that covers a set of bases."""
    return F.substr(F.lit(CODES), mask_, F.lit(1))


def bases(mask_: Column) -> Column:
    """The bases of a mask as an array, in the order A, C, G, T."""
    return F.array_compact(F.array(*(F.when(mask_.bitwiseAND(F.lit(1 << i)) != 0, F.lit(b)) for i, b in enumerate("ACGT"))))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, CODES, PAIRED))


def mismatch_positions(oligo: Column, target: Column) -> Column:
    """1-based places where the target may be a base that the oligo doesn't allow.

    Unequal lengths fail the query; two empty sequences have no places.
    """
    n = F.length(oligo)
    bad = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & (mask_at(target, i).bitwiseAND(F.bitwise_not(mask_at(oligo, i))) != 0),
    )
    return F.when(n == F.length(target), bad).otherwise(F.raise_error(F.lit("oligo and target differ in length")).cast("array<int>"))


def degeneracy(seq: Column) -> Column:
    """Number of plain sequences that a coded one stands for."""
    symbols = F.filter(F.split(seq, ""), lambda s: s != "")
    return F.aggregate(symbols, F.lit(1).cast("long"), lambda acc, s: acc * F.bit_count(mask(s)))


def log2_degeneracy(seq: Column) -> Column:
    """Logarithm to base 2 of the number of plain sequences, which for long sequences no integer holds."""
    n = lambda codes: F.length(F.regexp_replace(seq, f"[^{codes}]", ""))
    by_size = {size: "".join(c for m, c in enumerate(CODES, 1) if m.bit_count() == size) for size in (2, 3, 4)}
    return n(by_size[2]) + n(by_size[3]) * float(log2(3)) + n(by_size[4]) * 2.0


def ambiguous_fraction(seq: Column) -> Column:
    """Share of symbols other than A, C, G and T; null for an empty sequence."""
    return F.length(F.regexp_replace(seq, "[ACGT]", "")) / F.nullif(F.length(seq), F.lit(0))


def gc_percent(seq: Column) -> Column:
    return F.lit(100.0) * F.length(F.regexp_replace(seq, "[^GCS]", "")) / F.nullif(F.length(seq), F.lit(0))


def compatible(mismatches: Column, oligo_length: Column, role: Column, max_primer: int, max_probe: int, reject_three_prime: bool, three_prime_bases: int) -> Column:
    """Few enough mismatches, and for primers (if asked) none in the last bases."""
    primer = role != "PROBE"
    cap = F.when(primer, F.lit(max_primer)).otherwise(F.lit(max_probe))
    tail = primer & F.lit(reject_three_prime) & F.exists(mismatches, lambda p: p > oligo_length - F.lit(three_prime_bases))
    return (F.size(mismatches) <= cap) & ~tail
