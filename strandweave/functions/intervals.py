"""Arithmetic of 1-based, inclusive intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def expanded(start: Column, end: Column, length: Column, wanted: int) -> tuple[Column, Column]:
    """An interval of ``wanted`` places about the middle of another, shifted to lie in 1..length."""
    size = F.least(length, F.lit(wanted))
    first = ((start + end) / 2).cast("int") - F.lit((wanted - 1) // 2)
    first = F.least(F.greatest(first, F.lit(1)), length - size + 1)
    return first.cast("int"), (first + size - 1).cast("int")


def overlap_fraction(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Shared places over the shorter interval's."""
    shared = F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start) + 1)
    return shared / F.least(a_end - a_start + 1, b_end - b_start + 1)


def mirrored(start: Column, end: Column, length: Column) -> tuple[Column, Column]:
    """The same places counted from the other end."""
    return length - end + 1, length - start + 1


def window_starts(length: Column, window: int, step: int) -> Column:
    """1, 1+step, ... and the last start that still fits; one start where the window is too long."""
    last = length - window + 1
    regular = F.sequence(F.lit(1).cast("int"), F.greatest(last, F.lit(1)).cast("int"), F.lit(step))
    return F.when(length < 1, F.array().cast("array<int>")).otherwise(F.array_distinct(F.concat(regular, F.array(F.greatest(last, F.lit(1)).cast("int")))))
