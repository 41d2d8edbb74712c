"""Whole-string similarity from the longest common subsequence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two non-empty texts.

    Interpreted row by row, so call it only on pairs that passed a cheap filter.
    """
    width = F.length(b)

    def next_row(prev: Column, ca: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), width),
            F.array(F.lit(0)),
            lambda row, j: F.concat(
                row,
                F.array(
                    F.when(ca == F.substring(b, j, F.lit(1)), F.get(prev, j - 1) + 1).otherwise(
                        F.greatest(F.get(row, j - 1), F.get(prev, j))
                    )
                ),
            ),
        )

    rows = F.aggregate(F.split(a, ""), F.array_repeat(F.lit(0), width + 1), next_row)
    return F.element_at(rows, -1)


def letter_mask(text: Column) -> Column:
    """A bit per letter that occurs, letters sharing 64 bits.

    One insertion or deletion changes at most one bit, so two masks that differ in more bits than
    the edit budget prove the texts too far apart.
    """
    bit = lambda mask, char: mask.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(char) % 64)
    )
    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), bit)


def pair_mask(text: Column) -> Column:
    """A bit per pair of neighbouring letters that occurs, pairs sharing 64 bits.

    One insertion or deletion removes or adds at most three pairs.
    """
    code = lambda i: F.ascii(F.substring(text, i, F.lit(1)))
    bit = lambda mask, i: mask.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (code(i) * 7 + code(i + 1)) % 64)
    )
    places = F.when(F.length(text) > 1, F.sequence(F.lit(1), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.lit(0).cast("bigint"), bit)


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def edit_budget(total_length: Column, cutoff: int) -> Column:
    """Most insertions plus deletions that keep the similarity at or above the cut-off percent."""
    return F.floor(total_length * F.lit(100 - cutoff) / F.lit(100)).cast("int")


def passes_cutoff(lcs: Column, total_length: Column, cutoff: int) -> Column:
    """``2 * lcs / total >= cutoff / 100`` in whole numbers."""
    return F.lit(200) * lcs >= F.lit(cutoff) * total_length


def length_ratio_ok(a: Column, b: Column, limit: float) -> Column:
    shorter = F.least(F.length(a), F.length(b))
    longer = F.greatest(F.length(a), F.length(b))
    return (shorter > 0) & (longer <= shorter * F.lit(limit))
