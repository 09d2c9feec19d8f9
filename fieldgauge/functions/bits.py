"""Whole numbers that keep rows close which are close in two columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of each of the two numbers.
BITS = 31
# Each step moves the upper half of a group of bits away by the group's size; the masks
# are the bits that hold after it.
_STEPS = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def spread_bits(number: Column) -> Column:
    """A number of at most BITS bits with a zero before each bit."""
    wide = number.cast("bigint")
    for shift, mask in _STEPS:
        wide = wide.bitwiseOR(F.shiftleft(wide, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return wide


def interleave(first: Column, second: Column) -> Column:
    """The bits of two numbers in turn, those of the first being the higher of each pair."""
    return F.shiftleft(spread_bits(first), 1).bitwiseOR(spread_bits(second))


def scaled(number: Column, least: int, greatest: int, bits: int = BITS) -> Column:
    """A number between two bounds as one of `bits` bits, equally wide steps."""
    most = (1 << bits) - 1
    share = (number.cast("double") - F.lit(float(least))) / F.lit(float(max(greatest - least, 1)))
    steps = F.floor(share * F.lit(float(most))).cast("bigint")
    return F.when(number.isNotNull(), F.greatest(F.least(steps, F.lit(most).cast("bigint")), F.lit(0).cast("bigint")))
