"""A sort key that keeps rows near in two columns near in the file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 10


def interleaved(first: Column, second: Column, bits: int = BITS) -> Column:
    """The bits of two numbers below 2^bits in turn, the first one's ahead: a range of either makes few ranges of the key."""
    parts = []
    for i in range(bits):
        for place, number in ((2 * i + 1, first), (2 * i, second)):
            parts.append(F.shiftleft(F.shiftright(number, i).bitwiseAND(1), place))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def scaled(value: Column, least: float, most: float, bits: int = BITS) -> Column:
    """Place of a value between two others as a whole number below 2^bits; null and what lies outside go to the ends."""
    share = (value - F.lit(least)) / F.lit(max(most - least, 1e-9))
    top = (1 << bits) - 1
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(top), F.floor(share * (1 << bits)))), F.lit(0)).cast("bigint")


def within_month(time: Column, bits: int = BITS) -> Column:
    """Place of a time in its month."""
    seconds = (F.dayofmonth(time) - 1) * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return scaled(seconds, 0, 31 * 86400, bits)
