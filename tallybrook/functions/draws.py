"""Repeatable random draws.

``rand(seed)`` depends on how rows are spread over partitions; a digest of the
row's own id does not, so the same seed gives the same data on any cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(parts) -> Column:
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *texts))


def draw(n: int | Column, *parts) -> Column:
    """Uniform whole number in [0, n) from the given parts (columns or literals)."""
    return F.conv(F.substring(_digest(parts), 1, 8), 16, 10).cast("bigint") % n


def hex_digits(count: int, *parts) -> Column:
    """At least ``4 * count`` random hexadecimal digits: one digest per eight draws."""
    return F.concat(*[_digest((*parts, i)) for i in range(-(-count // 8))])


def four_digits(digits: Column, i: int | Column) -> Column:
    """The ``i``-th group of four digits, from 0."""
    return F.substring(digits, i * 4 + 1, 4)
