"""JSON-style containment on the items of an order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_items(items: Column, pattern: list[dict]) -> Column:
    """True where every pattern element matches some item on all keys it names.

    Order does not matter, extra keys of an item are ignored, and an empty
    pattern matches every order.
    """

    def matches(wanted: dict) -> Column:
        def same(item: Column) -> Column:
            checks = [item[key] == F.lit(value) for key, value in wanted.items()]
            return reduce(lambda a, b: a & b, checks, F.lit(True))

        return F.exists(items, same)

    return reduce(lambda a, b: a & b, [matches(p) for p in pattern], items.isNotNull())
