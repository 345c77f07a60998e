"""Values of a given rank, without sorting.

The values between two bounds are counted in ranges of equal width; prefix sums of the counts tell the range that holds the wanted rank; its least and greatest
value are the next bounds. Bounds are values that occur, so every round leaves one out at least, and as a rule all but a thousandth. The driver learns
``RANGES`` numbers for each wanted rank and round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 1024


def values_of_rank(rows: DataFrame, group: Column, value: str, wanted: list[tuple[str, int]]) -> list:
    """For every (group, rank from 1) the value with that rank in its group. Ranks must not exceed the group's rows; null values have none.

    group: a text; there are few groups with wanted ranks, however many rows they have.
    """
    spark = rows.sparkSession
    known = rows.select(group.cast("string").alias("group"), F.col(value).alias("value")).where("value is not null")
    names = sorted({g for g, _ in wanted})
    ends = {g: (lo, hi) for g, lo, hi in known.where(F.col("group").isin(*names)).groupBy("group").agg(F.min("value"), F.max("value")).collect()}
    state = [[g, k, *ends[g]] for g, k in wanted]
    kind = known.schema["value"].dataType.simpleString()
    while asked := [(i, g, lo, hi) for i, (g, _, lo, hi) in enumerate(state) if lo < hi]:
        bounds = spark.createDataFrame(asked, f"target int, group string, lo {kind}, hi {kind}")
        share = (F.col("value") - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo")).cast("double")
        slot = F.least(F.lit(RANGES - 1), F.floor(share * RANGES)).alias("slot")
        inside = known.join(bounds, "group").where(F.col("value").between(F.col("lo"), F.col("hi")))
        counts = inside.groupBy("target", slot).agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        for target in {a[0] for a in asked}:
            for row in sorted((r for r in counts if r.target == target), key=lambda r: r.slot):
                if state[target][1] <= row.n:
                    state[target][2:] = [row.lo, row.hi]
                    break
                state[target][1] -= row.n
    return [lo for _, _, lo, _ in state]
