"""Sketches that are stored with each part of a table and merged when they are asked.

A part's sketch is made once, when the part is written, and has a few kilobytes; the answer for any number of parts comes from their sketches
alone. Both kinds state their error, and ``distinct_report`` and ``percentile_report`` hold it against the exact figures.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.selection import values_of_rank

#: Registers of a distinct sketch (a power of two): the relative error has a standard deviation of 1.04 / sqrt(registers).
LOG_REGISTERS = 14
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(1 << LOG_REGISTERS)
#: Size of a quantile sketch; its ranks are off by less than ``RANK_ERROR`` of all rows.
QUANTILE_SIZE = 1024
RANK_ERROR = 0.01


def distinct_sketches(rows: DataFrame, part: str | Column, column: str) -> DataFrame:
    """(part, sketch): one distinct sketch for each part."""
    return rows.groupBy((F.col(part) if isinstance(part, str) else part).alias("part")).agg(F.hll_sketch_agg(column, F.lit(LOG_REGISTERS)).alias("sketch"))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """(estimate): of all parts together."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def distinct_report(rows: DataFrame, sketches: DataFrame, column: str, name: str) -> DataFrame:
    """The exact number, and whether the merged sketches come within their stated error."""
    estimate = merged_distinct(sketches).first().estimate or 0
    within = F.abs(F.lit(estimate) - F.col(name)) <= F.lit(DISTINCT_ERROR) * F.col(name)
    return rows.agg(F.count_distinct(column).alias(name)).select(name, within.alias("within_error"))


def quantile_sketches(rows: DataFrame, group: str, part: Column, column: str) -> DataFrame:
    """(group, part, sketch): one quantile sketch for each group and part; null values are left out."""
    known = rows.where(F.col(column).isNotNull())
    return known.groupBy(group, part.alias("part")).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(QUANTILE_SIZE)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, group: str, marks: list[float]) -> DataFrame:
    """(group, sketched): the quantiles of each group, over all parts."""
    merged = sketches.groupBy(group).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(group, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, marks))).alias("sketched"))


def percentile_report(rows: DataFrame, sketches: DataFrame, group: str, column: str, marks: dict[str, float]) -> DataFrame:
    """Per group the number of rows, the exact percentiles (the least value with that share of rows up to it), and whether
    the rank of every sketched one is within its stated error. Rows without a group are left out."""
    spark = rows.sparkSession
    known = rows.where(F.col(column).isNotNull() & F.col(group).isNotNull())
    counts = {g: n for g, n in known.groupBy(group).agg(F.count("*")).collect()}
    wanted = [(g, max(1, math.ceil(share * n))) for g, n in sorted(counts.items()) for share in marks.values()]
    values = values_of_rank(known, F.col(group), column, wanted)
    width = len(marks)
    exact = [(g, n, *values[i * width : (i + 1) * width]) for i, (g, n) in enumerate(sorted(counts.items()))]
    shape = f"{group} string, records bigint, " + ", ".join(f"{m} double" for m in marks)
    table = spark.createDataFrame(exact, shape)
    sketched = merged_quantiles(sketches, group, list(marks.values()))
    # rows below and up to each sketched value, in one pass
    ranks = []
    for i in range(width):
        at = F.col("sketched")[i]
        ranks += [F.sum((F.col(column) < at).cast("bigint")).alias(f"below{i}"), F.sum((F.col(column) <= at).cast("bigint")).alias(f"upto{i}")]
    counted = known.join(sketched, group).groupBy(group).agg(*ranks)
    fine = F.lit(True)
    for i, share in enumerate(marks.values()):
        fine = fine & (F.col(f"below{i}") <= (share + RANK_ERROR) * F.col("records")) & (F.col(f"upto{i}") >= (share - RANK_ERROR) * F.col("records"))
    return table.join(counted, group).select(group, "records", *marks, fine.alias("within_error"))
