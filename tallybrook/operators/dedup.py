"""First copy wins.

Which copy is first is fixed by (timestamp, partition, offset), so the result
does not depend on which task sees a copy first. One order id may hold a large
share of the log (a producer that retries for ever), so no plan here brings all
copies of an id together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION = ["timestamp", "partition", "offset"]


def first_copies(df: DataFrame, key: str = "order_id") -> DataFrame:
    """The first copy of each key.

    Rank 1 is taken within each input task before the shuffle, so at most one
    row per key and task travels.
    """
    by_key = Window.partitionBy(key).orderBy(*POSITION)
    return df.withColumn("_rank", F.row_number().over(by_key)).where("_rank = 1").drop("_rank")


def only_rows(staged: DataFrame, rows: int, wanted: DataFrame, stage: Callable[..., DataFrame]) -> DataFrame:
    """Those of the ``rows`` rows of a staged table whose ``_row`` is in ``wanted``, a staged table as well, which holds no others.

    Wide rows are not shuffled for their copies: those to leave out are looked up, by number alone. Usually they are few, and Spark sends
    them to every task; it joins by a shuffle if they are many.
    """
    if wanted.count() == rows:
        return staged
    # uncompressed, so that its size on disk tells Spark what it takes in memory
    others = stage(staged.select("_row").join(wanted, "_row", "left_anti"), compression="uncompressed")
    return staged.join(others, "_row", "left_anti")


def mark_copies(
    df: DataFrame, key: str = "order_id", candidate: Column | None = None, salts: int | None = None
) -> DataFrame:
    """Add ``is_copy``: true for every candidate row but the first of its key.

    Unlike ``first_copies`` this keeps every row. The copies of a key are spread
    over ``salts`` groups by a hash of their position; the first of each group
    then meet, at most ``salts`` rows per key. There are as many groups as
    shuffle partitions, so a group grows no faster than a partition does. Rows
    that need no comparison carry their own hash as group and spread evenly.
    """
    if salts is None:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candidate = F.lit(True) if candidate is None else F.coalesce(candidate, F.lit(False))
    place = F.xxhash64(*POSITION)
    rows = df.withColumn("_compared", candidate).withColumn("_place", place)
    for groups in (F.pmod("_place", F.lit(salts)), F.lit(0)):
        group = F.when(F.col("_compared"), F.col(key))
        slot = F.when(F.col("_compared"), groups).otherwise(F.col("_place"))
        ranked = Window.partitionBy(group, slot).orderBy(*POSITION)
        leads = F.col("_compared") & (F.row_number().over(ranked) == 1)
        rows = rows.withColumn("_compared", leads)
    return rows.withColumn("is_copy", candidate & ~F.col("_compared")).drop("_compared", "_place")


def not_stored(df: DataFrame, stored_ids: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows whose key is not in the stored table yet."""
    return df.join(stored_ids.select(key), key, "left_anti")


def duplicates(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")
