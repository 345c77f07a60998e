"""Runs that take a given number of messages from the log.

A run takes the next messages of every partition, as many from each as there are, shared evenly (what does not divide goes to the smaller partitions
first). The ends are found by counting offsets in ranges (``operators.selection``): no message is sorted.

Progress is a list that is replaced as a whole: a run's ranges are noted before it starts and marked done afterwards. A run that died is taken up again with
the same ranges and the same batch number, so its orders are stored once.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators.load import load_batch
from tallybrook.operators.selection import values_of_rank
from tallybrook.sinks.listing import Listing
from tallybrook.sinks.tables import Target


def share(available: dict, wanted: int) -> dict:
    """How many messages each partition gives: level by level, what is left over to the smaller keys."""
    given, left = dict.fromkeys(available, 0), wanted
    open_ = sorted(k for k, n in available.items() if n)
    while open_ and left >= len(open_):
        more = min(left // len(open_), min(available[k] - given[k] for k in open_))
        for k in open_:
            given[k] += more
        left -= more * len(open_)
        open_ = [k for k in open_ if given[k] < available[k]]
    for k in open_[:left]:
        given[k] += 1
    return given


def _any(conditions: list[Column]) -> Column:
    return reduce(operator.or_, conditions, F.lit(False))


def unread(log: DataFrame, position: dict) -> DataFrame:
    """Messages behind the offsets that were taken; of partitions without one, all."""
    behind = [(F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") < end) for (t, p), end in position.items()]
    return log.where(~_any(behind))


def ends_of(log: DataFrame, wanted: dict[tuple, int]) -> dict[tuple, int]:
    """Offset behind the n-th message of each partition, for the n that is wanted of it."""
    asked = [(k, n) for k, n in sorted(wanted.items()) if n]
    name = F.concat_ws(" ", F.col("partition"), F.col("topic"))
    found = values_of_rank(log, name, "offset", [(f"{p} {t}", n) for (t, p), n in asked])
    return {k: offset + 1 for (k, _), offset in zip(asked, found)}


def run_messages(log: DataFrame, target: Target, name: str, messages: int, **how) -> int:
    """Load the next ``messages`` of the log into the target as run of ``name``; how many there were."""
    spark: SparkSession = log.sparkSession
    progress = Listing(spark, f"{target.root}/progress/{name}")
    run = (progress.read() or [None])[0]
    if run is None or run["done"]:
        position = {(t, p): end for t, p, end in run["taken"]} if run else {}
        rest = unread(log, position)
        available = {(t, p): n for t, p, n in rest.groupBy("topic", "partition").agg(F.count("*")).collect()}
        given = share(available, messages)
        ends = ends_of(rest, given)
        if not ends:
            return 0
        ranges = [[t, p, position.get((t, p), 0), end] for (t, p), end in sorted(ends.items())]
        taken = [[t, p, end] for (t, p), end in sorted({**position, **ends}.items())]
        run = {"number": run["number"] + 1 if run else 0, "ranges": ranges, "messages": sum(given.values()), "taken": taken, "done": False}
        progress.replace([run])
    # else a run that died is taken up again
    inside = [(F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") >= start) & (F.col("offset") < end) for t, p, start, end in run["ranges"]]
    load_batch(log.where(_any(inside)), target, run["number"], writer=f"run {name}", **how)
    progress.replace([{**run, "done": True}])
    return run["messages"]
