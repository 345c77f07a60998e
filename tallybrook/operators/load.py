"""One batch of the log into the stored tables.

decode and judge -> stage -> first copies -> not stored yet -> orders
                         \\-> quarantine, counters

The same function serves a batch job and every micro-batch of a stream. A batch
that is run again under its number gives the same tables: its own rows do not
count as stored before, and its partitions are replaced.
"""

from __future__ import annotations

import hashlib
import operator
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions.ids import order_month
from tallybrook.operators.classify import REASONS, SKIPPED_REASONS, classify, outcome_of
from tallybrook.operators.dedup import POSITION, first_copies, not_stored, only_rows
from tallybrook.schemas import ORDERS, OTHER_MONTH
from tallybrook.sinks.tables import (
    COUNTERS,
    BLOOM,
    QUARANTINE,
    Target,
    apply_updates,
    create_tables,
    customer_number,
    order_parts,
    overwrite_partitions,
    packed,
    read_orders,
    read_parts,
    scratch,
    switch_parts,
    write_orders,
)

# The months of a batch are put into at most this many ranges; more months make wider ranges.
MAX_RANGES = 64
# Batch number of rows gathered from finished batches; no stream uses it.
COMPACTED = -1


def month_ranges(months: list, most: int = MAX_RANGES) -> list[tuple[str, str, str, str]]:
    """(first month, last month, least id, greatest id), cut at the widest gaps between months."""
    rows = sorted(months, key=lambda r: r.m)
    # the catch-all month comes last, far from all others
    at = [10**6 if r.m == OTHER_MONTH else int(r.m) for r in rows]
    gaps = sorted(range(1, len(rows)), key=lambda i: at[i] - at[i - 1], reverse=True)
    starts = [0, *sorted(gaps[: most - 1])] if rows else []
    parts = [rows[a:b] for a, b in zip(starts, [*starts[1:], len(rows)])]
    return [(p[0].m, p[-1].m, min(r.lo for r in p), max(r.hi for r in p)) for p in parts]


def month_ends(rows: DataFrame) -> list:
    """Least and greatest id, largest customer number and times of creation of each month: the driver learns one row per month, and a month is six digits."""
    ends = [F.min("order_id").alias("lo"), F.max("order_id").alias("hi")]
    if "customer_id" in rows.columns:
        ends += [F.max(customer_number()).alias("customer"), F.min("created_at").alias("first"), F.max("created_at").alias("last")]
    return rows.where("order_id is not null").groupBy(order_month(F.col("order_id")).alias("m")).agg(*ends).collect()


def created_bounds(ends: list) -> dict[str, tuple]:
    return {r.m: (str(r.first), str(r.last)) for r in ends if r.first is not None}


def near(stored: DataFrame, rows: DataFrame, ends: list | None = None) -> DataFrame:
    """Stored rows that can have an order id of ``rows``.

    Leaves out the month folders that the ids do not name, and within each range
    of months the row groups beyond its least and greatest id.
    """
    ranges = month_ranges(month_ends(rows) if ends is None else ends)
    month, order = F.col("order_month"), F.col("order_id")
    inside = [month.between(first, last) & order.between(lo, hi) for first, last, lo, hi in ranges]
    return stored.where(reduce(operator.or_, inside, F.lit(False)))


def counters(rejected: dict[str, int], fit: int, stored: int) -> list[tuple[str, str, int]]:
    """(outcome, reason, messages): copies are what was fit and yet not stored."""
    rows = [("skipped" if reason in SKIPPED_REASONS else "failed", reason, n) for reason, n in rejected.items()]
    rows += [("skipped", "duplicate", fit - stored), ("processed", "", stored)]
    return [r for r in rows if r[2]]


def reason_figures() -> list:
    """Messages per reason, as one row."""
    count = lambda reason: F.count(F.when(F.col("reason").eqNullSafe(F.lit(reason)), 1))
    return [count(None).alias("fit"), *[count(r).alias(r) for r in REASONS]]


def for_stage(judged: DataFrame) -> DataFrame:
    """Only what later steps read: raw bytes of the rejected, items of the fit."""
    fit = F.col("reason").isNull()
    needed = {c: F.when(~fit, F.col(c)) for c in ("key", "value")}
    needed |= {c: F.when(fit, F.col(c)) for c in ("items", "items_json")}
    return judged.select(*[needed.get(c, F.col(c)).alias(c) for c in judged.columns])


def batch_number(batch_id: int, writer: str | None = None) -> int:
    """Stored number of a writer's batch.

    Every stream numbers its batches from 0. The upper bits hold a digest of the
    writer, so that two writers never replace each other's rows; batches without
    a writer keep their plain number.
    """
    if writer is None:
        return batch_id
    return ((1 + (int(hashlib.md5(writer.encode()).hexdigest(), 16) & 0x3FFFFFFF)) << 32) | batch_id


def load_batch(
    envelopes: DataFrame,
    target: Target,
    batch_id: int,
    processed_at: str | None = None,
    check_quantity: bool = False,
    writer: str | None = None,
) -> None:
    """Store a batch; counters are written last and so mark it complete.

    ``writer`` names the job or the checkpoint that numbers its batches. The same
    writer and number replace what they stored before, and nothing else.
    """
    spark: SparkSession = envelopes.sparkSession
    create_tables(spark, target)
    batch_id = batch_number(batch_id, writer)
    number = F.lit(batch_id).cast("bigint").alias("batch_id")
    name = hashlib.md5(target.root.encode()).hexdigest()

    # figures are taken while the tables are written, so nothing is read again to be counted
    judged, written = Observation(), Observation()
    outcome = outcome_of(F.col("reason")).alias("outcome")
    with scratch(spark, name) as stage:
        rows = for_stage(classify(envelopes, check_quantity, whole_items=True)).observe(judged, *reason_figures())
        staged = stage(rows.withColumn("_row", F.monotonically_increasing_id()))
        fit, rejected = staged.where("reason is null"), staged.where("reason is not null")
        figures = dict(judged.get)
        fit_rows = figures.pop("fit")

        # copies from earlier batches are looked for in the months of their ids, so
        # a late copy is found however late it is
        ends = month_ends(fit)
        stored = read_orders(spark, target).where(F.col("batch_id") != batch_id)
        known = near(stored, fit, ends).select("order_id")
        fresh = stage(not_stored(first_copies(fit.select("order_id", *POSITION, "_row")), known).select("_row"))
        parts, stored_rows = [], 0
        if not fresh.isEmpty():
            now = F.current_timestamp() if processed_at is None else F.lit(processed_at)
            kept = only_rows(fit, fit_rows, fresh, stage).withColumn("processed_at", now.cast("timestamp_ntz"))
            largest = max((r.customer for r in ends if r.customer is not None), default=0.0)
            orders = kept.select(*ORDERS.names, "items_json", "order_month", number)
            parts = write_orders(orders, target, largest, written, created_bounds(ends))
            stored_rows = written.get["rows"]

        bad = rejected.select(*[outcome if c == "outcome" else number if c == "batch_id" else c for c in QUARANTINE.names])
        overwrite_partitions(bad, target.quarantine, "batch_id")
    switch_parts(spark, target, lambda p: p.batch == batch_id, parts)

    counted = [(*row, batch_id) for row in counters(figures, fit_rows, stored_rows)]
    overwrite_partitions(spark.createDataFrame(counted, COUNTERS).coalesce(1), target.counters, "batch_id")


def update_stored(spark: SparkSession, target: Target, updates: DataFrame) -> None:
    """Apply status updates to the stored table.

    Only the folders (month and batch) that hold an updated order are rewritten. The driver learns which those are, as it
    knows the list of all folders anyway; so their rows are read by path and not joined to be picked.
    """
    folder = ["order_month", "batch_id"]
    before = order_parts(spark, target)
    with scratch(spark, hashlib.md5(target.root.encode()).hexdigest()) as stage:
        # read several times: only the last update of each order, made once
        newest = F.max_by(F.struct("status", "updated_at"), F.struct("updated_at", "status")).alias("newest")
        last = stage(updates.groupBy("order_id").agg(newest).select("order_id", "newest.*"))
        updated = near(read_parts(spark, target, before), last).join(last.select("order_id").distinct(), "order_id", "left_semi")
        touched = {tuple(r) for r in updated.select(*folder).distinct().collect()}
        # all rows of such a folder, also those beyond the range of the updated ids
        rows = read_parts(spark, target, [p for p in before if (p.month, p.batch) in touched])
        parts = write_orders(apply_updates(packed(rows), last), target)
    old = {(p.month, p.batch): p for p in before}
    parts = [replace(p, first=old[p.month, p.batch].first, last=old[p.month, p.batch].last) for p in parts]
    places = {(p.month, p.batch) for p in parts}
    switch_parts(spark, target, lambda p: (p.month, p.batch) in places, parts)


def compact_month(spark: SparkSession, target: Target, month: str) -> None:
    """Gather the files that many batches left in one month.

    For months no batch writes any more. The gathered rows are written beside the old ones, which go when the list names the new ones.
    """
    old = [p for p in order_parts(spark, target) if p.month == month]
    rows = read_orders(spark, target).where(F.col("order_month") == month)
    gathered = rows.withColumn("batch_id", F.lit(COMPACTED).cast("bigint"))
    largest = rows.agg(F.max(customer_number())).first()[0] or 0.0
    known = old and all(p.first is not None for p in old)
    bounds = {month: (min(p.first for p in old), max(p.last for p in old))} if known else None
    parts = write_orders(gathered, target, largest, bounds=bounds, **BLOOM)
    switch_parts(spark, target, lambda p: p.month == month, parts)
