"""Reports on the stored orders and on the log.

Each takes DataFrames and returns one; nothing here runs a job. Counts and sums
are combined before the shuffle, so a customer with a large share of all orders
costs no more than any other.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.containment import contains_items
from tallybrook.functions.ids import ORDER_ID_PATTERN
from tallybrook.functions.times import micros_between
from tallybrook.schemas import OTHER_MONTH

# columns of a row listing
LISTED = ["order_id", "customer_id", "total_amount", "status", "created_at"]
TOTAL = "decimal(38,2)"


# --- counts and sums ------------------------------------------------------


def total_orders(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count("*").alias("orders"))


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.count("*").alias("orders"))


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count("*").alias("orders"))


def revenue_per_customer(orders: DataFrame) -> DataFrame:
    """Biggest spender first."""
    spent = F.sum("total_amount").cast(TOTAL).alias("total_spent")
    by_customer = orders.groupBy("customer_id").agg(F.count("*").alias("orders"), spent)
    return by_customer.orderBy(F.desc("total_spent"), "customer_id")


def average_order_value(orders: DataFrame) -> DataFrame:
    total = F.sum("total_amount").cast("double")
    return orders.agg(F.round(total / F.count("total_amount"), 2).alias("average_value"))


def unique_customers(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count_distinct("customer_id").alias("customers"))


def unique_customers_estimate(orders: DataFrame, error: float = 0.02) -> DataFrame:
    """Sketch of the above: one small sketch per task instead of all ids."""
    return orders.agg(F.approx_count_distinct("customer_id", error).alias("customers"))


def uniqueness(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Rows against distinct ids, for orders and for items."""

    def counts(df: DataFrame, subject: str, column: str) -> DataFrame:
        return df.agg(
            F.lit(subject).alias("subject"),
            F.count("*").alias("row_count"),
            F.count_distinct(column).alias("distinct_ids"),
        )

    return counts(orders, "orders", "order_id").union(counts(items, "items", "item_id"))


def id_uniqueness(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows against distinct values of ``id``, for each named table; equal where every id is there once."""
    counts = [
        rows.agg(F.lit(name).alias("subject"), F.count("*").alias("row_count"), F.count_distinct("id").alias("distinct_ids")) for name, rows in parts.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("all_distinct", F.col("row_count") == F.col("distinct_ids"))


def item_counts(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.size("items").cast("bigint").alias("item_count"))


def order_items(orders: DataFrame) -> DataFrame:
    """One row per item, with its place in the order."""
    placed = orders.select("order_id", F.posexplode("items").alias("position", "item"))
    return placed.select("order_id", F.col("position").cast("bigint").alias("position"), "item.*")


def totals_from_items(orders: DataFrame) -> DataFrame:
    """Total of each order by its items, beside the total it states."""
    zero = F.lit(0).cast("decimal(20,2)")
    summed = F.aggregate("items", zero, lambda acc, i: (acc + i["subtotal"]).cast("decimal(20,2)"))
    return orders.select("order_id", "total_amount", summed.cast(TOTAL).alias("item_total"))


# --- listings -------------------------------------------------------------


def newest_first(orders: DataFrame) -> DataFrame:
    return orders.select(*LISTED).orderBy(F.desc("created_at"), "order_id")


def latest(orders: DataFrame, n: int = 10) -> DataFrame:
    return newest_first(orders).limit(n)


def of_customer(orders: DataFrame, customer: str) -> DataFrame:
    return orders.where(F.col("customer_id") == customer).select(*LISTED)


def customer_history(orders: DataFrame, customer: str) -> DataFrame:
    """One customer's orders, oldest first."""
    return of_customer(orders, customer).orderBy("created_at", "order_id")


def customer_between(orders: DataFrame, customer: str, start: str, end: str) -> DataFrame:
    """One customer's orders in [start, end)."""
    when = F.col("created_at")
    begin, finish = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return of_customer(orders, customer).where((when >= begin) & (when < finish))


def since(orders: DataFrame, asof: str, hours: int) -> DataFrame:
    """Orders created in the given hours before ``asof``, newest first."""
    edge = F.lit(asof).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    until = F.lit(asof).cast("timestamp_ntz")
    return newest_first(orders.where((F.col("created_at") > edge) & (F.col("created_at") <= until)))


def with_status(orders: DataFrame, status: str) -> DataFrame:
    return orders.where(F.col("status") == status).select(*LISTED)


def by_id(orders: DataFrame, order_id: str) -> DataFrame:
    if "order_month" in orders.columns:
        orders = orders.where(F.col("order_month") == (order_id[4:10] if re.match(ORDER_ID_PATTERN, order_id) else OTHER_MONTH))
    return orders.where(F.col("order_id") == order_id).select(*LISTED).limit(1)


def containing(orders: DataFrame, pattern: list[dict]) -> DataFrame:
    """Orders whose items contain the pattern, read from the embedded items."""
    return orders.where(contains_items(F.col("items"), pattern)).select(*LISTED)


def containing_by_lines(orders: DataFrame, lines: DataFrame, wanted: dict) -> DataFrame:
    """The same for one pattern element, from a table of items.

    A scan of the item table keeps only the matching ids, so no order row has
    to carry its items along.
    """
    match = lines
    for name, value in wanted.items():
        match = match.where(F.col(name) == F.lit(value))
    ids = match.select("order_id").distinct()
    return orders.join(ids, "order_id", "left_semi").select(*LISTED)


# --- latency --------------------------------------------------------------


def latency(orders: DataFrame) -> DataFrame:
    """Seconds from creation to storage, slowest first."""
    wait = micros_between(F.col("created_at"), F.col("processed_at")) / F.lit(1e6)
    rows = orders.select("order_id", "created_at", "processed_at", wait.alias("latency_seconds"))
    return rows.orderBy(F.desc("latency_seconds"), "order_id")


def latency_of_latest(orders: DataFrame, n: int = 10) -> DataFrame:
    wait = micros_between(F.col("created_at"), F.col("processed_at")) / F.lit(1e3)
    rows = orders.select(
        "order_id", "customer_id", "created_at", "processed_at", wait.alias("latency_ms")
    )
    return rows.orderBy(F.desc("created_at"), "order_id").limit(n)


# --- the log --------------------------------------------------------------


def partition_inventory(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def partition_distribution(log: DataFrame) -> DataFrame:
    """Messages per partition and their share of the topic, in percent."""
    counts = log.groupBy("topic", "partition").agg(F.count("*").alias("messages"))
    # one row per partition by now
    whole = F.sum("messages").over(Window.partitionBy("topic"))
    return counts.withColumn("share", F.round(F.col("messages") * 100.0 / whole, 4))


def partitions_in_use(log: DataFrame) -> DataFrame:
    used = F.count_distinct("partition").alias("partitions")
    return log.groupBy("topic").agg(used).withColumn("spread", F.col("partitions") > 1)


def key_inconsistencies(log: DataFrame) -> DataFrame:
    """Keys found in more than one partition; there should be none."""
    ends = log.groupBy("key").agg(F.min("partition").alias("lo"), F.max("partition").alias("hi"))
    return ends.where("lo <> hi").select(
        F.col("key").cast("string").alias("key"),
        F.col("lo").alias("lowest_partition"),
        F.col("hi").alias("highest_partition"),
    )


def key_consistency(log: DataFrame) -> DataFrame:
    ends = log.groupBy("key").agg(F.min("partition").alias("lo"), F.max("partition").alias("hi"))
    return ends.agg(
        F.count("*").alias("key_count"),
        F.coalesce(F.sum((F.col("lo") != F.col("hi")).cast("bigint")), F.lit(0)).alias("split_keys"),
    )


def consumer_lag(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Log end minus committed offset per partition; nothing committed means all of it."""
    ends = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("log_end")
    )
    joined = ends.join(committed, ["topic", "partition"], "left")
    position = F.coalesce(F.col("committed"), F.col("first_offset"))
    return joined.select(
        "topic",
        "partition",
        "log_end",
        position.alias("committed"),
        (F.col("log_end") - position).alias("lag"),
    )


def retained(log: DataFrame, asof: str, days: int = 7) -> DataFrame:
    """Messages within the retention time."""
    edge = F.lit(asof).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    return log.where(F.col("timestamp") >= edge)


def throughput(log: DataFrame, target_rate: float = 10.0) -> DataFrame:
    """Messages per second of log time against a target rate."""
    span = micros_between(F.min("timestamp"), F.max("timestamp")) / F.lit(1e6)
    totals = log.agg(F.count("*").alias("messages"), span.alias("elapsed_seconds"))
    rate = F.col("messages") / F.nullif(F.col("elapsed_seconds"), F.lit(0.0))
    return totals.withColumn("actual_rate", F.round(rate, 6)).withColumn(
        "target_share", F.round(rate * 100 / F.lit(target_rate), 6)
    )


def success_rate(counts: DataFrame) -> DataFrame:
    """Share of good messages, null for an empty log.

    ``reported_rate`` is the older figure: errors are taken off the produced
    messages although these do not include them.
    """
    n = F.col("messages")
    bad = F.coalesce(F.sum(F.when(F.col("outcome") == "failed", n)), F.lit(0))
    good = F.coalesce(F.sum(F.when(F.col("outcome") != "failed", n)), F.lit(0))
    totals = counts.agg(good.alias("succeeded"), bad.alias("failed"))
    ok, ko = F.col("succeeded").cast("double"), F.col("failed").cast("double")
    return totals.select(
        "succeeded",
        "failed",
        F.round(ok * 100 / F.nullif(ok + ko, F.lit(0.0)), 4).alias("success_rate"),
        F.round((ok - ko) * 100 / F.nullif(ok, F.lit(0.0)), 4).alias("reported_rate"),
    )


def sequence_breaks(
    log: DataFrame, time: str = "created_at", value: str = "offset", bucket: str = "hour"
) -> DataFrame:
    """Orders stored after a later one: per customer and partition, offsets that
    fall while the creation time rises.

    A customer may hold a large share of the log, so the comparison with the
    previous order is made within time buckets; only the two ends of each
    bucket are then compared across buckets.
    """
    key = ["customer_id", "partition"]
    order = [time, "order_id"]
    slot = F.date_trunc(bucket, time).alias("slot")
    rows = log.select(*key, *order, F.col(value).alias("at"), slot)
    here = F.struct("order_id", "at")

    within = Window.partitionBy(*key, "slot").orderBy(*order)
    rows = rows.withColumn("before", F.lag(here).over(within)).withColumn(
        "edge", F.col("before").isNull() | F.lead("at").over(within).isNull()
    )
    across = Window.partitionBy(*key, F.when(~F.col("edge"), F.col("slot"))).orderBy(*order)
    previous = F.coalesce("before", F.lag(here).over(across))
    return (
        rows.withColumn("previous", previous)
        .where("previous.at > at")
        .select(
            *key,
            "order_id",
            F.col("at").alias(value),
            F.col("previous.order_id").alias("previous_order_id"),
            F.col("previous.at").alias(f"previous_{value}"),
        )
    )
