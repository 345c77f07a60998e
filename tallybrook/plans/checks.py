"""Data-quality, referential and reconciliation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.ids import CUSTOMER_ID_PATTERN, ORDER_ID_PATTERN

# Bounds of a well-formed order.
PRICE = (0.99, 50.0)
QUANTITY = (1, 5)
MAX_ITEMS = 5


def quality_rules() -> dict[str, Column]:
    """Rules an order should meet, by name."""
    exact = lambda i: i["subtotal"] == F.round(i["price"] * i["quantity"], 2)
    total = F.aggregate(
        "items",
        F.lit(0).cast("decimal(20,2)"),
        lambda acc, i: (acc + i["subtotal"]).cast("decimal(20,2)"),
    )
    return {
        "subtotal_is_price_times_quantity": F.forall("items", exact),
        "total_is_sum_of_subtotals": F.col("total_amount") == total,
        "price_in_range": F.forall("items", lambda i: i["price"].between(*PRICE)),
        "quantity_positive": F.forall("items", lambda i: i["quantity"] > 0),
        "quantity_in_range": F.forall("items", lambda i: i["quantity"].between(*QUANTITY)),
        "item_count_in_range": F.size("items").between(1, MAX_ITEMS),
        "order_id_format": F.col("order_id").rlike(ORDER_ID_PATTERN),
        "customer_id_format": F.col("customer_id").rlike(CUSTOMER_ID_PATTERN),
        "email_format": F.col("customer_email").rlike(r"^[^@]+@[^@]+\.[^@]+$"),
        "name_has_two_words": F.size(F.split(F.trim("customer_name"), r"\s+")) >= 2,
    }


def quality_report(orders: DataFrame) -> DataFrame:
    """Violations per rule, all rules in one pass."""
    rules = quality_rules()
    broken = [
        F.sum(F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1)).alias(name)
        for name, rule in rules.items()
    ]
    totals = orders.agg(F.count("*").alias("orders"), *broken)
    return totals.unpivot("orders", list(rules), "rule", "violations").select(
        "rule", "orders", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    )


def without_customer(messages: DataFrame, customers: DataFrame) -> DataFrame:
    """Messages whose customer is not known."""
    return messages.join(customers.select("customer_id"), "customer_id", "left_anti")


def reconcile(produced: DataFrame, stored: DataFrame, fields: list[str]) -> DataFrame:
    """Produced against stored orders, one row per order id with the fields
    that differ (null-safe). Both sides carry each id once."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("order_id", F.struct(*fields).alias(name))

    both = side(produced, "p").join(side(stored, "s"), "order_id", "full")
    differs = [F.when(~F.col(f"p.{f}").eqNullSafe(F.col(f"s.{f}")), F.lit(f)) for f in fields]
    state = (
        F.when(F.col("s").isNull(), "missing")
        .when(F.col("p").isNull(), "extra")
        .when(F.col("different") != "", "mismatch")
        .otherwise("match")
    )
    return both.select(
        "order_id",
        "p",
        "s",
        F.when(F.col("p").isNotNull() & F.col("s").isNotNull(), F.concat_ws(",", *differs))
        .otherwise("")
        .alias("different"),
    ).select("order_id", state.alias("state"), "different")


def reconcile_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("state", "different").agg(F.count("*").alias("orders"))
