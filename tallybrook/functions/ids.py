"""Order, customer and item identifiers, display and export text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook.functions.times import iso_seconds
from tallybrook.schemas import OTHER_MONTH

# Identifier formats (ORD-yyyymmdd-00001, CUST-00001, ITEM-001).
ORDER_PREFIX, ORDER_DIGITS = "ORD-", 5
CUSTOMER_PREFIX, CUSTOMER_DIGITS = "CUST-", 5
ITEM_PREFIX, ITEM_DIGITS = "ITEM-", 3
ORDER_ID_PATTERN = r"^ORD-(\d{8})-(\d{5,})$"
CUSTOMER_ID_PATTERN = r"^CUST-\d{5,}$"
EMAIL_DOMAIN = "example.com"


def padded(n: Column, digits: int) -> Column:
    """Zeros in front up to ``digits``; longer numbers stay whole."""
    text = n.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def order_id(created_at: Column, sequence: Column) -> Column:
    day = F.date_format(created_at, "yyyyMMdd")
    return F.concat(F.lit(ORDER_PREFIX), day, F.lit("-"), padded(sequence, ORDER_DIGITS))


def customer_id(n: Column) -> Column:
    return F.concat(F.lit(CUSTOMER_PREFIX), padded(n, CUSTOMER_DIGITS))


def item_id(n: Column) -> Column:
    return F.concat(F.lit(ITEM_PREFIX), padded(n, ITEM_DIGITS))


def email(name: Column, n: Column) -> Column:
    local = F.lower(F.replace(name, F.lit(" "), F.lit(".")))
    return F.concat(local, F.lit("."), n.cast("string"), F.lit(f"@{EMAIL_DOMAIN}"))


def order_month(order: Column) -> Column:
    """The year and month inside an order id, or the catch-all month."""
    return F.when(order.rlike(ORDER_ID_PATTERN), F.substring(order, 5, 6)).otherwise(OTHER_MONTH)


def order_id_parts(order: Column) -> list[Column]:
    """Prefix, day and sequence number of an order id; null where malformed."""
    known = order.rlike(ORDER_ID_PATTERN)
    day = F.regexp_extract(order, ORDER_ID_PATTERN, 1)
    seq = F.regexp_extract(order, ORDER_ID_PATTERN, 2)
    iso_day = F.regexp_replace(day, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return [
        F.when(known, F.split_part(order, F.lit("-"), F.lit(1))).alias("prefix"),
        F.when(known, iso_day.try_cast("date")).alias("order_date"),
        F.when(known, seq.try_cast("bigint")).alias("sequence"),
    ]


def display_text() -> Column:
    return F.concat(
        F.lit("Order "), F.col("order_id"),
        F.lit(" - "), F.col("customer_id"),
        F.lit(" - $"), F.col("total_amount").cast("string"),
    )


def debug_text() -> Column:
    shown = ["order_id", "customer_id", "total_amount", "status"]
    pairs = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in shown]
    return F.concat(F.lit("<Order("), F.concat_ws(", ", *pairs), F.lit(")>"))


def export_struct(with_items: bool = True) -> Column:
    """The row as it is exported: amount as a float, times as ISO text."""
    fields = ["order_id", "customer_id", "customer_name", "customer_email"]
    return F.struct(
        *fields,
        *([F.col("items")] if with_items else []),
        F.col("total_amount").cast("double").alias("total_amount"),
        "status",
        iso_seconds(F.col("created_at")).alias("created_at"),
        iso_seconds(F.col("processed_at")).alias("processed_at"),
    )


def export_json(with_items: bool = True) -> Column:
    return F.to_json(export_struct(with_items), {"ignoreNullFields": "false"})
