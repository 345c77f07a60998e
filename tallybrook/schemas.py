"""Schemas of the log envelope, the message and the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The schema of Spark's kafka source; every job takes rows of this shape.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

MONEY = T.DecimalType(10, 2)

ITEM = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", MONEY),
        T.StructField("subtotal", MONEY),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("total_amount", MONEY),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

# The stored table also keeps the list of items as it was sent, as JSON text: the typed items have no place for further
# keys, more decimals or elements that are no objects. And it has partition columns: the month inside the order id, so that
# an id always lands in the same place however late a copy of it arrives, and
# the batch that wrote the row, so that a replayed batch replaces its own files.
ORDERS_STORED = T.StructType(
    [
        *ORDERS.fields,
        T.StructField("items_json", T.StringType()),
        T.StructField("order_month", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Month of ids that do not have the usual form.
OTHER_MONTH = "other"

# Column limits of the stored table.
MAX_LENGTH = {
    "order_id": 50,
    "customer_id": 50,
    "customer_name": 100,
    "customer_email": 100,
    "status": 20,
}

# Keys a message must carry, in reporting order.
REQUIRED_FIELDS = [
    "order_id",
    "customer_id",
    "customer_name",
    "customer_email",
    "items",
    "total_amount",
    "status",
    "created_at",
]
