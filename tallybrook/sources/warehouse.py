"""Order messages and stored orders derived from star-schema tables.

Every row of ``orders`` becomes one message (some are sent more than once, some
are damaged on purpose); its lines become the items.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import ids
from tallybrook.functions.draws import draw
from tallybrook.schemas import ENVELOPE, ITEM, MONEY, ORDERS

TOPIC = "order-messages"
PARTITIONS = 3

# Damage done to messages: an order draws one of FAULT_DRAWS numbers, and the
# number picks the label at that place; numbers beyond the list mean none.
FAULT_DRAWS = 200
FAULTS = [
    "tombstone",
    "bad_utf8",
    "truncated",
    "trailing_text",
    "in_array",
    "no_customer",
    "no_email_no_status",
    "empty_items",
    "object_items",
    "negative_amount",
    "text_amount",
    "true_amount",
    "false_amount",
    "time_only",
    "null_time",
    "long_name",
    "huge_amount",
    "null_status",
    "tiny_amount",
    "sent_twice",
    "sent_three_times",
    "truncated_then_whole",
    "repeated_key",
    "offset_time",
    "basic_time",
    "further_key",
]
COPIES = {"sent_twice": 2, "sent_three_times": 3, "truncated_then_whole": 2}

# Order status by its one-letter code.
STATUS = {"O": "pending", "P": "processing", "F": "completed"}


# Stated, so that no job has to read file footers first.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def fault_label(order_key: Column) -> Column:
    labels = F.array(*[F.lit(name) for name in FAULTS])
    number = draw(FAULT_DRAWS, "fault", order_key).cast("int")
    return F.coalesce(F.get(labels, number), F.lit("none"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, shaped like an item of a message."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity")
    )
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_retailprice").cast(MONEY).alias("price")
    )
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        ids.item_id(F.col("l_partkey")).alias("item_id"),
        "name",
        "quantity",
        "price",
        (F.col("price") * F.col("quantity")).cast(MONEY).alias("subtotal"),
    )


def item_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of all orders as a table of their own."""
    heads = table(spark, sf_dir, "orders").select(
        "o_orderkey", ids.order_id(F.col("o_orderdate"), F.col("o_orderkey")).alias("order_id")
    )
    lines = order_lines(spark, sf_dir)
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select("order_id", *ITEM.names)


def _items(lines: DataFrame) -> DataFrame:
    """Items and total per order, in line order.

    The list is as long as the message that carries it; (line, part, quantity)
    settles the order, and lines equal in all three are the same item.
    """
    # a line travels as a plain row and says nothing twice: lists of lines half made, and texts made of keys, take more of the disk
    row = F.struct("l_linenumber", "l_partkey", "quantity", "name", "price", "subtotal")
    rows = lines.drop("item_id").repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(row)).alias("lines"),
        F.sum("subtotal").cast(MONEY).alias("total_amount"),
    )

    def item(r: Column) -> Column:
        made = {"item_id": ids.item_id(r["l_partkey"])}
        return F.struct(*[made.get(name, r[name]).alias(name) for name in ITEM.names])

    return rows.select("l_orderkey", F.transform("lines", item).alias("items"), "total_amount")


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir)
    return lines.groupBy("l_orderkey").agg(F.sum("subtotal").cast(MONEY).alias("total_amount"))


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select("o_orderkey", "o_custkey", "c_name", "o_orderstatus", "o_orderdate")


def _described(rows: DataFrame) -> DataFrame:
    """What orders and customers say, as fields of a message: texts made of keys are made where no shuffle follows."""
    made = [
        ids.order_id(F.col("o_orderdate"), F.col("o_orderkey")).alias("order_id"),
        ids.customer_id(F.col("o_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        ids.email(F.col("c_name"), F.col("o_custkey")).alias("customer_email"),
        F.col("o_orderstatus").alias("status_code"),
        F.col("o_orderdate").alias("created_at"),
    ]
    return rows.select("*", *made)


def _status(code: Column) -> Column:
    pairs = [x for code_text, name in STATUS.items() for x in (F.lit(code_text), F.lit(name))]
    return F.create_map(*pairs)[code]


def stored_orders(spark: SparkSession, sf_dir: str, with_items: bool = True) -> DataFrame:
    """The stored table: orders that have at least one line, as typed rows."""
    lines = order_lines(spark, sf_dir)
    detail = _items(lines) if with_items else order_totals(spark, sf_dir)
    head = _headers(spark, sf_dir)
    wait = F.make_dt_interval(secs=F.col("o_orderkey") % 97)
    rows = _described(head.join(detail, head.o_orderkey == detail.l_orderkey))
    return rows.withColumn("status", _status(F.col("status_code"))).withColumn(
        "processed_at", F.col("created_at") + wait
    ).select(*[c for c in ORDERS.names if with_items or c != "items"])


def log_partition(key: Column, partitions: int = PARTITIONS) -> Column:
    """Partition of a key: the CRC-32 of its bytes, as log clients do it."""
    return F.pmod(F.crc32(key.cast("binary")), F.lit(partitions)).cast("int")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log: one envelope row per message sent."""
    head = _headers(spark, sf_dir)
    detail = _items(order_lines(spark, sf_dir))
    fault = F.col("fault")

    def unless(name: str, usual, instead) -> Column:
        return F.when(fault.isin(name), instead).otherwise(usual)

    copies = F.coalesce(*[F.when(fault == name, n) for name, n in COPIES.items()], F.lit(1))
    rows = (
        _described(head.join(detail, head.o_orderkey == detail.l_orderkey, "left"))
        .withColumn("fault", fault_label(F.col("o_orderkey")))
        .withColumn("copy", F.explode_outer(F.slice(F.array(*map(F.lit, range(3))), 1, copies)))
    )

    # a null field is left out of the JSON text
    no_email = unless("no_email_no_status", F.col("customer_email"), F.lit(None))
    opening = F.to_json(
        F.struct(
            "order_id",
            unless("no_customer", F.col("customer_id"), F.lit(None)).alias("customer_id"),
            unless("long_name", F.col("customer_name"), F.repeat(F.lit("x"), 101)).alias("customer_name"),
            no_email.alias("customer_email"),
        )
    )
    items = F.coalesce(F.to_json("items"), F.lit("[]"))
    items = F.when(fault == "empty_items", "[]").when(fault == "object_items", '{"a":1}').otherwise(items)
    noted = F.regexp_replace(items, r"^\[\{", '[{"note":"by hand",')
    items = F.when(fault == "further_key", noted).otherwise(items)
    amount = F.coalesce(F.col("total_amount"), F.lit(0).cast(MONEY)).cast("string")
    amount = (
        F.when(fault == "negative_amount", F.concat(F.lit("-"), amount))
        .when(fault == "text_amount", F.concat(F.lit('"'), amount, F.lit('"')))
        .when(fault == "true_amount", "true")
        .when(fault == "false_amount", "false")
        .when(fault == "huge_amount", "1000000000")
        .when(fault == "tiny_amount", "0.004")
        .otherwise(amount)
    )
    status = (
        F.when(fault == "null_status", ',"status":null')
        .when(fault == "no_email_no_status", "")
        .when(fault == "repeated_key", ',"status":"draft","status":"pending"')
        .otherwise(',"status":"pending"')
    )
    created = F.col("created_at")
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    ahead = F.date_format(created + F.make_dt_interval(hours=F.lit(2)), "yyyy-MM-dd'T'HH:mm:ss")
    time = (
        F.when(fault == "time_only", '"14:30:00"')
        .when(fault == "null_time", "null")
        .when(fault == "offset_time", quoted(F.concat(ahead, F.lit("+02:00"))))
        .when(fault == "basic_time", quoted(F.date_format(created, "yyyyMMdd'T'HHmmss'Z'")))
        .otherwise(quoted(F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    )
    body = F.concat(
        F.expr("substring({0}, 1, length({0}) - 1)".format("opening")),
        F.lit(',"items":'), "items_text",
        F.lit(',"total_amount":'), "amount_text",
        "status_text",
        F.lit(',"created_at":'), "time_text",
        F.lit("}"),
    )
    cut = F.expr("substring(body, 1, length(body) - 20)")
    damaged = (fault == "truncated") | ((fault == "truncated_then_whole") & (F.col("copy") == 0))
    value = (
        F.when(fault == "tombstone", F.lit(None).cast("binary"))
        .when(fault == "bad_utf8", F.concat(F.unhex(F.lit("ff")), F.col("body").cast("binary")))
        .when(damaged, cut.cast("binary"))
        .when(fault == "trailing_text", F.concat("body", F.lit(" {}")).cast("binary"))
        .when(fault == "in_array", F.concat(F.lit("["), "body", F.lit("]")).cast("binary"))
        .otherwise(F.col("body").cast("binary"))
    )
    sent = created + F.make_dt_interval(secs=F.col("copy"))
    messages = (
        rows.withColumn("opening", opening)
        .withColumn("items_text", items)
        .withColumn("amount_text", amount)
        .withColumn("status_text", status)
        .withColumn("time_text", time)
        .withColumn("body", body)
        .select(
            F.col("customer_id").cast("binary").alias("key"),
            value.alias("value"),
            F.lit(TOPIC).alias("topic"),
            log_partition(F.col("customer_id")).alias("partition"),
            (F.col("o_orderkey") * 4 + F.col("copy")).alias("offset"),
            sent.cast("timestamp").alias("timestamp"),
        )
        .select(*ENVELOPE.names)
    )
    # An observation ends the fused code. With the decoding and judging of a reader in it, its longest method has some 12,700 bytes,
    # and the JVM compiles none beyond 8000.
    return messages.observe(f"messages-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
