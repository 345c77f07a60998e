"""Generated customers, menu and orders."""

import json
import re
import tempfile
import zlib
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.functions.ids import CUSTOMER_ID_PATTERN, ORDER_ID_PATTERN
from tallybrook.operators.outcomes import reason_counts
from tallybrook.plans.checks import quality_report
from tallybrook.sinks import topic
from tallybrook.sources import generator
from tallybrook.streaming import produce

START = "2025-01-10 00:00:00"


def made(spark, count=500, **how):
    return generator.orders(generator.numbered(spark, count, START), **how)


def test_same_seed_same_orders_whatever_the_layout(spark):
    one = made(spark).collect()
    spread = generator.orders(generator.numbered(spark, 500, START).repartition(7)).collect()
    assert sorted(one) == sorted(spread)
    other = made(spark, seed=100).collect()
    assert sum(a == b for a, b in zip(sorted(one), sorted(other))) < 5


def test_order_form(spark):
    rows = made(spark).collect()
    assert len({r.order_id for r in rows}) == 500
    for r in rows:
        assert re.match(ORDER_ID_PATTERN, r.order_id) and re.match(CUSTOMER_ID_PATTERN, r.customer_id)
        assert r.status == "pending" and r.created_at.endswith("Z")
        assert "@" in r.customer_email and len(r.customer_name.split()) == 2
        assert 1 <= len(r["items"]) <= 5
        assert len({i.item_id for i in r["items"]}) == len(r["items"])
        assert all(1 <= i.quantity <= 3 and i.subtotal == i.price * i.quantity for i in r["items"])
        assert r.total_amount == sum(i.subtotal for i in r["items"])


def test_quality_rules_hold(spark):
    assert {r.violations for r in quality_report(made(spark)).collect()} == {0}


def test_draws_reach_everything(spark):
    rows = made(spark, 3000).collect()
    assert len({r.customer_id for r in rows}) == 100
    assert {len(r["items"]) for r in rows} == {1, 2, 3, 4, 5}
    assert len({i.item_id for r in rows for i in r["items"]}) == 20
    assert {i.quantity for r in rows for i in r["items"]} == {1, 2, 3}


def test_customer_pool(spark):
    rows = generator.customer_pool(spark, 100).collect()
    assert rows[0].customer_id == "CUST-00001" and len({r.customer_id for r in rows}) == 100
    for n, r in enumerate(sorted(rows), 1):
        assert r.email == f"{r.name.lower().replace(' ', '.')}.{n}@example.com"


def test_menu(spark):
    rows = generator.menu(spark).collect()
    assert (rows[0].item_id, rows[0].name, rows[0].price) == ("ITEM-001", "Classic Burger", Decimal("8.99"))
    assert {r.category for r in rows} == {"Burgers", "Sides", "Salads", "Beverages", "Desserts", "Chicken"}
    assert len(rows) == 20 and generator.menu(spark, 3).count() == 3


@pytest.mark.parametrize("customers, items", [(1, 1), (1000, 100), (5, 2)])
def test_pool_sizes(spark, customers, items):
    rows = made(spark, 60, customer_count=customers, menu_size=items).collect()
    assert all(int(r.customer_id[5:]) <= customers for r in rows)
    assert all(1 <= len(r["items"]) <= min(5, items) for r in rows)
    assert len({i.name for i in generator.menu(spark, items).collect()}) == items


def test_ids_grow_beyond_five_digits(spark):
    numbers = spark.range(123456, 123457).withColumn("created_at", F.lit(START).cast("timestamp_ntz"))
    assert generator.orders(numbers).first().order_id == "ORD-20250110-123456"


def test_generated_log_is_all_good(spark):
    counts = reason_counts(produce.as_log(spark, 400, START)).collect()
    assert [(r.outcome, r.messages) for r in counts] == [("processed", 400)]


def test_bounded_run(spark):
    assert produce.run_batch(spark, rate=10, seconds=7, start=START).count() == 70
    times = sorted(datetime.fromisoformat(r.created_at) for r in made(spark, 21).collect())
    assert (times[-1] - times[0]).total_seconds() == 2


def test_rate_bounds(spark):
    for rate in (0, -1):
        with pytest.raises(ValueError):
            generator.rate_numbers(spark, rate)
    for rate in (1000, 250_000):
        assert produce.order_stream(spark, rate).isStreaming


def test_message_key_and_partition(spark):
    rows = topic.messages(made(spark, 200)).collect()
    for r in rows:
        value = json.loads(r.value)
        assert value["customer_id"].encode() == bytes(r.key)
        assert r.partition == zlib.crc32(bytes(r.key)) % 3
    assert {r.partition for r in rows} == {0, 1, 2}


def test_rate_stream_to_files(spark):
    folder = tempfile.mkdtemp(prefix="tallybrook-test-")
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 50).load()
    numbers = ticks.select((F.col("value") + 1).alias("id"), F.col("timestamp").cast("timestamp_ntz").alias("created_at"))
    sent = topic.messages(generator.orders(numbers))
    query = produce.start_files(sent, f"{folder}/sent", f"{folder}/c", every="0 seconds")
    try:
        query.awaitTermination(6)
    finally:
        query.stop()
    assert spark.read.parquet(f"{folder}/sent").count() >= 50
