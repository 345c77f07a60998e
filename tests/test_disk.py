"""What a job leaves on the disk, and which rows it sends over it."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF, envelopes, order
from tallybrook.functions.ids import order_month
from tallybrook.operators import load as load_module
from tallybrook.operators.dedup import only_rows
from tallybrook.operators.load import load_batch, update_stored
from tallybrook.session import shared_dir
from tallybrook.sinks import tables
from tallybrook.sources import log
from tallybrook.sources.warehouse import stored_orders
from tallybrook.streaming import customers

DONE = "2025-01-10 15:00:00"


@pytest.fixture
def target(tmp_path):
    return tables.Target(str(tmp_path / "t"))


def shuffle_files(spark):
    spark._jvm.System.gc()
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folder for f in glob.glob(f"{d}/*/shuffle_*")}


def plan_of(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_load_leaves_no_staged_tables_and_no_shuffle_files(spark, target):
    staged, files = set(glob.glob(f"{shared_dir(spark)}/stages/*/*")), shuffle_files(spark)
    load_batch(envelopes(spark, [order(1), order(2), order(1), "{ bad }"]).repartition(3), target, 0, DONE)
    assert set(glob.glob(f"{shared_dir(spark)}/stages/*/*")) <= staged
    wide = {f for f in shuffle_files(spark) - files if f.endswith(".data")}
    deadline = time.monotonic() + 20
    while sum(map(lambda f: bool(glob.glob(f)), wide)) > 4 and time.monotonic() < deadline:
        time.sleep(0.2)
    assert sum(map(lambda f: bool(glob.glob(f)), wide)) <= 4  # those of the look at the months, one row each
    assert tables.read_orders(spark, target).count() == 2


def test_whole_orders_are_not_ranked(spark, target, monkeypatch):
    plans, write = [], load_module.write_orders
    monkeypatch.setattr(load_module, "write_orders", lambda rows, *a, **k: plans.append(plan_of(rows)) or write(rows, *a, **k))
    load_batch(envelopes(spark, [order(1), order(1), order(2)]), target, 0, DONE)
    load_batch(envelopes(spark, [order(2), order(3)], first_offset=9), target, 1, DONE)
    load_batch(envelopes(spark, [order(3), order(2)], first_offset=20), target, 2, DONE)  # nothing new, nothing written
    assert len(plans) == 2 and not any("row_number" in p or "Window" in p for p in plans)
    rows = tables.read_orders(spark, target).select("order_id", "batch_id").collect()
    assert sorted((r.order_id[-1], r.batch_id) for r in rows) == [("1", 0), ("2", 0), ("3", 1)]
    counted = {(r.batch_id, r.outcome): r.messages for r in tables.read_counters(spark, target).collect()}
    assert counted == {(0, "processed"): 2, (0, "skipped"): 1, (1, "processed"): 1, (1, "skipped"): 1, (2, "skipped"): 2}


def test_messages_at_one_place_are_still_told_apart(spark, target):
    twice = envelopes(spark, [order(1)]).unionAll(envelopes(spark, [order(1)]))
    load_batch(twice, target, 0, DONE)
    assert tables.read_orders(spark, target).count() == 1


@pytest.mark.parametrize("wanted", [[], [3], [0, 1, 2, 3]])
def test_only_wanted_rows_are_left(spark, wanted):
    rows = spark.range(4).withColumnRenamed("id", "_row")
    asked = spark.createDataFrame([(n,) for n in wanted], "_row bigint")
    with tables.scratch(spark, "only") as stage:
        assert sorted(r[0] for r in only_rows(stage(rows), 4, stage(asked), stage).collect()) == wanted


def test_an_update_does_not_move_texts_it_can_make_again(spark, target, monkeypatch):
    typed = stored_orders(spark, SF).limit(2).withColumn("order_month", order_month(F.col("order_id"))).withColumn("batch_id", F.lit(0).cast("bigint"))
    tables.switch_parts(spark, target, lambda p: False, tables.write_orders(typed, target))
    further = [{**order()["items"][0], "note": "by hand"}]
    load_batch(envelopes(spark, [order(1), order(2, items=further)]), target, 1, DONE)
    before = {r.order_id: r.items_json for r in tables.read_orders(spark, target).collect()}
    moved, write = [], load_module.write_orders
    monkeypatch.setattr(load_module, "write_orders", lambda rows, *a, **k: moved.extend(rows.select("batch_id", "items_json").collect()) or write(rows, *a, **k))
    update_stored(spark, target, spark.createDataFrame([(i, "done", 1) for i in before], "order_id string, status string, updated_at int"))
    assert sorted((r.batch_id, r.items_json is None) for r in moved) == [(0, True), (0, True), (1, False), (1, False)]
    after = tables.read_orders(spark, target).collect()
    assert {r.order_id: r.items_json for r in after} == before and {r.status for r in after} == {"done"}


def test_waiting_orders_are_judged_and_joined_once(spark, tmp_path, monkeypatch):
    plans, write = [], customers.overwrite_partitions
    monkeypatch.setattr(customers, "overwrite_partitions", lambda rows, *a: plans.append(plan_of(rows)) or write(rows, *a))
    spark.createDataFrame([("CUST-00001",)], "customer_id string").write.parquet(f"{tmp_path}/customers/a")
    orders = customers.WaitingOrders(spark, f"{tmp_path}/orders", f"{tmp_path}/customers")
    orders.store(envelopes(spark, [order(1), order(1), order(2)]), 0)
    assert not any(word in plans[0] for word in ("parse_json", "parseJson", "Join", "Window"))
    assert [r.customer_id for r in orders.kept().collect()] == ["CUST-00001"]
    assert [r.customer_id for r in orders.waiting().collect()] == ["CUST-00002"]


def test_a_folder_arrives_or_an_empty_one(spark, tmp_path):
    envelopes(spark, [order(1)]).write.parquet(f"{tmp_path}/made/half=first")
    for half, rows in (("first", 1), ("second", 0)):
        log.arrive(spark, f"{tmp_path}/made/half={half}", f"{tmp_path}/log/{half}")
        assert log.files(spark, f"{tmp_path}/log/{half}").count() == rows
