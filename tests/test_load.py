"""The loader as a batch and as a stream."""

import json
import tempfile
import time
from datetime import datetime

import pytest
from conftest import envelopes, order
from pyspark.sql import functions as F

from tallybrook.operators.load import compact_month, load_batch, month_ranges, near, update_stored
from tallybrook.sinks import jdbc, tables
from tallybrook.sinks.tables import Target, apply_updates, evolve, roll_back, with_retry
from tallybrook.sources import log
from tallybrook.streaming import load as stream

DONE = "2025-01-10 15:00:00"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tallybrook-test-")


@pytest.fixture
def target(folder):
    return Target(f"{folder}/tables")


def ids(spark, target):
    return sorted(r.order_id for r in tables.read_orders(spark, target).collect())


def month_files(spark, target, month):
    return {f for f in tables.read_orders(spark, target).inputFiles() if f"order_month={month}" in f}


def counted(spark, target):
    rows = tables.read_counters(spark, target).collect()
    return {(r.batch_id, r.reason or r.outcome): r.messages for r in rows}


def test_batch_stores_quarantines_and_counts(spark, log_of, target):
    load_batch(log_of([order(1), order(2), order(1), "{ bad }", order(3, status=None)]), target, 0, DONE)
    rows = tables.read_orders(spark, target).orderBy("order_id").collect()
    assert [r.order_id[-1] for r in rows] == ["1", "2"]
    assert rows[0].processed_at == datetime(2025, 1, 10, 15)
    assert rows[0].order_month == "202501"
    assert counted(spark, target) == {
        (0, "processed"): 2, (0, "duplicate"): 1, (0, "undecodable"): 1, (0, "null_violation"): 1,
    }
    bad = tables.read_quarantine(spark, target).orderBy("offset").collect()
    assert [(r.offset, r.reason) for r in bad] == [(3, "undecodable"), (4, "null_violation")]


def test_items_are_stored_as_sent(spark, log_of, target):
    kept = [
        [1, "two", None, [3]],
        [{"item_id": "A", "quantity": 2.7, "price": 1.239, "note": "no onions", "parts": [{"n": 1}]}],
        [{"quantity": "two", "price": 1e10}, {"quantity": 3000000000}, {}],
        [{"name": "\u00e9\u4e2d \"quoted\" \\ \n"}],
    ]
    load_batch(log_of([order(n, items=items) for n, items in enumerate(kept)]), target, 0, DONE)
    update_stored(spark, target, spark.createDataFrame([(order(1)["order_id"], "done", datetime(2025, 2, 1))], "order_id string, status string, updated_at timestamp_ntz"))
    rows = tables.read_orders(spark, target).orderBy("order_id").collect()
    assert [json.loads(r.items_json) for r in rows] == kept
    assert rows[1].status == "done"
    sent = jdbc.flat(tables.read_orders(spark, target)).orderBy("order_id").collect()
    assert [json.loads(r["items"]) for r in sent] == kept


def test_replaying_a_batch_changes_nothing(spark, log_of, target):
    first = log_of([order(1), order(2), order(2), "{ bad }"])
    load_batch(first, target, 0, DONE)
    load_batch(log_of([order(2), order(3)], first_offset=10), target, 1, DONE)
    before = ids(spark, target), counted(spark, target)
    load_batch(log_of([order(2), order(3)], first_offset=10), target, 1, DONE)
    assert (ids(spark, target), counted(spark, target)) == before
    assert before[1][(1, "duplicate")] == 1 and before[1][(1, "processed")] == 1


def test_interrupted_batch_is_completed(spark, log_of, target, monkeypatch):
    batch = log_of([order(1), order(1), "{ bad }"])
    import tallybrook.operators.load as module

    real = module.counters
    monkeypatch.setattr(module, "counters", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load_batch(batch, target, 0, DONE)
    monkeypatch.setattr(module, "counters", real)
    load_batch(batch, target, 0, DONE)
    assert counted(spark, target) == {(0, "processed"): 1, (0, "duplicate"): 1, (0, "undecodable"): 1}
    assert tables.read_quarantine(spark, target).count() == 1


def test_a_late_copy_is_found_and_odd_ids_too(spark, log_of, target):
    load_batch(log_of([order(1), order(2, order_id="odd"), order(3, order_id="ORD-20240229-00003")]), target, 0, DONE)
    late = [order(1, created_at="2026-03-01T00:00:00Z"), order(2, order_id="odd"), order(3, order_id="ORD-20240229-00003")]
    load_batch(log_of(late, first_offset=100), target, 1, DONE)
    assert len(ids(spark, target)) == 3
    assert counted(spark, target)[(1, "duplicate")] == 3


def test_only_the_months_of_a_batch_are_read(spark, log_of, target):
    load_batch(log_of([order(1), order(2, order_id="ORD-20240229-00003")]), target, 0, DONE)
    batch = spark.createDataFrame([("ORD-20250110-00009",), ("ORD-20250111-00001",)], "order_id string")
    plan = near(tables.read_orders(spark, target), batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan or "order_month#" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(order_id,ORD-20250110-00009)" in plan
    assert near(tables.read_orders(spark, target), batch.limit(0)).count() == 0


def test_batch_does_not_depend_on_the_layout(spark, log_of, folder):
    messages = [order(n % 40) for n in range(200)] + ["{ bad }"] * 5
    seen = []
    for parts in (1, 3, 8):
        target = Target(f"{folder}/{parts}")
        load_batch(log_of(messages).repartition(parts), target, 0, DONE)
        seen.append((ids(spark, target), counted(spark, target)))
    assert seen[0] == seen[1] == seen[2]


def write_log(spark, path, messages, first_offset=0):
    envelopes(spark, messages, first_offset).coalesce(1).write.mode("append").parquet(path)


def test_stream_resumes_after_a_restart(spark, folder, target):
    """Five messages, then five more with copies of the old ones: ten rows."""
    path, checkpoint = f"{folder}/log", f"{folder}/checkpoint"
    write_log(spark, path, [order(n) for n in range(5)])
    stream.run_load(log.file_stream(spark, path, 1), target, checkpoint, processed_at=DONE)
    assert len(ids(spark, target)) == 5
    write_log(spark, path, [order(n) for n in range(3, 10)] + ["{ bad }"], first_offset=50)
    stream.run_load(log.file_stream(spark, path, 1), target, checkpoint, processed_at=DONE)
    assert len(ids(spark, target)) == 10
    query = stream.run_load(log.file_stream(spark, path, 1), target, checkpoint, processed_at=DONE)
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    assert sum(n for (_, what), n in counted(spark, target).items() if what == "duplicate") == 2


def test_stream_equals_batch(spark, folder):
    messages = [order(n % 30, total_amount=-1 if n % 7 == 0 else 5.5) for n in range(90)]
    path = f"{folder}/log"
    for i in range(0, 90, 30):
        write_log(spark, path, messages[i : i + 30], first_offset=i)
    streamed, loaded = Target(f"{folder}/s"), Target(f"{folder}/b")
    stream.run_load(log.file_stream(spark, path, 1), streamed, f"{folder}/c", processed_at=DONE)
    load_batch(log.files(spark, path), loaded, 0, DONE)
    assert ids(spark, streamed) == ids(spark, loaded)


def test_stream_progress_is_kept(spark, folder, target):
    progress = stream.Progress(keep=2)
    spark.streams.addListener(progress)
    try:
        path = f"{folder}/log"
        for i in range(3):
            write_log(spark, path, [order(i)], first_offset=i)
        stream.run_load(log.file_stream(spark, path, 1), target, f"{folder}/c")
    finally:
        spark.streams.removeListener(progress)
    deadline = time.monotonic() + 20
    while sum(t["rows"] for t in progress.totals.values()) < 3 and time.monotonic() < deadline:
        time.sleep(0.1)
    (figures,) = progress.totals.values()
    assert figures["rows"] == 3 and figures["batches"] >= 3
    assert len(progress.batches) == 2 and {b["query"] for b in progress.batches} == set(progress.totals)


def test_a_lasting_error_fails_the_stream_and_loses_nothing(spark, folder, target, monkeypatch):
    path, checkpoint = f"{folder}/log", f"{folder}/checkpoint"
    write_log(spark, path, [order(1)])
    real, calls = stream.load_batch, []

    def failing(*args, **how):
        calls.append(1)
        raise RuntimeError("java.net.ConnectException: refused")

    monkeypatch.setattr(stream, "load_batch", failing)
    with pytest.raises(Exception, match="refused"):
        stream.run_load(log.file_stream(spark, path), target, checkpoint, backoff_ms=1)
    assert len(calls) == 3
    monkeypatch.setattr(stream, "load_batch", real)
    stream.run_load(log.file_stream(spark, path), target, checkpoint)
    assert ids(spark, target) == ["ORD-20250110-00001"]


def test_stopping_between_batches(spark, folder, target):
    path = f"{folder}/log"
    write_log(spark, path, [order(1), order(2)])
    query = stream.start_load(log.file_stream(spark, path), target, f"{folder}/c", every="0 seconds")
    query.processAllAvailable()
    stream.stop_after_batch(query)
    assert not query.isActive and len(ids(spark, target)) == 2


def test_retry_waits_twice_as_long_each_time():
    waits, calls = [], []

    def work():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("java.net.SocketException")

    assert with_retry(work, lambda e: True, 3, 1000, waits.append) == 3
    assert waits == [1.0, 2.0]
    with pytest.raises(ValueError):
        with_retry(lambda: int("x"), lambda e: False, 3, 1000, waits.append)
    assert waits == [1.0, 2.0]


def test_status_updates_rewrite_only_what_they_touch(spark, log_of, target):
    load_batch(log_of([order(1), order(2), order(3, order_id="ORD-20240229-00003")]), target, 0, DONE)
    untouched = month_files(spark, target, "202402")
    updates = spark.createDataFrame(
        [("ORD-20250110-00001", "processing", 1), ("ORD-20250110-00001", "completed", 2), ("none", "failed", 3)],
        "order_id string, status string, updated_at int",
    )
    update_stored(spark, target, updates)
    rows = {r.order_id: r.status for r in tables.read_orders(spark, target).collect()}
    assert rows == {"ORD-20250110-00001": "completed", "ORD-20250110-00002": "pending", "ORD-20240229-00003": "pending"}
    assert month_files(spark, target, "202402") == untouched


def test_updates_keep_every_order_once(spark, log_of, target):
    load_batch(log_of([order(n) for n in range(6)]), target, 0, DONE)
    stored = tables.read_orders(spark, target)
    updates = stored.select("order_id", F.lit("failed").alias("status"), F.lit(1).alias("updated_at"))
    assert apply_updates(stored, updates.union(updates)).where("status = 'failed'").count() == 6


def test_compaction_keeps_the_rows(spark, log_of, target):
    for batch in range(3):
        load_batch(log_of([order(batch)], first_offset=batch), target, batch, DONE)
    before = ids(spark, target)
    compact_month(spark, target, "202501")
    assert ids(spark, target) == before
    assert len(tables.read_orders(spark, target).inputFiles()) == 1
    load_batch(log_of([order(0), order(9)], first_offset=20), target, 3, DONE)
    assert len(ids(spark, target)) == 4


def test_old_rows_get_the_new_columns(spark, log_of, target):
    load_batch(log_of([order(1)]), target, 0, DONE)
    new = tables.read_orders(spark, target)
    old = roll_back(new, ["customer_name", "customer_email"])
    row = evolve(old).first()
    assert row.customer_name is None and row.order_id == "ORD-20250110-00001"
    assert evolve(old).columns == evolve(new).columns


def test_creating_tables_twice_keeps_them(spark, log_of, target):
    load_batch(log_of([order(1)]), target, 0, DONE)
    tables.create_tables(spark, target)
    assert ids(spark, target) == ["ORD-20250110-00001"]


def test_expired_months_are_not_read(spark, log_of, target):
    load_batch(log_of([order(1), order(2, order_id="ORD-20240229-00003")]), target, 0, DONE)
    kept = tables.unexpired(tables.read_orders(spark, target), "202501")
    assert [r.order_id for r in kept.collect()] == ["ORD-20250110-00001"]


def test_copies_within_the_watermark_are_dropped(spark, folder):
    path = f"{folder}/log"
    write_log(spark, path, [order(1), order(1), order(2), "{ bad }"])
    kept = stream.first_copies_within(log.file_stream(spark, path)).select("order_id")
    query = kept.writeStream.format("memory").queryName("kept").trigger(availableNow=True)
    query.option("checkpointLocation", f"{folder}/c").start().awaitTermination()
    assert sorted(r.order_id[-1] for r in spark.table("kept").collect()) == ["1", "2"]


def test_late_first_copies_are_kept(spark, folder):
    """Files out of order: hours behind, and still no order lost; a hot id meets its copies in other batches."""
    path = f"{folder}/log"
    batches = [([order(1), order(1), order(2), "{ bad }"], 50_000), ([order(3), order(1)], 0), ([order(1)] * 20 + [order(2)], 50_010)]
    for messages, first in batches:
        write_log(spark, path, messages, first_offset=first)
        time.sleep(1.1)  # files are read by their time
    query = stream.start_first_copies(log.file_stream(spark, path, 1), f"{folder}/kept", f"{folder}/c")
    query.awaitTermination()
    kept = spark.read.parquet(f"{folder}/kept")
    assert kept.select("batch_id").distinct().count() >= 2
    assert {r.order_id[-1] for r in kept.collect()} == {"1", "2", "3"}
    # a copy further away than the delay is a message of its own
    assert kept.groupBy("order_id", "hour").count().where("count > 1").count() == 0


def test_any_number_of_months_is_looked_up(spark, log_of, target):
    load_batch(log_of([order(1), order(2, order_id="ORD-20240229-00003")]), target, 0, DONE)
    many = [(f"ORD-{m:06d}15-00001",) for m in range(200001, 202001)] + [("ORD-20250110-00001",)]
    batch = spark.createDataFrame(many, "order_id string")
    months = batch.selectExpr("substr(order_id, 5, 6) m", "order_id lo", "order_id hi").collect()
    ranges = month_ranges(months)
    assert len(ranges) <= 64 and ranges[0][0] == "200001" and ranges[-1][1] == "202501"
    assert [r.order_id for r in near(tables.read_orders(spark, target), batch).collect()] == ["ORD-20250110-00001"]


def test_running_totals_follow_the_stored_orders(spark, folder):
    rows = [(f"o{n}", f"c{n % 2}", "1.50") for n in range(6)]
    made = spark.createDataFrame(rows, "order_id string, customer_id string, t string")
    made = made.select("order_id", "customer_id", F.col("t").cast("decimal(10,2)").alias("total_amount"))
    made.repartition(3, "order_id").write.parquet(f"{folder}/stored")
    source = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/stored")
    stream.start_totals(source, f"{folder}/totals", f"{folder}/c").awaitTermination()
    found = {r.customer_id: (r.orders, str(r.total_spent)) for r in stream.latest_totals(spark, f"{folder}/totals").collect()}
    assert found == {"c0": (3, "4.50"), "c1": (3, "4.50")}


def test_writers_do_not_replace_each_other(spark, log_of, target, folder):
    load_batch(log_of([order(n) for n in range(1, 6)]), target, 0, DONE)
    for run, messages in enumerate(([order(6), order(1)], [order(7)])):
        write_log(spark, f"{folder}/log{run}", messages)
        stream.run_load(log.file_stream(spark, f"{folder}/log{run}"), target, f"{folder}/checkpoint{run}", processed_at=DONE)
        assert len(ids(spark, target)) == 6 + run
    load_batch(log_of([order(8)]), target, 0, DONE, writer="evening")
    load_batch(log_of([order(8)]), target, 0, DONE, writer="evening")
    assert ids(spark, target) == [f"ORD-20250110-0000{n}" for n in range(1, 9)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_compaction_and_updates_under_both_overwrite_modes(spark, log_of, target, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for batch in range(2):
            load_batch(log_of([order(batch)], first_offset=batch), target, batch, DONE)
        compact_month(spark, target, "202501")
        assert len(ids(spark, target)) == 2
        updates = spark.createDataFrame([(None, "failed", 1), ("ORD-20250110-00001", "failed", 1)], "order_id string, status string, updated_at int")
        update_stored(spark, target, updates)
        update_stored(spark, target, updates.where("order_id is null"))
        assert sorted(r.status for r in tables.read_orders(spark, target).collect()) == ["failed", "pending"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
