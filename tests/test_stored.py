"""Folders that count, levels of runs, bounded runs, selection, status history and sketches."""

import os
import random
import tempfile
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import SF, envelopes, order
from pyspark.sql import functions as F

from tallybrook.operators import bounded, history, sketches
from tallybrook.operators import load as load_module
from tallybrook.operators.load import compact_month, load_batch, update_stored
from tallybrook.operators.selection import values_of_rank
from tallybrook.plans import catalog, reports
from tallybrook.sinks import tables
from tallybrook.sinks.listing import Listing
from tallybrook.sinks.runs import Runs
from tallybrook.sinks.tables import Target
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


def three_months(log_of):
    return log_of([order(n, order_id=f"ORD-2025{m:02d}10-{n:05d}", created_at=f"2025-{m:02d}-10T00:00:00Z") for m in (1, 2, 3) for n in range(3)])


def test_lists_are_replaced_as_a_whole(spark, folder):
    listing = Listing(spark, f"{folder}/lists")
    assert listing.read() is None
    for n in range(8):
        listing.replace([{"n": n}])
        assert listing.read() == [{"n": n}]
    assert len([f for f in os.listdir(f"{folder}/lists") if f.startswith("list-")]) <= 5


def test_retention_removes_months(spark, log_of, target):
    load_batch(three_months(log_of), target, 0, DONE)
    kept = [i for i in ids(spark, target) if i >= "ORD-202502"]
    assert tables.drop_months(spark, target, "202502") == ["202501"]
    assert ids(spark, target) == kept and len(kept) == 6
    assert not any("order_month=202501" in d and files for d, _, files in os.walk(target.orders))
    assert tables.drop_months(spark, target, "202502") == []


@pytest.mark.parametrize("step", ["compact", "retain", "update"])
@pytest.mark.parametrize("moment", ["before the switch", "before the delete"])
def test_a_job_that_dies_between_the_steps_loses_nothing(spark, log_of, target, monkeypatch, step, moment):
    load_batch(three_months(log_of), target, 0, DONE)
    load_batch(log_of([order(9, order_id="ORD-20250111-00009")], first_offset=50), target, 1, DONE)
    before = ids(spark, target)
    updates = spark.createDataFrame([("ORD-20250110-00001", "done", 1)], "order_id string, status string, updated_at int")

    def work():
        if step == "compact":
            compact_month(spark, target, "202501")
        elif step == "update":
            update_stored(spark, target, updates)
        else:
            tables.drop_months(spark, target, "202502")

    def dies(*args, **how):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if moment == "before the switch":
            patch.setattr(Listing, "replace", dies)
        else:
            patch.setattr(tables, "delete_folder", dies)
        with pytest.raises(RuntimeError):
            work()
    after = ids(spark, target)
    assert after == (before if step != "retain" or moment == "before the switch" else [i for i in before if i >= "ORD-202502"])
    # January has two folders, one of which has the updated order
    left = {"compact": (1, 2), "retain": (0, 2), "update": (1, 1)}[step][moment == "before the delete"]
    assert tables.sweep_orders(spark, target) == left
    assert ids(spark, target) == after
    work()
    assert tables.sweep_orders(spark, target) == 0
    assert ids(spark, target) == (before if step != "retain" else [i for i in before if i >= "ORD-202502"])


def test_a_batch_that_dies_before_the_switch_is_stored_once(spark, log_of, target, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(Listing, "replace", lambda self, parts: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load_batch(log_of([order(1)]), target, 0, DONE)
    assert ids(spark, target) == []
    load_batch(log_of([order(1)]), target, 0, DONE)
    assert ids(spark, target) == [order(1)["order_id"]]
    assert tables.sweep_orders(spark, target) == 1


def test_filters_on_customer_time_and_id_leave_out_row_groups(spark, target):
    """One month of many customers: both bounds of a row group are narrow, so each filter leaves most of them out."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the plan's text is cut
    n = 40_000
    day = F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 7919) % (31 * 1440))
    rows = spark.range(n).select(
        F.concat(F.lit("ORD-"), F.date_format(day, "yyyyMMdd"), F.lit("-"), F.lpad("id", 5, "0")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.lpad((F.col("id") * 31) % 5000, 5, "0")).alias("customer_id"),
        F.lit("n").alias("customer_name"), F.lit("e").alias("customer_email"), F.lit(None).cast(tables.ORDERS["items"].dataType).alias("items"),
        F.lit(1).cast("decimal(10,2)").alias("total_amount"), F.lit("s").alias("status"), day.alias("created_at"), day.alias("processed_at"),
        F.lit(None).cast("string").alias("items_json"), F.lit("202501").alias("order_month"), F.lit(0).cast("bigint").alias("batch_id"),
    )
    parts = tables.write_orders(rows.coalesce(1), target, 5000.0, bounds={"202501": ("2025-01-01", "2025-01-31")}, **{"parquet.block.size": "20000", "parquet.page.size": "4096", "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"})
    tables.switch_parts(spark, target, lambda p: False, parts)
    groups = []
    for path in tables.read_orders(spark, target).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            groups.append((columns["customer_id"], columns["created_at"]))
    assert len(groups) >= 30
    of_customer = [c.min <= "CUST-02500" <= c.max for c, _ in groups]
    of_time = [t.min <= datetime(2025, 1, 15) and t.max >= datetime(2025, 1, 14) for _, t in groups]
    assert sum(of_customer) < len(groups) / 3 and sum(of_time) < len(groups) / 3
    assert sum(a and b for a, b in zip(of_customer, of_time)) < len(groups) / 8
    stored = tables.read_orders(spark, target)
    plan = reports.by_id(stored, "ORD-20250114-00001")._jdf.queryExecution().executedPlan().toString()
    assert "order_month" in plan.split("PartitionFilters")[1].split("]")[0] and "EqualTo(order_id,ORD-20250114-00001)" in plan
    plan = reports.customer_between(stored, "CUST-02500", "2025-01-14", "2025-01-15")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id,CUST-02500)" in plan and "GreaterThanOrEqual(created_at" in plan
    assert tables.read_orders(spark, target, "2025-02-01").count() == 0


def test_times_of_creation_need_not_be_those_of_the_id(spark, log_of, target):
    load_batch(log_of([order(1, created_at="2026-03-01T00:00:00Z"), order(2)]), target, 0, DONE)
    load_batch(log_of([order(3)], first_offset=9), target, 1, DONE)
    assert [r.order_id[-1] for r in tables.read_orders(spark, target, "2026-01-01").where("created_at >= '2026-01-01'").collect()] == ["1"]
    assert tables.read_orders(spark, target, "2025-06-01", "2025-07-01").where("batch_id = 1").count() == 0


def test_a_range_of_a_customer_has_rows(spark):
    assert catalog.QUERIES["customer_time_range"](spark, SF).count() > 0


# --- levels -----------------------------------------------------------------


def test_runs_grow_with_the_logarithm_of_the_batches(spark, folder):
    runs = Runs(spark, f"{folder}/runs", "k string, v bigint", fold=lambda r: r.groupBy("k").agg(F.max("v").alias("v")), place=lambda r: r.coalesce(1), fan=3)
    for batch in range(20):
        runs.fold_up(batch)
        rows = spark.createDataFrame([(str(batch % 4), batch)], "k string, v bigint")
        runs.add(rows, batch, lambda written: [batch, batch])
        if batch % 7 == 0:
            runs.add(rows, batch, lambda written: [batch, batch])  # written again
        assert len(runs.parts()) <= 8
    assert {r.k: r.v for r in runs.fold(runs.read()).collect()} == {"0": 16, "1": 17, "2": 18, "3": 19}
    assert sorted(x for p in runs.parts() for x in range(p["first"], p["last"] + 1)) == list(range(20))
    os.makedirs(f"{folder}/runs/run-left")
    runs.sweep()
    assert len([f for f in os.listdir(f"{folder}/runs") if f.startswith("run-")]) == len(runs.parts())


def test_a_stream_without_copies_leaves_few_files(spark, folder):
    path = f"{folder}/log"
    for i in range(6):
        envelopes(spark, [order(n, order_id=f"ORD-2025{1 + n % 12:02d}10-{n:05d}") for n in range(i * 5, i * 5 + 10)], i * 4000).coalesce(1).write.mode("append").parquet(path)
    query = stream.start_first_copies(log.file_stream(spark, path, 1), f"{folder}/kept", f"{folder}/c", delay="30 days", buckets=2)
    query.awaitTermination()
    kept = spark.read.parquet(f"{folder}/kept")
    assert sorted(r.order_id for r in kept.collect()) == sorted({f"ORD-2025{1 + n % 12:02d}10-{n:05d}" for n in range(35)})
    assert kept.select("batch_id").distinct().count() == 6 and len(kept.inputFiles()) <= 12
    seen = stream.seen_keys(spark, f"{folder}/kept/_seen", 2)
    assert seen.read().count() == 35 and len(seen.parts()) == 3  # four batches folded, two to come


# --- bounded runs -----------------------------------------------------------


def test_shares_are_even_and_whole():
    rng = random.Random(1)
    for _ in range(300):
        available = {k: rng.randrange(9) for k in range(rng.randrange(1, 6))}
        wanted = rng.randrange(40)
        turns = sorted((n, k) for k, most in available.items() for n in range(most))[:wanted]
        assert bounded.share(available, wanted) == {k: sum(x == k for _, x in turns) for k in available}


def test_five_messages_and_five_more(spark, target, monkeypatch):
    messages = envelopes(spark, [order(n) for n in range(8)], 0, 0).unionAll(envelopes(spark, [order(n) for n in range(8, 12)], 100, 1))
    assert bounded.run_messages(messages, target, "r", 5, processed_at=DONE) == 5
    assert len(ids(spark, target)) == 5
    real = bounded.load_batch
    with monkeypatch.context() as patch:
        patch.setattr(bounded, "load_batch", lambda *a, **k: (real(*a, **k), (_ for _ in ()).throw(RuntimeError("lost"))))
        with pytest.raises(RuntimeError):
            bounded.run_messages(messages, target, "r", 5, processed_at=DONE)
    assert bounded.run_messages(messages, target, "r", 5, processed_at=DONE) == 5  # the same five, stored once
    assert len(ids(spark, target)) == 10
    assert bounded.run_messages(messages, target, "r", 5, processed_at=DONE) == 2
    assert bounded.run_messages(messages, target, "r", 5, processed_at=DONE) == 0
    assert len(ids(spark, target)) == 12


def test_values_of_rank_equal_sorting(spark):
    rng = random.Random(4)
    values = {"a": [rng.gauss(0, 1e6) for _ in range(3000)], "b": [float(rng.randrange(3)) for _ in range(500)], "c": [7.0]}
    rows = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("a", None), (None, 1.0)], "g string, v double")
    wanted = [("a", 1), ("a", 1500), ("a", 3000), ("b", 250), ("c", 1)]
    assert values_of_rank(rows, F.col("g"), "v", wanted) == [sorted(values[g])[k - 1] for g, k in wanted]
    assert values_of_rank(rows, F.col("g"), "v", []) == []


# --- history and sketches ---------------------------------------------------


def test_merged_intervals_do_not_depend_on_the_order_of_arrival(spark, folder):
    rng = random.Random(8)
    start = datetime(2025, 1, 1)
    events = [(f"ORD-2025{rng.randrange(1, 4):02d}10-0000{rng.randrange(3)}", rng.choice("abc"), start + timedelta(days=rng.randrange(80), hours=rng.randrange(2))) for _ in range(120)]
    shape = "order_id string, status string, updated_at timestamp_ntz"
    kept = history.History(spark, f"{folder}/history")
    for i in range(0, 120, 50):
        kept.merge(spark.createDataFrame(events[i : i + 50], shape))
    kept.merge(spark.createDataFrame(events[10:30] + [("odd", "x", start), (None, "y", start)], shape))
    rows = kept.read()
    by_order = {}
    for o, s, t in [*events, ("odd", "x", start)]:
        by_order.setdefault(o, {})[t] = max(s, by_order.get(o, {}).get(t, ""))
    wanted = []
    for o, at in by_order.items():
        times = sorted(at)
        wanted += [(o, at[t], t, after) for t, after in zip(times, [*times[1:], None])]
    key = lambda r: (r[0], r[2])
    assert sorted([tuple(r)[:4] for r in rows.collect()], key=key) == sorted(wanted, key=key)
    asked = [(o, start + timedelta(days=d)) for o in [*by_order, "none"] for d in (-1, 0, 17, 200)]
    found = {(r.order_id, r.asked_at): r.status_then for r in history.asof(spark.createDataFrame(asked, "order_id string, asked_at timestamp_ntz"), rows).collect()}
    assert found == {(o, t): ([at[x] for x in sorted(at) if x <= t] or [None])[-1] for o, t in asked for at in [by_order.get(o, {})]}


def test_sketches_of_parts_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 7).alias("part"), (F.col("id") * 17 % 6000).alias("customer"), F.lit("s").alias("service"), (F.col("id") * 31 % 9973).cast("double").alias("took"))
    kept = sketches.distinct_sketches(rows, "part", "customer")
    assert kept.count() == 7
    assert sketches.distinct_report(rows, kept, "customer", "customers").first()[:] == (6000, True)
    quantiles = sketches.quantile_sketches(rows, "service", F.col("part"), "took")
    row = sketches.percentile_report(rows, quantiles, "service", "took", {"half": 0.5, "most": 0.99}).first()
    values = sorted(n * 31 % 9973 for n in range(20_000))
    assert row[:] == ("s", 20_000, values[9999], values[19_799], True)
    wrong = sketches.quantile_sketches(rows.where("took < 5000"), "service", F.col("part"), "took")
    assert not sketches.percentile_report(rows, wrong, "service", "took", {"half": 0.5}).first().within_error


def test_a_session_without_settings_can_stage(tmp_path):
    """An empty configuration folder, as on a machine that names no shared folder."""
    import subprocess
    import sys

    code = (
        "from tallybrook.session import local_session, shared_dir\n"
        "spark = local_session('empty', 1, '1g')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "from tallybrook.sinks.tables import stage\n"
        "assert stage(spark.range(3), 'x').count() == 3 and shared_dir(spark) == shared_dir(spark)\n"
        "print('staged')\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert "staged" in done.stdout, done.stderr[-2000:]


def test_counters_name_every_reason():
    assert load_module.counters({"bad_utf8": 2, "null_violation": 1, "tombstone": 0}, 5, 3) == [
        ("failed", "bad_utf8", 2), ("skipped", "null_violation", 1), ("skipped", "duplicate", 2), ("processed", "", 3),
    ]


# --- progress and waiting orders ----------------------------------------------


def test_offsets_of_a_broker_stream_are_read_from_its_checkpoint(spark, folder):
    from tallybrook.streaming import progress

    for name in ("offsets", "commits"):
        os.makedirs(f"{folder}/c/{name}")
    for batch in range(3):
        with open(f"{folder}/c/offsets/{batch}", "w") as f:
            f.write('v1\n{"batchWatermarkMs":0,"conf":{"x":"y"}}\n{"orders":{"0":%d,"1":7}}' % (10 * batch))
    assert progress.committed_offsets(spark, f"{folder}/c").count() == 0
    for batch in range(2):
        with open(f"{folder}/c/commits/{batch}", "w") as f:
            f.write('v1\n{"nextBatchWatermarkMs":0}')
    # the third batch was planned and never committed
    assert sorted(tuple(r) for r in progress.committed_offsets(spark, f"{folder}/c").collect()) == [("orders", 0, 10), ("orders", 1, 7)]


def test_lag_of_an_interrupted_stream(spark, folder):
    from tallybrook.streaming import progress

    path, calls = f"{folder}/my log", []
    for i in range(3):
        envelopes(spark, [order(i), order(i + 10)], i * 10).coalesce(1).write.mode("append").parquet(path)

    def dies(batch, number):
        calls.append(number)
        if number == 2:
            raise RuntimeError("lost")

    def run(work):
        source = log.file_stream(spark, path, 1)
        return source.writeStream.foreachBatch(work).option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()

    with pytest.raises(Exception, match="lost"):
        run(dies).awaitTermination()
    lag = lambda: [tuple(r) for r in progress.file_stream_lag(log.files(spark, path), f"{folder}/c").collect()]
    assert lag() == [("order-messages", 0, 6, 22, 2)]
    run(lambda batch, number: None).awaitTermination()
    assert lag() == [("order-messages", 0, 6, 22, 0)]


def test_orders_wait_and_a_batch_that_comes_again_changes_nothing(spark, log_of, folder):
    from tallybrook.streaming.customers import WaitingOrders

    known = lambda name, *numbers: spark.createDataFrame([(f"CUST-{n:05d}",) for n in numbers], "customer_id string").write.parquet(f"{folder}/customers/{name}")
    orders = WaitingOrders(spark, f"{folder}/orders", f"{folder}/customers")
    state = lambda: (sorted((r.order_id[-1], r.waited) for r in orders.kept().collect()), sorted(r.order_id[-1] for r in orders.waiting().collect()))
    known("a", 1)
    orders.store(log_of([order(1), order(2), order(3), order(1)]), 0)  # customers 1, 2, 3
    assert state() == ([("1", False)], ["2", "3"])
    known("b", 2)
    for _ in range(2):
        orders.store(log_of([order(6), order(4)], first_offset=10), 1)  # customers 1 and 4
        assert state() == ([("1", False), ("2", True), ("6", False)], ["3", "4"])
    orders.store(log_of([order(8)], first_offset=20), 2)  # customer 3 is still unknown
    known("c", 3, 4)
    orders.store(log_of([order(9)], first_offset=30), 3)  # customer 4, known by now
    assert state() == ([("1", False), ("2", True), ("3", True), ("4", True), ("6", False), ("8", True), ("9", False)], [])


def test_judging_the_derived_log_is_compiled_in_two(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = load_module.for_stage(load_module.classify(catalog.order_messages(spark, SF), whole_items=True))
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
        # the JVM compiles no method beyond 8000 bytes
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_replay_makes_the_log_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(catalog, "order_messages", lambda spark, sf_dir, make=catalog.order_messages: made.append(sf_dir) or make(spark, sf_dir))
    assert {r.batch_id for r in catalog.QUERIES["pipeline_replay"](spark, SF).collect()} == {0, 1}
    assert len(made) == 1


def test_items_text_is_made_where_rows_have_none(spark, target):
    rows = catalog.stored_orders(spark, SF).limit(20).withColumn("order_month", F.lit("202501")).withColumn("batch_id", F.lit(0).cast("bigint"))
    tables.switch_parts(spark, target, lambda p: False, tables.write_orders(rows, target))
    read = tables.read_orders(spark, target)
    assert read.count() == 20 and read.where(~F.col("items_json").eqNullSafe(F.to_json("items"))).count() == 0


def test_updates_pick_folders_without_a_join(spark, target, monkeypatch):
    load_batch(envelopes(spark, [order(1), order(2)]), target, 0, DONE)
    plans, write = [], load_module.write_orders
    monkeypatch.setattr(load_module, "write_orders", lambda rows, *a, **k: plans.append(rows._jdf.queryExecution().analyzed().toString()) or write(rows, *a, **k))
    update_stored(spark, target, spark.createDataFrame([(order(1)["order_id"], "done", 1)], "order_id string, status string, updated_at int"))
    assert plans[0].count("Join ") == 1
