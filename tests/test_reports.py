"""Reports against small fixtures and brute force."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import SF, order
from pyspark.sql import functions as F

from tallybrook.functions.containment import contains_items
from tallybrook.functions.ids import export_json, order_id_parts
from tallybrook.functions.text import mask_password
from tallybrook.functions.times import epoch_to_iso_millis
from tallybrook.operators.classify import classify
from tallybrook.plans import checks, eventlog, logs, reports
from tallybrook.plans.catalog import QUERIES
from tallybrook.schemas import ENVELOPE
from tallybrook.sinks import jdbc, tables, topic
from tallybrook.sources import log

T0 = datetime(2025, 1, 10)


def test_sequence_breaks_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (f"CUST-{0 if n % 3 else n % 4}", n % 2, T0 + timedelta(hours=rng.randrange(200)), f"o{n:04d}", rng.randrange(10_000))
        for n in range(600)
    ]
    shape = "customer_id string, partition int, created_at timestamp_ntz, order_id string, offset long"
    log_rows = spark.createDataFrame(rows, shape).repartition(5)
    wanted = set()
    for key in {r[:2] for r in rows}:
        mine = sorted(r[2:] for r in rows if r[:2] == key)
        wanted |= {(*key, b[1], b[2], a[1], a[2]) for a, b in zip(mine, mine[1:]) if a[2] > b[2]}
    for bucket in ("hour", "day", "month"):
        assert {tuple(r) for r in reports.sequence_breaks(log_rows, bucket=bucket).collect()} == wanted
    assert len(wanted) > 100


def test_sequence_in_order_has_no_breaks(spark):
    rows = [("c", 0, T0 + timedelta(minutes=n), f"o{n}", n) for n in range(50)]
    shape = "customer_id string, partition int, created_at timestamp_ntz, order_id string, offset long"
    assert reports.sequence_breaks(spark.createDataFrame(rows, shape)).count() == 0


@pytest.mark.parametrize(
    "pattern, found",
    [
        ([{"name": "Dumplings"}], True),
        ([{"name": "Rice"}, {"name": "Dumplings"}], True),
        ([{"name": "Dumplings", "quantity": 2}], True),
        ([{"name": "Dumplings", "quantity": 1}], False),
        ([{"name": "Dumplings"}, {"name": "Coke"}], False),
        ([{"name": "Burg"}], False),
        ([], True),
        ([{}], True),
    ],
)
def test_containment(log_of, pattern, found):
    rows = classify(log_of([order()]))
    assert rows.select(contains_items(F.col("items"), pattern).alias("x")).first().x is found


def test_lag_counts_from_the_start_without_a_commit(spark):
    rows = [(b"k", b"v", "t", p, o, T0) for p, o in [(0, 5), (0, 9), (1, 3), (2, 0)]]
    committed = spark.createDataFrame([("t", 0, 10), ("t", 1, 4)], "topic string, partition int, committed long")
    lag = reports.consumer_lag(spark.createDataFrame(rows, ENVELOPE), committed)
    assert {r.partition: r.lag for r in lag.collect()} == {0: 0, 1: 0, 2: 1}


def test_success_rate_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "outcome string, reason string, messages long")
    row = reports.success_rate(empty).first()
    assert (row.succeeded, row.failed, row.success_rate, row.reported_rate) == (0, 0, None, None)
    five = spark.createDataFrame([("processed", "", 5)], "outcome string, reason string, messages long")
    assert reports.success_rate(five).first().success_rate == 100.0


def test_throughput_of_one_moment_is_null(spark):
    rows = spark.createDataFrame([(b"k", b"v", "t", 0, 1, T0)], ENVELOPE)
    assert reports.throughput(rows).first().actual_rate is None


def test_reconciliation_names_the_fields(spark):
    shape = "order_id string, a int, b string"
    produced = spark.createDataFrame([("1", 1, "x"), ("2", 2, None), ("3", 3, "z"), ("4", 4, "w")], shape)
    stored = spark.createDataFrame([("1", 1, "x"), ("2", 2, None), ("3", 9, "q"), ("5", 5, "v")], shape)
    rows = {r.order_id: (r.state, r.different) for r in checks.reconcile(produced, stored, ["a", "b"]).collect()}
    assert rows == {"1": ("match", ""), "2": ("match", ""), "3": ("mismatch", "a,b"), "4": ("missing", ""), "5": ("extra", "")}


def test_quality_rules_catch_bad_orders(log_of):
    bad = order(customer_email="nobody", customer_name="Single", order_id="X-1", customer_id="Y", total_amount=5)
    found = {r.rule: r.violations for r in checks.quality_report(classify(log_of([order(), bad]))).collect()}
    assert {k for k, v in found.items() if v} == {
        "total_is_sum_of_subtotals", "order_id_format", "customer_id_format", "email_format", "name_has_two_words",
    }


def test_state_at_a_time(spark):
    rows = [("o1", "pending", T0, 0), ("o1", "paid", T0 + timedelta(1), 1), ("o1", "shipped", T0 + timedelta(2), 2), ("o2", "pending", T0, 3)]
    events = spark.createDataFrame(rows, "order_id string, status string, ts timestamp_ntz, n int")
    now = eventlog.latest_state(events, "order_id", ["status"], ["ts", "n"])
    assert {r.order_id: (r.status, r.events) for r in now.collect()} == {"o1": ("shipped", 3), "o2": ("pending", 1)}
    then = eventlog.state_asof(events, "order_id", ["status"], ["ts", "n"], "2025-01-11 12:00:00")
    assert {r.order_id: r.status for r in then.collect()} == {"o1": "paid", "o2": "pending"}


def test_compaction_drops_deleted_keys(spark):
    rows = [(b"a", b"1", "t", 0, 0, T0), (b"a", b"2", "t", 0, 1, T0), (b"b", b"1", "t", 0, 2, T0), (b"b", None, "t", 0, 3, T0)]
    kept = eventlog.compact(spark.createDataFrame(rows, ENVELOPE)).collect()
    assert [(bytes(r.key), bytes(r.value)) for r in kept] == [(b"a", b"2")]


def test_log_lines(spark, tmp_path):
    lines = [
        '{"timestamp":"2025-01-10T14:30:00.123Z","level":"INFO","service":"consumer","logger":"x","message":"done",'
        '"correlation_id":"ORD-1","extra":{"processing_time_ms":12.5,"customer_id":"C"}}',
        '{"timestamp":"2025-01-10T14:30:01.000Z","level":"ERROR","service":"consumer","logger":"x","message":"bad","exception":"ValueError"}',
        "plain text", "", "[1]",
    ]
    records = logs.parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = records.orderBy("logged_at").collect()
    assert len(rows) == 2
    assert rows[0].processing_time_ms == 12.5 and rows[0].logged_at == datetime(2025, 1, 10, 14, 30, 0, 123000)
    assert (rows[1].correlation_id, rows[1].exception) == (None, "ValueError")
    (tmp_path / "a.log").write_text("\n".join(lines))
    assert logs.read(spark, str(tmp_path)).drop("extra").collect() == records.drop("extra").collect()
    assert logs.with_level(records, "ERROR").count() == 1
    assert records.select(F.try_variant_get("extra", "$.customer_id", "string")).first()[0] == "C"


@pytest.mark.parametrize(
    "url, masked",
    [
        ("postgresql://user:secret@host:5432/db", "postgresql://user:***@host:5432/db"),
        ("postgresql://user:p@ss:w@host/db", "postgresql://user:p@ss:***@host/db"),
        ("sqlite:///file.db", "sqlite:///file.db"),
        ("scheme://user@host", "scheme:***@host"),
        ("nocolon@host", "nocolon@host"),
        ("a:b@", "a:***@"),
        ("", ""),
    ],
)
def test_masked_passwords(spark, url, masked):
    assert spark.createDataFrame([(url,)], "u string").select(mask_password(F.col("u"))).first()[0] == masked


def test_times_are_cut_to_milliseconds(spark):
    values = [(0.0,), (1736519400.1239,), (1736519400.9999,)]
    rows = spark.createDataFrame(values, "t double").select(epoch_to_iso_millis(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["1970-01-01T00:00:00.000Z", "2025-01-10T14:30:00.123Z", "2025-01-10T14:30:00.999Z"]


def test_order_id_parts_of_odd_ids(spark):
    rows = spark.createDataFrame([("ORD-20250110-123456",), ("ORD-20259999-00001",), ("X",)], "o string")
    found = rows.select(*order_id_parts(F.col("o"))).collect()
    assert (found[0].prefix, str(found[0].order_date), found[0].sequence) == ("ORD", "2025-01-10", 123456)
    assert found[1].order_date is None and found[2].prefix is None


def test_export_keeps_nulls_and_items(log_of):
    import json

    row = classify(log_of([order()])).withColumn("processed_at", F.lit(None).cast("timestamp_ntz"))
    exported = json.loads(row.select(export_json()).first()[0])
    assert exported["processed_at"] is None and exported["total_amount"] == 17.35
    assert exported["created_at"] == "2025-01-10T14:30:00" and len(exported["items"]) == 2


def test_unsendable_orders_are_told_apart(spark):
    rows = spark.createDataFrame([("1", "c"), (None, "c"), ("2", None)], "order_id string, customer_id string")
    assert topic.messages(rows).count() == 1
    assert sorted(r.reason for r in topic.unsendable(rows).collect()) == ["no_customer_id", "no_order_id"]


# --- options of the adapters that cannot be run here ----------------------


def test_broker_options():
    options = log.kafka_options("b:9092", "order-messages", max_offsets=1000, min_partitions=64)
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "order-messages"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("1000", "64")
    assert log.kafka_range_options("b", "t", '{"t":{"0":5}}')["endingOffsets"] == "latest"
    with pytest.raises(ValueError):
        log.kafka_options("b", "t", "yesterday")
    with pytest.raises(ValueError):
        log.kafka_range_options("b", "t", "latest")
    assert topic.kafka_write_options("b:9092")["kafka.acks"] == "all"


def test_database_statements():
    merge = jdbc.merge_statement("orders_new")
    assert merge.startswith("INSERT INTO orders (order_id, ") and merge.endswith("ON CONFLICT (order_id) DO NOTHING")
    assert "items::jsonb" in merge
    made = jdbc.create_statement()
    assert "order_id VARCHAR(50) PRIMARY KEY" in made and "status VARCHAR(20) NOT NULL" in made
    assert "total_amount DECIMAL(10,2) NOT NULL CHECK (total_amount > 0)" in made
    assert "items JSONB NOT NULL" in made and "processed_at TIMESTAMP DEFAULT" in made
    options = jdbc.read_options("jdbc:x", "orders", "created_at", "2025-01-01", "2025-02-01", 31)
    assert options["partitionColumn"] == "created_at" and options["numPartitions"] == "31"
    assert jdbc.write_options("jdbc:x", "t")["stringtype"] == "unspecified"


def test_flat_rows_carry_items_as_text(log_of):
    rows = classify(log_of([order()])).withColumn("processed_at", F.lit(None).cast("timestamp_ntz"))
    assert jdbc.flat(rows).first()["items"].startswith('[{"item_id":"ITEM-001"')


# --- plans ----------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in QUERIES if not n.startswith(("pipeline", "stream", "live"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_everything_with_everything(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_columns_are_pruned(spark):
    text = plan(QUERIES["orders_per_customer"](spark, SF))
    assert "l_quantity" not in text and "collect_list" not in text
    assert "o_orderdate" not in text


def test_first_copies_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["dedup_orders"](spark, SF))
    assert text.index("row_number(), 1, Final") < text.index("row_number(), 1, Partial")


def test_latest_orders_sorts_no_more_than_it_shows(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["latest_orders"](spark, SF))


def test_messages_are_parsed_once(spark):
    for name in ("outcome_counters", "dedup_orders", "message_outcomes", "parsed_logs", "error_logs"):
        assert plan(QUERIES[name](spark, SF)).count("parseJson") == 1, name


def test_stored_filters_reach_the_files(spark, log_of, tmp_path):
    from tallybrook.operators.load import load_batch

    target = tables.Target(str(tmp_path / "t"))
    load_batch(log_of([order(1)]), target, 0)
    stored = tables.read_orders(spark, target)
    text = plan(reports.customer_between(stored, "CUST-00001", "2025-01-01", "2025-02-01"))
    assert "EqualTo(customer_id,CUST-00001)" in text and "created_at" in text.split("PushedFilters")[1]
    assert "customer_email" not in text.split("ReadSchema")[1]
