"""Every query by name, bound to the tables of one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import ids, text, times
from tallybrook.functions.draws import draw
from tallybrook.operators import bounded, classify, dedup, history, load, outcomes, sketches
from tallybrook.operators.decode import extract_order_id
from tallybrook.plans import checks, eventlog, logs, reports
from tallybrook.schemas import ENVELOPE, ORDERS
from tallybrook.session import configure, own_shuffles_dropped, shared_dir
from tallybrook.sinks import tables, topic
from tallybrook.sources import generator, log, warehouse
from tallybrook.sources.warehouse import order_lines, order_messages, stored_orders, table
from tallybrook.streaming import customers, progress
from tallybrook.streaming import load as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# parameters of the listings
ASOF = "1998-12-31 00:00:00"
CUSTOMER = "CUST-00042"
SPAN = ("1996-01-01", "2001-04-01")
FIRST_KEPT_MONTH = "199801"
RUN_MESSAGES = 600
POOL_CUSTOMERS, POOL_ITEMS = 17, 27
PATTERN = [{"name": "red widget"}, {"name": "hot ring"}]


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_orders(spark, sf_dir, with_items=False)


def run_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/runs/{uuid.uuid4().hex}"


def written_table(spark: SparkSession, sf_dir: str) -> tables.Target:
    """The stored orders, written as a loader writes them."""
    target = tables.Target(run_folder(spark))
    rows = stored_orders(spark, sf_dir).withColumn("order_month", ids.order_month(F.col("order_id"))).withColumn("batch_id", F.lit(0).cast("bigint"))
    with tables.scratch(spark, "written") as stage:
        rows = stage(rows)
        ends = load.month_ends(rows)
        largest, bounds = max((r.customer for r in ends), default=0.0), load.created_bounds(ends)
        tables.switch_parts(spark, target, lambda part: False, tables.write_orders(rows, target, largest, bounds=bounds))
    return target


_WRITTEN: dict[tuple[str, str], tables.Target] = {}


def loaded_table(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The stored table, written once in an application and read by every report on it; see ``read_orders`` for the times."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        _WRITTEN[key] = written_table(spark, sf_dir)
    return tables.read_orders(spark, _WRITTEN[key], start, end)


# --- log to stored orders -------------------------------------------------


@query
def log_revenue_per_customer(spark, sf_dir):
    """A4 over the whole way from the log: decode, judge, first copies, sum."""
    return reports.revenue_per_customer(outcomes.accepted_orders(order_messages(spark, sf_dir)))


@query
def message_outcomes(spark, sf_dir):
    rows = outcomes.outcomes(order_messages(spark, sf_dir))
    reason = F.coalesce("reason", F.lit("")).alias("reason")
    return rows.select("partition", "offset", "order_id", "outcome", reason)


@query
def outcome_counters(spark, sf_dir):
    return outcomes.reason_counts(order_messages(spark, sf_dir))


@query
def success_rate(spark, sf_dir):
    return reports.success_rate(outcomes.reason_counts(order_messages(spark, sf_dir)))


@query
def missing_field_report(spark, sf_dir):
    bad = classify.classify(order_messages(spark, sf_dir)).where("reason = 'missing_fields'")
    names = bad.select(F.explode(F.split("missing_fields", ",")).alias("field"))
    return names.groupBy("field").agg(F.count("*").alias("messages"))


@query
def quarantine(spark, sf_dir):
    rows = outcomes.quarantine(order_messages(spark, sf_dir))
    key = F.col("key").cast("string").alias("key")
    return rows.select(key, "partition", "offset", "order_id", "outcome", "reason")


@query
def dedup_orders(spark, sf_dir):
    rows = outcomes.accepted_orders(order_messages(spark, sf_dir))
    count = F.size("items").cast("bigint").alias("item_count")
    return rows.select(
        "order_id", "customer_id", "customer_name", "customer_email", count, "total_amount",
        "status", "created_at", "partition", "offset",
    )


@query
def duplicate_report(spark, sf_dir):
    """D4 over the log: ids of fit messages that were sent more than once."""
    fit = classify.classify(order_messages(spark, sf_dir)).where("reason is null")
    return dedup.duplicates(fit)


@query
def lenient_orders(spark, sf_dir):
    rows = classify.parse_lenient(order_messages(spark, sf_dir)).where("parsed")
    return rows.select("partition", "offset", "order_id", "total_amount", "status", "created_at")


@query
def extracted_order_ids(spark, sf_dir):
    rows = extract_order_id(order_messages(spark, sf_dir))
    return rows.select("partition", "offset", "order_id")


@query
def quantity_rule(spark, sf_dir):
    """V6 switched on: outcomes per reason with positive quantities demanded."""
    judged = classify.classify(order_messages(spark, sf_dir), check_quantity=True)
    reason = F.coalesce("reason", F.lit("")).alias("reason")
    return judged.groupBy(reason).agg(F.count("*").alias("messages"))


@query
def order_items(spark, sf_dir):
    return reports.order_items(outcomes.accepted_orders(order_messages(spark, sf_dir)))


@query
def order_totals(spark, sf_dir):
    return reports.totals_from_items(outcomes.accepted_orders(order_messages(spark, sf_dir)))


@query
def topic_messages(spark, sf_dir):
    """Stored orders as messages and read back by the loader's rules."""
    made = stored_orders(spark, sf_dir).withColumn(
        "created_at", F.concat(times.iso_seconds(F.col("created_at")), F.lit("Z"))
    )
    sent = topic.messages(made.drop("processed_at"))
    number = F.regexp_extract(F.get_json_object(F.col("value").cast("string"), "$.order_id"), r"(\d+)$", 1)
    rows = sent.withColumn("offset", number.cast("bigint")).withColumn(
        "timestamp", F.lit(ASOF).cast("timestamp")
    )
    back = classify.classify(rows.select(*ENVELOPE.names))
    outcome = classify.outcome_of(F.col("reason")).alias("outcome")
    return back.select("partition", "order_id", "customer_id", "total_amount", "status", "created_at", outcome)


def _loaded(spark, sf_dir) -> tables.Target:
    target = tables.Target(run_folder(spark))
    load.load_batch(order_messages(spark, sf_dir), target, 0, ASOF)
    return target


STORED = ["order_id", "customer_id", "customer_name", "customer_email", "total_amount",
          "status", "created_at"]


@query
def pipeline_batch(spark, sf_dir):
    """The batch loader, its table read back."""
    return tables.read_orders(spark, _loaded(spark, sf_dir)).select(*STORED)


@query
def pipeline_counters(spark, sf_dir):
    counted = tables.read_counters(spark, _loaded(spark, sf_dir))
    return counted.select("outcome", "reason", "messages")


@query
def pipeline_replay(spark, sf_dir):
    """The whole log loaded twice; the second run finds only copies."""
    folder = run_folder(spark)
    # a replay reads the log again, it does not make it again
    messages, target = log.files(spark, _log_files(spark, sf_dir, folder)), tables.Target(f"{folder}/tables")
    for batch_id in range(2):
        load.load_batch(messages, target, batch_id, ASOF)
    counted = tables.read_counters(spark, target)
    return counted.select("batch_id", "outcome", "reason", "messages")


@query
def stored_items_text(spark, sf_dir):
    """Items of the loaded table as they were sent, further keys included."""
    return tables.read_orders(spark, _loaded(spark, sf_dir)).select("order_id", "items_json")


def _stream_files(spark) -> int:
    """Files of a stream's source: as many as a shuffle has partitions, and enough for several micro-batches."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _log_files(spark, sf_dir, folder: str) -> str:
    path = f"{folder}/log"
    _write_log(order_messages(spark, sf_dir), path)
    return path


def _write_log(messages: DataFrame, path: str, *parts: str) -> None:
    spread = messages.repartition(_stream_files(messages.sparkSession), "partition", "offset")
    with own_shuffles_dropped(messages.sparkSession):
        spread.write.options(**tables.SMALL).partitionBy(*parts).parquet(path)


@query
def pipeline_stream(spark, sf_dir):
    """The loader as a stream of several micro-batches, its table read back."""
    folder = run_folder(spark)
    source = log.file_stream(spark, _log_files(spark, sf_dir, folder), max_files=-(-_stream_files(spark) // 2))
    target = tables.Target(f"{folder}/tables")
    stream.run_load(source, target, f"{folder}/checkpoint", processed_at=ASOF)
    return tables.read_orders(spark, target).select(*STORED)


@query
def stream_without_copies(spark, sf_dir):
    """X5 option: copies within an hour dropped, over several micro-batches that come out of order."""
    folder = run_folder(spark)
    source = log.file_stream(spark, _log_files(spark, sf_dir, folder), max_files=-(-_stream_files(spark) // 4))
    stream.start_first_copies(source, f"{folder}/kept", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/kept").select("order_id", "customer_id", "total_amount")


@query
def live_outcomes(spark, sf_dir):
    """Outcomes of a stream, from the figures that each batch leaves."""
    folder = run_folder(spark)
    source = log.file_stream(spark, _log_files(spark, sf_dir, folder), max_files=-(-_stream_files(spark) // 3))
    target = tables.Target(f"{folder}/tables")
    stream.run_load(source, target, f"{folder}/checkpoint", processed_at=ASOF)
    return stream.live_outcomes(spark, target)


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The log up to ASOF, and what comes after it."""
    early = F.col("timestamp") <= F.lit(ASOF).cast("timestamp")
    messages = order_messages(spark, sf_dir)
    return messages.where(early), messages.where(~early)


@query
def stream_lag(spark, sf_dir):
    """A8, A10 from the stream's own checkpoint: it has read the log up to ASOF, and the rest has come since."""
    folder = run_folder(spark)
    first, rest = _halves(spark, sf_dir)
    first.repartition(_stream_files(spark), "partition", "offset").write.parquet(f"{folder}/log")
    source = log.file_stream(spark, f"{folder}/log", max_files=-(-_stream_files(spark) // 2))
    source.select("offset").writeStream.format("noop").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rest.repartition(_stream_files(spark), "partition", "offset").write.mode("append").parquet(f"{folder}/log")
    return progress.file_stream_lag(log.files(spark, f"{folder}/log"), f"{folder}/checkpoint")


# Customers of these market segments are known from the start, or arrive after the first half of the log; the others never do.
KNOWN_SEGMENTS, LATE_SEGMENTS = ["AUTOMOBILE", "BUILDING"], ["MACHINERY", "HOUSEHOLD"]


@query
def late_customers(spark, sf_dir):
    """D6 as a stream: orders wait for their customer. Which were kept at once, which after waiting, and which still wait."""
    folder = run_folder(spark)
    who = table(spark, sf_dir, "customer").select(ids.customer_id(F.col("c_custkey")).alias("customer_id"), "c_mktsegment")
    orders = customers.WaitingOrders(spark, f"{folder}/orders", f"{folder}/customers")
    # made once, and then a folder for each half, which comes to the log when its turn has come
    half = F.when(F.col("timestamp") <= F.lit(ASOF).cast("timestamp"), "first").when(F.col("timestamp").isNotNull(), "second")
    _write_log(order_messages(spark, sf_dir).withColumn("half", half).where("half is not null"), f"{folder}/made", "half")
    for name, segments in zip(("first", "second"), (KNOWN_SEGMENTS, LATE_SEGMENTS)):
        who.where(F.col("c_mktsegment").isin(segments)).select("customer_id").write.parquet(f"{folder}/customers/{name}")
        log.arrive(spark, f"{folder}/made/half={name}", f"{folder}/log/{name}")
        source = log.file_stream(spark, f"{folder}/log/*", max_files=_stream_files(spark))
        customers.start_waiting(source, orders, f"{folder}/checkpoint").awaitTermination()
    kept = orders.kept().select("order_id", "customer_id", F.when(F.col("waited"), "after waiting").otherwise("at once").alias("state"))
    return kept.unionByName(orders.waiting().select("order_id", "customer_id", F.lit("waiting").alias("state")))


@query
def bounded_run(spark, sf_dir):
    """A run of RUN_MESSAGES messages, then another of as many; what is stored after both."""
    folder = run_folder(spark)
    target, messages = tables.Target(f"{folder}/tables"), log.files(spark, _log_files(spark, sf_dir, folder))
    for _ in range(2):
        bounded.run_messages(messages, target, "bounded", RUN_MESSAGES, processed_at=ASOF)
    return tables.read_orders(spark, target).select(*STORED)


@query
def stored_after_retention(spark, sf_dir):
    """The loaded table after the months before FIRST_KEPT_MONTH were dropped."""
    target = _loaded(spark, sf_dir)
    tables.drop_months(spark, target, FIRST_KEPT_MONTH)
    return tables.read_orders(spark, target).select(*STORED)


@query
def live_revenue(spark, sf_dir):
    """Running totals over a stream of stored orders, last state read back."""
    folder = run_folder(spark)
    rows = slim(spark, sf_dir).select("order_id", "customer_id", "total_amount")
    rows.repartition(_stream_files(spark), "order_id").write.parquet(f"{folder}/stored")
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-_stream_files(spark) // 2))
    totals = f"{folder}/totals"
    stream.start_totals(reader.parquet(f"{folder}/stored"), totals, f"{folder}/checkpoint").awaitTermination()
    return stream.latest_totals(spark, totals)


# --- counts and sums ------------------------------------------------------


@query
def total_orders(spark, sf_dir):
    return reports.total_orders(slim(spark, sf_dir))


@query
def orders_per_customer(spark, sf_dir):
    return reports.orders_per_customer(slim(spark, sf_dir))


@query
def orders_by_status(spark, sf_dir):
    return reports.orders_by_status(slim(spark, sf_dir))


@query
def revenue_per_customer(spark, sf_dir):
    return reports.revenue_per_customer(slim(spark, sf_dir))


@query
def average_order_value(spark, sf_dir):
    return reports.average_order_value(slim(spark, sf_dir))


@query
def unique_customers(spark, sf_dir):
    return reports.unique_customers(slim(spark, sf_dir))


@query
def unique_customers_estimate(spark, sf_dir):
    """A6 from sketches stored per month: the exact number, and whether the merged sketches are within their error."""
    orders = slim(spark, sf_dir)
    kept = tables.stage(sketches.distinct_sketches(orders, ids.order_month(F.col("order_id")), "customer_id"), "sketches")
    return sketches.distinct_report(orders, kept, "customer_id", "customers")


@query
def uniqueness(spark, sf_dir):
    return reports.uniqueness(slim(spark, sf_dir), order_lines(spark, sf_dir))


@query
def item_counts(spark, sf_dir):
    return reports.item_counts(stored_orders(spark, sf_dir))


# --- listings -------------------------------------------------------------


@query
def all_orders(spark, sf_dir):
    """The whole table, items as text."""
    shown = F.array_join(F.transform("items", lambda i: F.concat(i["item_id"], F.lit("x"), i["quantity"])), ",")
    rows = stored_orders(spark, sf_dir)
    return rows.select(*[shown.alias("items") if c == "items" else F.col(c) for c in ORDERS.names])


@query
def all_orders_newest_first(spark, sf_dir):
    return reports.newest_first(slim(spark, sf_dir))


@query
def latest_orders(spark, sf_dir):
    return reports.latest(slim(spark, sf_dir))


@query
def customer_orders(spark, sf_dir):
    return reports.of_customer(loaded_table(spark, sf_dir), CUSTOMER)


@query
def customer_history(spark, sf_dir):
    return reports.customer_history(loaded_table(spark, sf_dir), CUSTOMER)


@query
def customer_time_range(spark, sf_dir):
    return reports.customer_between(loaded_table(spark, sf_dir, *SPAN), CUSTOMER, *SPAN)


@query
def orders_last_hour(spark, sf_dir):
    return reports.since(loaded_table(spark, sf_dir, "1998-12-30", ASOF), ASOF, 1)


@query
def orders_last_day(spark, sf_dir):
    return reports.since(loaded_table(spark, sf_dir, "1998-12-30", ASOF), ASOF, 24)


@query
def orders_with_status(spark, sf_dir):
    return reports.with_status(loaded_table(spark, sf_dir), "pending")


@query
def order_lookup(spark, sf_dir):
    return reports.by_id(loaded_table(spark, sf_dir), "ORD-19990116-00002")


@query
def orders_containing_items(spark, sf_dir):
    return reports.containing(stored_orders(spark, sf_dir), PATTERN)


@query
def orders_containing_item_quantity(spark, sf_dir):
    """One pattern element on two keys, from the item table."""
    wanted = {"name": "red widget", "quantity": 10}
    return reports.containing_by_lines(slim(spark, sf_dir), warehouse.item_table(spark, sf_dir), wanted)


# --- latency and the log --------------------------------------------------


@query
def latency_report(spark, sf_dir):
    return reports.latency(slim(spark, sf_dir))


@query
def latency_of_latest(spark, sf_dir):
    return reports.latency_of_latest(slim(spark, sf_dir))


@query
def partition_inventory(spark, sf_dir):
    return reports.partition_inventory(order_messages(spark, sf_dir))


@query
def partition_distribution(spark, sf_dir):
    return reports.partition_distribution(order_messages(spark, sf_dir))


@query
def partitions_in_use(spark, sf_dir):
    return reports.partitions_in_use(order_messages(spark, sf_dir))


@query
def key_consistency(spark, sf_dir):
    return reports.key_consistency(order_messages(spark, sf_dir))


@query
def key_inconsistencies(spark, sf_dir):
    """A14 after a topic grew from 3 to 4 partitions at ASOF: keys that moved."""
    key = F.col("key").cast("string")
    before = F.col("timestamp") < F.lit(ASOF).cast("timestamp")
    grown = F.when(before, warehouse.log_partition(key, 3)).otherwise(warehouse.log_partition(key, 4))
    return reports.key_inconsistencies(order_messages(spark, sf_dir).withColumn("partition", grown))


@query
def consumer_lag(spark, sf_dir):
    """A8 for a consumer that committed everything up to ASOF."""
    messages = order_messages(spark, sf_dir)
    seen = messages.where(F.col("timestamp") <= F.lit(ASOF).cast("timestamp"))
    committed = seen.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed"))
    return reports.consumer_lag(messages, committed)


@query
def throughput(spark, sf_dir):
    return reports.throughput(order_messages(spark, sf_dir))


@query
def retained_messages(spark, sf_dir):
    kept = reports.retained(order_messages(spark, sf_dir), "2001-08-01 00:00:00")
    return kept.select(F.col("key").cast("string").alias("key"), "partition", "offset", "timestamp")


@query
def sequence_check(spark, sf_dir):
    return reports.sequence_breaks(outcomes.accepted_orders(order_messages(spark, sf_dir)))


# --- checks ---------------------------------------------------------------


@query
def quality_rules(spark, sf_dir):
    return checks.quality_report(stored_orders(spark, sf_dir))


@query
def referential_check(spark, sf_dir):
    known = table(spark, sf_dir, "customer").select(ids.customer_id(F.col("c_custkey")).alias("customer_id"))
    rows = classify.classify(order_messages(spark, sf_dir))
    return checks.without_customer(rows, known).select("partition", "offset", "order_id", "customer_id")


RECONCILED = ["customer_id", "customer_name", "customer_email", "items", "total_amount",
              "status", "created_at"]


@query
def reconcile(spark, sf_dir):
    produced = stored_orders(spark, sf_dir)
    stored = outcomes.accepted_orders(order_messages(spark, sf_dir))
    return checks.reconcile(produced, stored, RECONCILED)


@query
def reconcile_summary(spark, sf_dir):
    return checks.reconcile_summary(reconcile(spark, sf_dir))


# --- columns --------------------------------------------------------------


@query
def exported_orders(spark, sf_dir):
    rows = slim(spark, sf_dir)
    return rows.select("order_id", ids.export_json(with_items=False).alias("exported"))


@query
def exported_orders_with_items(spark, sf_dir):
    """P7 with the list of items."""
    return stored_orders(spark, sf_dir).select("order_id", ids.export_json().alias("exported"))


@query
def unsendable_orders(spark, sf_dir):
    """V4: orders that the producer holds back, with the reason."""
    fault = warehouse.fault_label(F.col("o_orderkey"))
    made = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(fault != "tombstone", ids.order_id(F.col("o_orderdate"), F.col("o_orderkey"))).alias("order_id"),
        F.when(fault != "no_customer", ids.customer_id(F.col("o_custkey"))).alias("customer_id"),
    )
    return topic.unsendable(made).select("o_orderkey", "order_id", "customer_id", "reason")


@query
def id_uniqueness(spark, sf_dir):
    """Rows against distinct ids of orders, customers and menu items."""
    parts = {
        "orders": table(spark, sf_dir, "orders").select(ids.order_id(F.col("o_orderdate"), F.col("o_orderkey")).alias("id")),
        "customers": table(spark, sf_dir, "customer").select(ids.customer_id(F.col("c_custkey")).alias("id")),
        "items": table(spark, sf_dir, "part").select(ids.item_id(F.col("p_partkey")).alias("id")),
    }
    return reports.id_uniqueness(parts)


@query
def display_texts(spark, sf_dir):
    rows = slim(spark, sf_dir)
    return rows.select("order_id", ids.display_text().alias("shown"), ids.debug_text().alias("debug"))


@query
def order_id_parts(spark, sf_dir):
    rows = slim(spark, sf_dir)
    return rows.select("order_id", *ids.order_id_parts(F.col("order_id")))


@query
def customer_emails(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", ids.email(F.col("c_name"), F.col("c_custkey")).alias("email"))


@query
def log_times(spark, sf_dir):
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", times.epoch_to_iso_millis(epoch).alias("logged"))


@query
def masked_urls(spark, sf_dir):
    """Page addresses with credentials put in, and masked again."""
    n = F.col("page_id").cast("string")
    login = F.concat(F.lit("$1user"), n, F.lit(":p@ss:"), n, F.lit("@"))
    given = F.regexp_replace(F.col("url"), F.lit("^([a-z]+://)"), login)
    return table(spark, sf_dir, "pages").select("page_id", "url", text.mask_password(given).alias("masked"))


# --- table maintenance ----------------------------------------------------


def _updates(spark, sf_dir) -> DataFrame:
    """Status updates: every shipped line says how far its order is."""
    lines = table(spark, sf_dir, "lineitem")
    heads = table(spark, sf_dir, "orders").select(
        "o_orderkey", ids.order_id(F.col("o_orderdate"), F.col("o_orderkey")).alias("order_id")
    )
    status = F.when(F.col("l_linestatus") == "F", "completed").otherwise("processing")
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
        "order_id", status.alias("status"), F.col("l_shipdate").alias("updated_at")
    )


@query
def status_updates(spark, sf_dir):
    """Updates applied to the stored table, which is read back."""
    target = written_table(spark, sf_dir)
    load.update_stored(spark, target, _updates(spark, sf_dir))
    return tables.read_orders(spark, target).select(*reports.LISTED)


@query
def status_asof(spark, sf_dir):
    """E2 for stored orders: the status of each 60 days after it was created, from a history merged in two steps, the later events first."""
    # made once: orders are read three times, and a merge reads its events for their months and again for their intervals
    orders = tables.stage(slim(spark, sf_dir).select("order_id", "status", "created_at"), "asof-orders")
    kept = history.History(spark, f"{run_folder(spark)}/history")
    created = orders.select("order_id", "status", F.col("created_at").alias("updated_at"))
    events = tables.stage(created.unionByName(_updates(spark, sf_dir)), "asof-events")
    late = F.col("updated_at") >= F.lit(ASOF).cast("timestamp_ntz")
    for part in (events.where(late), events.where(~late)):
        kept.merge(part)
    asked = orders.select("order_id", (F.col("created_at") + F.make_dt_interval(days=F.lit(60))).alias("asked_at"))
    return history.asof(asked, kept.read()).select("order_id", "asked_at", "status_then")


@query
def migrated_orders(spark, sf_dir):
    """Rows written before ASOF lack name and email; both forms as one table."""
    rows = slim(spark, sf_dir)
    edge = F.lit(ASOF).cast("timestamp_ntz")
    old = rows.where(F.col("created_at") < edge).drop("customer_name", "customer_email")
    new = rows.where(F.col("created_at") >= edge)
    shown = ["order_id", "customer_id", "customer_name", "customer_email", "total_amount"]
    return tables.evolve(old).unionByName(tables.evolve(new)).select(*shown)


# --- event log and structured logs ----------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


@query
def order_state_latest(spark, sf_dir):
    state = ["event_type", "value", "ts"]
    return eventlog.latest_state(_events(spark, sf_dir), "user_id", state, ["ts", "event_id"])


@query
def order_state_asof(spark, sf_dir):
    state = ["event_type", "value", "ts"]
    order = ["ts", "event_id"]
    return eventlog.state_asof(_events(spark, sf_dir), "user_id", state, order, "2024-01-15 00:00:00")


@query
def compacted_log(spark, sf_dir):
    """Last properties per user and event type; the value of an error deletes."""
    gone = F.col("event_type") == "error"
    messages = _events(spark, sf_dir).select(
        F.when(gone, F.col("user_id").cast("string"))
        .otherwise(F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")))
        .cast("binary")
        .alias("key"),
        F.when(~gone, F.col("props")).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    kept = eventlog.compact(messages)
    return kept.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset",
    )


def _log_lines(spark, sf_dir) -> DataFrame:
    """Events as the JSON lines a service would log."""
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "signup", "WARNING").otherwise("INFO")
    service = F.when(kind.isin("click", "view"), "sender").otherwise("loader")
    record = F.struct(
        times.epoch_to_iso_millis(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("timestamp"),
        level.alias("level"),
        service.alias("service"),
        F.lit("worker").alias("logger"),
        F.concat(F.lit("saw "), kind).alias("message"),
        F.when(kind != "view", ids.customer_id(F.col("user_id"))).alias("correlation_id"),
        F.struct(F.col("value").alias("processing_time_ms"), F.col("event_id").alias("n")).alias("extra"),
    )
    return _events(spark, sf_dir).select(F.to_json(record).alias("value"))


@query
def parsed_logs(spark, sf_dir):
    rows = logs.parse(_log_lines(spark, sf_dir))
    number = F.try_variant_get("extra", "$.n", "bigint").alias("n")
    return rows.select(number, "logged_at", "level", "service", "message", "correlation_id", "processing_time_ms")


@query
def rejected_log_lines(spark, sf_dir):
    """L1: lines between the records that are no JSON object."""
    n = F.col("event_id").cast("string")
    stray = F.when(F.col("event_type") == "error", F.concat(F.lit("worker stopped at "), n))
    stray = stray.when(F.col("event_type") == "signup", F.concat(F.lit('["'), n, F.lit('"]')))
    strays = _events(spark, sf_dir).select(stray.alias("value")).where("value is not null")
    return logs.rejected(_log_lines(spark, sf_dir).unionAll(strays))


@query
def error_logs(spark, sf_dir):
    rows = logs.with_level(logs.parse(_log_lines(spark, sf_dir)), "ERROR")
    return rows.select("logged_at", "service", "message", "correlation_id")


@query
def log_level_counts(spark, sf_dir):
    return logs.error_counts(logs.parse(_log_lines(spark, sf_dir)))


@query
def order_trace(spark, sf_dir):
    return logs.trace(logs.parse(_log_lines(spark, sf_dir)), "CUST-00007")


@query
def trace_summary(spark, sf_dir):
    return logs.trace_summary(logs.parse(_log_lines(spark, sf_dir)))


@query
def processing_time_percentiles(spark, sf_dir):
    """L3 from sketches stored per service and day: exact percentiles, and whether the merged sketches are within their error."""
    records = tables.stage(logs.parse(_log_lines(spark, sf_dir)).select("service", "logged_at", "processing_time_ms"), "records")
    kept = tables.stage(sketches.quantile_sketches(records, "service", F.to_date("logged_at"), "processing_time_ms"), "sketches")
    marks = {"median_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    return sketches.percentile_report(records, kept, "service", "processing_time_ms", marks)


# --- generated data -------------------------------------------------------


@query
def generated_customers(spark, sf_dir):
    """G1 for every customer number in the table."""
    return generator.customers(table(spark, sf_dir, "customer"), column="c_custkey")


def _generated(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    numbers = rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"))
    return generator.orders(numbers)


@query
def generated_orders(spark, sf_dir):
    """One generated order per order number and day in the table."""
    rows = _generated(spark, sf_dir)
    count = F.size("items").cast("bigint").alias("item_count")
    return rows.select(
        "order_id", "customer_id", "customer_name", "customer_email", count,
        "total_amount", "status", "created_at",
    )


@query
def generated_items(spark, sf_dir):
    return reports.order_items(_generated(spark, sf_dir))


@query
def generated_orders_of_pools(spark, sf_dir):
    """Other sizes of the customer pool and the menu, which goes on past its fixed items."""
    rows = table(spark, sf_dir, "orders")
    numbers = rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"))
    made = generator.orders(numbers, customer_count=POOL_CUSTOMERS, menu_size=POOL_ITEMS)
    names = F.array_join(F.transform("items", lambda i: F.concat(i["name"], F.lit(" x"), i["quantity"])), ", ")
    return made.select("order_id", "customer_id", names.alias("items"), "total_amount")


@query
def customer_draws(spark, sf_dir):
    """How evenly order numbers fall on the pool."""
    rows = table(spark, sf_dir, "orders")
    number = (draw(generator.CUSTOMERS, generator.SEED, "customer", F.col("o_orderkey")) + 1).alias("customer")
    return rows.groupBy(number).agg(F.count("*").alias("orders"))
