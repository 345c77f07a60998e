"""The loader as a restartable stream."""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tallybrook.operators.classify import MESSAGE_COLUMNS, classify
from tallybrook.operators.dedup import first_copies
from tallybrook.operators.load import batch_number, load_batch
from tallybrook.sinks.listing import folders
from tallybrook.sinks.runs import Runs
from tallybrook.sinks.tables import Target, looks_transient, overwrite_partitions, read_counters, stage, with_retry


def start_load(
    source: DataFrame,
    target: Target,
    checkpoint: str,
    every: str | None = None,
    processed_at: str | None = None,
    max_retries: int = 3,
    backoff_ms: int = 1000,
):
    """Store a log stream; returns the running query.

    Progress is committed after the tables are written, and a batch can be
    written twice without harm: each order ends up stored once. The checkpoint
    is the writer of the batches, since it numbers them. Without
    ``every`` the query stops when it has read what was there at the start.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        with_retry(
            lambda: load_batch(batch, target, batch_id, processed_at, writer=checkpoint.rstrip("/")),
            looks_transient,
            max_retries,
            backoff_ms,
        )

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = source.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def run_load(source: DataFrame, target: Target, checkpoint: str, timeout: float | None = None, **how):
    """Bounded run: until the log is read, or the time is up."""
    query = start_load(source, target, checkpoint, **how)
    finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if finished is False:
        query.stop()
    return query


def stop_after_batch(query, patience: float = 60.0) -> None:
    """Let the running batch finish, then stop; a batch cut short is run again."""
    deadline = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
        time.sleep(0.05)
    query.stop()


def first_copies_within(source: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Orders of a stream without copies that follow within ``delay``.

    State stays bounded, but a copy that comes later gets through, and Spark drops
    every row that is behind the watermark, first copies too. Where a log may come
    out of order use ``start_first_copies``, which loses none.
    """
    fit = classify(source).where("reason is null")
    late = fit.withWatermark("timestamp", delay)
    return late.dropDuplicatesWithinWatermark(["order_id"]).select(*MESSAGE_COLUMNS)


def seen_keys(spark: SparkSession, path: str, buckets: int) -> Runs:
    """Ids and times of the orders kept so far: each run is ``buckets`` files by a hash of the id, sorted by id."""
    shape = "order_id string, timestamp timestamp"
    return Runs(spark, path, shape, fold=lambda rows: rows, place=lambda rows: rows.repartition(buckets, "order_id").sortWithinPartitions("order_id"))


def start_first_copies(source: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", every: str | None = None, buckets: int = 8):
    """Store a log stream without copies that lie within ``delay`` of one kept before; no order is lost.

    Nothing is held in memory and no watermark drops late rows. Each batch asks a table of the keys kept before (``seen_keys``): only its runs
    whose times come within ``delay`` of the batch's own are opened, and of these only the row groups with ids of the batch's range.
    Finished runs are folded in levels. Copies within a batch are combined before the shuffle, so one id may fill the log.
    Of copies in different batches the one read first is kept. A batch leaves at most ``buckets`` files.
    """
    columns = list(dict.fromkeys([*MESSAGE_COLUMNS, "timestamp"]))
    seen = seen_keys(source.sparkSession, f"{path}/_seen", buckets)

    def store(batch: DataFrame, batch_id: int) -> None:
        number = batch_number(batch_id, checkpoint.rstrip("/"))
        # batches before this one are committed and never come again
        seen.fold_up(number)
        fit = first_copies(classify(batch).where("reason is null")).select(*columns)
        hour = F.floor(F.unix_seconds("timestamp") / 3600).cast("bigint")
        fresh = stage(fit.withColumn("hour", hour).withColumn("batch_id", F.lit(number).cast("bigint")), hashlib.md5(path.encode()).hexdigest())
        times = [F.unix_micros(end("timestamp")) for end in (F.min, F.max)]
        reach = F.expr(f"unix_micros(timestamp_micros(0) + interval {delay})")
        first, last, span, lo, hi = fresh.agg(*times, F.max(reach), F.min("order_id"), F.max("order_id")).first()
        if first is None:
            return
        near = [p for p in seen.parts() if not p["first"] == number == p["last"] and p["bounds"][0] <= last + span and p["bounds"][1] >= first - span]
        earlier = seen.read(near).where(F.col("order_id").between(lo, hi) & F.unix_micros("timestamp").between(first - span, last + span))
        earlier = earlier.select("order_id", F.col("timestamp").alias("seen_at"))
        near_by = F.col("seen_at").between(F.col("timestamp") - F.expr(f"interval {delay}"), F.col("timestamp") + F.expr(f"interval {delay}"))
        kept = fresh.join(earlier, (fresh["order_id"] == earlier["order_id"]) & near_by, "left_anti")
        overwrite_partitions(kept.repartition(buckets, "order_id").sortWithinPartitions("batch_id", "order_id"), path, "batch_id")
        if not folders(batch.sparkSession, f"{path}/batch_id={number}"):
            return  # all of them were copies
        written = batch.sparkSession.read.schema(fresh.schema).option("basePath", path).parquet(f"{path}/batch_id={number}")
        seen.add(written.select("order_id", "timestamp"), number, lambda rows: [first, last])

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = source.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def total_changes(spark: SparkSession, path: str) -> Runs:
    """Totals of the customers that a batch changed, one run for each batch; folding keeps the last total of a customer."""

    def last(rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct("orders", "total_spent", "batch_id"), "batch_id").alias("last")
        return rows.groupBy("customer_id").agg(newest).select("customer_id", "last.*")

    shape = "customer_id string, orders bigint, total_spent decimal(38,2), batch_id bigint"
    return Runs(spark, path, shape, fold=last, place=lambda rows: rows.hint("rebalance", "customer_id").sortWithinPartitions("customer_id"))


def start_totals(stored: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Running orders and revenue per customer, from a stream of stored orders.

    Each batch adds the customers it changed; ``latest_totals`` reads them. Older batches are folded in levels, so it
    opens as many runs as the logarithm of the batches says, however long the stream has been running.
    """
    totals = stored.groupBy("customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("total_amount").cast("decimal(38,2)").alias("total_spent"),
    )
    changes = total_changes(stored.sparkSession, path)

    def append(changed: DataFrame, batch_id: int) -> None:
        changes.fold_up(batch_id)
        changes.add(changed.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = totals.writeStream.outputMode("update").foreachBatch(append)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    changes = total_changes(spark, path)
    return changes.fold(changes.read()).drop("batch_id")


def live_outcomes(spark: SparkSession, target: Target) -> DataFrame:
    """Messages per outcome and reason of everything a target has taken in, while its stream may be running.

    A batch's figures are observed as it is written and are in the table when it is complete; nothing is kept in the driver.
    """
    return read_counters(spark, target).groupBy("outcome", "reason").agg(F.sum("messages").alias("messages"))


class Progress(StreamingQueryListener):
    """Figures of every query of a session: the last batches one by one, all of them as totals."""

    def __init__(self, keep: int = 100):
        self.keep = keep
        self.batches: list[dict] = []
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        figures = {
            "query": p.name or str(p.id),
            "batch_id": p.batchId,
            "rows": p.numInputRows,
            "input_rate": p.inputRowsPerSecond,
            "processed_rate": p.processedRowsPerSecond,
            "milliseconds": p.batchDuration,
        }
        self.batches = [*self.batches, figures][-self.keep :]
        sums = self.totals.setdefault(figures["query"], {"batches": 0, "rows": 0, "milliseconds": 0})
        for name, more in (("batches", 1), ("rows", p.numInputRows), ("milliseconds", p.batchDuration)):
            sums[name] += more

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
