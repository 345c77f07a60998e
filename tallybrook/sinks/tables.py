"""The stored tables: orders, quarantine and batch counters.

Quarantine and counters are Parquet folders partitioned by the batch that wrote them and written with dynamic partition
overwrite, so writing a batch again replaces exactly what it wrote before.

Orders lie in a folder for each write, month and batch. A list, replaced as a whole, names the folders that count: batches, updates,
compaction and retention first write new folders, then switch the list, then delete what it no longer names. A reader sees the table before
or after such a step, and a job that dies in between loses nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.clustering import interleaved, scaled, within_month
from tallybrook.schemas import ENVELOPE, ORDERS, ORDERS_STORED
from tallybrook.session import own_shuffles_dropped, shared_dir
from tallybrook.sinks.listing import Listing, delete_folder, folders

QUARANTINE = T.StructType(
    [
        *ENVELOPE.fields,
        T.StructField("order_id", T.StringType()),
        T.StructField("missing_fields", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
COUNTERS = T.StructType(
    [
        T.StructField("outcome", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Target:
    """Folders of one set of stored tables."""

    root: str

    @property
    def orders(self) -> str:
        return f"{self.root}/orders"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def counters(self) -> str:
        return f"{self.root}/counters"


def create_tables(spark: SparkSession, target: Target) -> None:
    """Create what is not there yet; existing tables stay as they are."""
    for path, schema in ((target.quarantine, QUARANTINE), (target.counters, COUNTERS)):
        spark.createDataFrame([], schema).write.mode("ignore").partitionBy("batch_id").parquet(path)


@dataclass(frozen=True)
class Part:
    """A folder of stored orders; ``first`` and ``last`` bound the times of creation in it, where they are known.

    The month is that of the id. An order may be created at another time than its id says, so times have bounds of their own.
    """

    write: str
    month: str
    batch: int
    first: str | None = None
    last: str | None = None

    def may_hold(self, start: str | None, end: str | None) -> bool:
        return (start is None or self.last is None or self.last >= start) and (end is None or self.first is None or self.first <= end)

    def path(self, target: Target) -> str:
        return f"{target.orders}/write={self.write}/order_month={self.month}/batch_id={self.batch}"


def order_parts(spark: SparkSession, target: Target) -> list[Part]:
    """The folders that count, one for each month and batch."""
    return [Part(**p) for p in Listing(spark, f"{target.orders}/_lists").read() or []]


def switch_parts(spark: SparkSession, target: Target, gone: Callable[[Part], bool], new: list[Part]) -> None:
    """From now on ``new`` counts instead of the parts that ``gone`` picks; then those are deleted."""
    listing = Listing(spark, f"{target.orders}/_lists")
    before = order_parts(spark, target)
    old = [p for p in before if gone(p)]
    listing.replace([vars(p) for p in before if p not in old] + [vars(p) for p in new])
    for part in old:
        delete_folder(spark, part.path(target))


def sweep_orders(spark: SparkSession, target: Target) -> int:
    """Delete folders that no list names, which a job left that died; their number. Not while a load is running."""
    named = {p.path(target) for p in order_parts(spark, target)}
    left = [f for f in folders(spark, f"{target.orders}/write=*/order_month=*/batch_id=*") if not any(n.endswith(f) for n in named)]
    for path in left:
        delete_folder(spark, path)
    return len(left)


def read_orders(spark: SparkSession, target: Target, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored orders; columns that older files lack are null.

    With ``start`` and ``end`` (texts like 2025-01-10 or 2025-01-10 14:30:00) folders are left out that hold no order created in between;
    which of the rest are wanted is the caller's filter.
    """
    return read_parts(spark, target, [p for p in order_parts(spark, target) if p.may_hold(start, end)])


def read_parts(spark: SparkSession, target: Target, parts: list[Part]) -> DataFrame:
    paths = [p.path(target) for p in parts]
    if not paths:
        return spark.createDataFrame([], ORDERS_STORED)
    return spark.read.schema(ORDERS_STORED).option("basePath", target.orders).parquet(*paths).select(*ORDERS_STORED.names)


def read_quarantine(spark: SparkSession, target: Target) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(target.quarantine)


def read_counters(spark: SparkSession, target: Target) -> DataFrame:
    return spark.read.schema(COUNTERS).parquet(target.counters)


# Tables take less of the disk that way than by Spark's usual codec.
SMALL = {"compression": "zstd"}


def overwrite_partitions(df: DataFrame, path: str, *parts: str, **options: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with own_shuffles_dropped(df.sparkSession):
        writer.options(**{**SMALL, **options}).partitionBy(*parts).parquet(path)


# Row groups of moderate size, so that their bounds leave out more.
ORDER_OPTIONS = {**SMALL, "parquet.block.size": str(16 << 20)}
# Bloom filters are made where files are made for good.
BLOOM = {"parquet.bloom.filter.enabled#order_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def customer_number(customer: str = "customer_id"):
    """The digits at the end of a customer id, as a number; null where there are none."""
    return F.regexp_extract(customer, r"(\d{1,15})$", 1).try_cast("double")


def packed(rows: DataFrame) -> DataFrame:
    """Rows that leave ``items_json`` out where it is the text of the typed items (``_text`` is true there), so that it need not travel with them."""
    same = F.col("items_json").eqNullSafe(F.to_json("items")) & F.col("items").isNotNull()
    return rows.withColumn("_text", same).withColumn("items_json", F.when(~F.col("_text"), F.col("items_json")))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("items_json", F.when(F.col("_text"), F.to_json("items")).otherwise(F.col("items_json"))).drop("_text")


def write_orders(
    orders: DataFrame, target: Target, largest_customer: float = 1e5, observed=None, bounds: dict[str, tuple] | None = None, **options: str
) -> list[Part]:
    """Write rows that carry their ``order_month`` and ``batch_id``; the new folders, which no list names yet.

    bounds: first and last time of creation in a month. Rows without ``items_json`` get the text of their typed items, behind the shuffle
    and the sort, so that it travels with neither; nor does a text that ``packed`` rows leave out.

    Rebalancing gathers each month into few files and still splits a large
    month over many tasks. Rows lie by customer and time of the month in turn (``interleaved``), so bounds of row groups and pages leave out
    most of a month for a customer as well as for a range of time; an order id begins with its day.
    """
    write = uuid.uuid4().hex
    carried = [c for c in (*ORDERS_STORED.names, "_text") if c in (*orders.columns, *ORDERS.names)]
    gathered = orders.select(*carried).hint("rebalance", F.col("order_month"))
    key = interleaved(scaled(customer_number(), 0, largest_customer), within_month(F.col("created_at")))
    rows = gathered.withColumn("_near", key).sortWithinPartitions("order_month", "batch_id", "_near", "order_id").drop("_near")
    if "_text" in carried:
        rows = unpacked(rows)
    elif "items_json" not in carried:
        rows = rows.withColumn("items_json", F.to_json("items"))
    rows = rows.select(*ORDERS_STORED.names)
    if observed is not None:
        # behind the last shuffle, where no task is counted twice
        rows = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
    path = f"{target.orders}/write={write}"
    with own_shuffles_dropped(orders.sparkSession):
        rows.write.options(**{**ORDER_OPTIONS, **options}).partitionBy("order_month", "batch_id").parquet(path)
    made = folders(orders.sparkSession, f"{path}/order_month=*/batch_id=*")
    named = [[x.split("=", 1)[1] for x in f.rsplit("/", 2)[1:]] for f in made]
    return [Part(write, month, int(batch), *(bounds or {}).get(month, ())) for month, batch in named]


def stage(df: DataFrame, name: str, *parts: str, compression: str = "zstd") -> DataFrame:
    """Write a table into the shared folder and read it back.

    Later steps start from the files, so a lost executor does not set the work
    back to the log, and the shuffle files behind it go at once. Every run has a folder of its own below the name, so rows of
    an earlier run cannot come back.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stages/{name}/{uuid.uuid4().hex}"
    with own_shuffles_dropped(spark):
        df.write.option("compression", compression).partitionBy(*parts).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[..., DataFrame]]:
    """``stage`` for tables that nobody reads after the block: their files go with it."""
    folder = f"{name}/{uuid.uuid4().hex}"
    try:
        yield lambda df, **how: stage(df, folder, **how)
    finally:
        delete_folder(spark, f"{shared_dir(spark)}/stages/{folder}")


def evolve(old: DataFrame, schema: T.StructType = ORDERS) -> DataFrame:
    """Rows of an older form of the table in today's columns, new ones null."""
    return old.select(
        *[
            (F.col(f.name) if f.name in old.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def roll_back(new: DataFrame, dropped: list[str]) -> DataFrame:
    return new.drop(*dropped)


def unexpired(orders: DataFrame, first_month: str) -> DataFrame:
    """Orders of the months kept; the folders of older ones are not read."""
    return orders.where(F.col("order_month") >= F.lit(first_month))


def drop_months(spark: SparkSession, target: Target, first_month: str) -> list[str]:
    """Retention: months before ``first_month`` go for good; ids without a month stay. The months that went."""
    old = lambda p: p.month.isdigit() and p.month < first_month
    gone = sorted({p.month for p in order_parts(spark, target) if old(p)})
    if gone:
        switch_parts(spark, target, old, [])
    return gone


def with_retry(
    work: Callable[[], None],
    transient: Callable[[Exception], bool],
    max_retries: int = 3,
    backoff_ms: int = 1000,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run a write, again after transient errors, waiting twice as long each time.

    Returns the attempts used. The last error is raised: the batch fails and
    the stream does not move on, so nothing is lost.
    """
    for attempt in range(max_retries):
        try:
            work()
            return attempt + 1
        except Exception as error:
            if attempt + 1 == max_retries or not transient(error):
                raise
            sleep(backoff_ms * 2**attempt / 1000)
    raise ValueError("max_retries must be at least 1")


# Java errors of a storage or network that may be back in a moment.
TRANSIENT_MARKS = (
    "java.net.",
    "java.io.IOException",
    "SQLTransient",
    "SQLRecoverable",
    "TimeoutException",
)


def looks_transient(error: Exception) -> bool:
    return any(mark in str(error) for mark in TRANSIENT_MARKS)


def latest_updates(updates: DataFrame) -> DataFrame:
    """Last status per order, from (order_id, status, updated_at)."""
    last = F.max_by("status", F.struct("updated_at", "status")).alias("new_status")
    return updates.groupBy("order_id").agg(last)


def apply_updates(orders: DataFrame, updates: DataFrame) -> DataFrame:
    """Orders with their status replaced where there is an update."""
    joined = orders.join(latest_updates(updates), "order_id", "left")
    replaced = joined.withColumn("status", F.coalesce("new_status", "status"))
    return replaced.select(*orders.columns)
