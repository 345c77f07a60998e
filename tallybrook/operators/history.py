"""Status of orders over time: intervals that updates are merged into, and look-ups as of a time.

An event says that an order has a status from a time on. Stored are intervals: an event with the time of the order's next event. A merge
reads the months of the updated orders only, takes their events again, adds the new ones (in any order, late ones as well, known
ones once) and writes these months anew; a list that is replaced as a whole names the folders that count.

Of several statuses an order gets at one time the greatest counts. One order may have a large share of all updates: neighbours are compared within
months of the event, and only the two ends of a month across months.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.functions.ids import order_month
from tallybrook.sinks.listing import Listing, delete_folder, folders

SHAPE = "order_id string, status string, valid_from timestamp_ntz, valid_to timestamp_ntz, order_month string"


def intervals(events: DataFrame, slot: str = "month") -> DataFrame:
    """(order_id, status, valid_from, valid_to) of events (order_id, status, updated_at); the last one of an order has no end."""
    one = events.where("order_id is not null and updated_at is not null").groupBy("order_id", "updated_at").agg(F.max("status").alias("status"))
    rows = one.withColumn("slot", F.date_trunc(slot, "updated_at"))
    within = Window.partitionBy("order_id", "slot").orderBy("updated_at")
    rows = rows.withColumn("after", F.lead("updated_at").over(within)).withColumn("edge", F.col("after").isNull() | (F.row_number().over(within) == 1))
    across = Window.partitionBy("order_id", F.when(~F.col("edge"), F.col("slot"))).orderBy("updated_at")
    return rows.select("order_id", "status", F.col("updated_at").alias("valid_from"), F.coalesce("after", F.lead("updated_at").over(across)).alias("valid_to"))


class History:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.listing = Listing(spark, f"{self.path}/_lists")

    def read(self, months: list[str] | None = None) -> DataFrame:
        parts = [p for p in self.listing.read() or [] if months is None or p["month"] in months]
        if not parts:
            return self.spark.createDataFrame([], SHAPE)
        paths = [f"{self.path}/write={p['write']}/order_month={p['month']}" for p in parts]
        shape = [c.split()[0] for c in SHAPE.split(", ")]
        return self.spark.read.schema(SHAPE).option("basePath", self.path).parquet(*paths).select(*shape)

    def merge(self, updates: DataFrame) -> None:
        """Add events (order_id, status, updated_at); merging the same ones again changes nothing."""
        placed = updates.select("order_id", "status", F.col("updated_at").cast("timestamp_ntz").alias("updated_at")).where("order_id is not null")
        months = [r[0] for r in placed.select(order_month(F.col("order_id"))).distinct().collect()]
        old = self.read(months).select("order_id", "status", F.col("valid_from").alias("updated_at"))
        made = intervals(old.unionByName(placed)).withColumn("order_month", order_month(F.col("order_id")))
        write = uuid.uuid4().hex
        laid_out = made.hint("rebalance", "order_month").sortWithinPartitions("order_month", "order_id", "valid_from")
        laid_out.write.partitionBy("order_month").parquet(f"{self.path}/write={write}")
        new = [{"write": write, "month": f.rsplit("=", 1)[1]} for f in folders(self.spark, f"{self.path}/write={write}/order_month=*")]
        before = self.listing.read() or []
        gone = [p for p in before if p["month"] in {n["month"] for n in new}]
        self.listing.replace([p for p in before if p not in gone] + new)
        for p in gone:
            delete_folder(self.spark, f"{self.path}/write={p['write']}/order_month={p['month']}")


def asof(asked: DataFrame, history: DataFrame, at: str = "asked_at") -> DataFrame:
    """Rows (order_id and a time) with the status that was valid then; null before the first event.

    Joined on the id; an order's intervals do not overlap, so a row finds one at most.
    """
    spans = history.select("order_id", F.col("status").alias("status_then"), "valid_from", "valid_to")
    when = F.col(at)
    held = (F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (when < F.col("valid_to")))
    joined = asked.join(spans, (asked["order_id"] == spans["order_id"]) & held, "left").drop(spans["order_id"])
    return joined.drop("valid_from", "valid_to")
