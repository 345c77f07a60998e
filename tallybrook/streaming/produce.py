"""Orders as a stream of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.schemas import ENVELOPE
from tallybrook.sinks.topic import messages
from tallybrook.sources import generator


def order_stream(spark: SparkSession, rate: int = 10, **how) -> DataFrame:
    """Endless messages of synthetic orders at a steady rate."""
    return messages(generator.orders(generator.rate_numbers(spark, rate), **how))


def order_batch(spark: SparkSession, count: int, start: str, rate: float = 10.0, **how) -> DataFrame:
    """The messages of a bounded run: ``count`` orders at ``rate`` a second."""
    return messages(generator.orders(generator.numbered(spark, count, start, rate), **how))


def run_batch(spark: SparkSession, rate: int, seconds: int, start: str, **how) -> DataFrame:
    """What a run of the given length would send."""
    return order_batch(spark, rate * seconds, start, rate, **how)


def as_log(spark: SparkSession, count: int, start: str, rate: float = 10.0, **how) -> DataFrame:
    """The same as envelope rows, the order number serving as offset."""
    numbers = generator.numbered(spark, count, start, rate)
    made = generator.orders(numbers, **how)
    sent = messages(made)
    ordinal = F.regexp_extract(F.get_json_object(F.col("value").cast("string"), "$.order_id"), r"(\d+)$", 1)
    created = F.get_json_object(F.col("value").cast("string"), "$.created_at")
    return sent.withColumn("offset", ordinal.cast("bigint")).withColumn(
        "timestamp", created.cast("timestamp")
    ).select(*ENVELOPE.names)


def start_files(sent: DataFrame, path: str, checkpoint: str, every: str = "1 second"):
    """Send a stream of messages to a folder instead of a broker."""
    writer = sent.writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
