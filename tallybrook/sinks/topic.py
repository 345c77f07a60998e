"""Orders as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.sources.warehouse import PARTITIONS, TOPIC, log_partition

# How messages are sent.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "10",
    "kafka.batch.num.messages": "10000",
}


def sendable() -> Column:
    """A message needs an order id and, as its key, a customer id."""
    return F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()


def messages(orders: DataFrame, topic: str = TOPIC, partitions: int = PARTITIONS) -> DataFrame:
    """Key, JSON value, topic and partition of every order that can be sent.

    The partition is set here, by the CRC-32 of the key: left to itself the
    sink would hash differently and move every key.
    """
    return orders.where(sendable()).select(
        F.col("customer_id").cast("binary").alias("key"),
        F.to_json(F.struct(*orders.columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        log_partition(F.col("customer_id"), partitions).alias("partition"),
    )


def unsendable(orders: DataFrame) -> DataFrame:
    reason = F.when(F.col("order_id").isNull(), "no_order_id").otherwise("no_customer_id")
    return orders.where(~sendable()).withColumn("reason", reason)


def kafka_write_options(brokers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, **PRODUCER_OPTIONS}


def write_kafka(sent: DataFrame, brokers: str) -> None:
    sent.write.format("kafka").options(**kafka_write_options(brokers)).save()


def stream_kafka(sent: DataFrame, brokers: str, checkpoint: str):
    """Start sending; Spark's sink delivers at least once, the loader drops copies."""
    options = kafka_write_options(brokers)
    writer = sent.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
