"""Log sources. Each gives rows of the envelope schema.

The broker adapters only build options: without a connector at hand they are
checked by their options alone and have not been run against a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.schemas import ENVELOPE
from tallybrook.sinks.listing import move_folder


def kafka_options(
    brokers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a stream on one topic.

    ``min_partitions`` lets several tasks share one large topic partition;
    ``max_offsets`` bounds a micro-batch.
    """
    if starting not in ("earliest", "latest") and not starting.startswith("{"):
        raise ValueError("starting must be earliest, latest or a JSON offset map")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_range_options(
    brokers: str, topic: str, starting: str = "earliest", ending: str = "latest"
) -> dict[str, str]:
    """Options of a bounded read: a replay from any offset still retained."""
    if starting == "latest":
        raise ValueError("a bounded read cannot start at latest")
    return {**kafka_options(brokers, topic, starting), "endingOffsets": ending}


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_options(**options))
    return reader.load().select(*ENVELOPE.names)


def kafka_range(spark: SparkSession, **options) -> DataFrame:
    reader = spark.read.format("kafka").options(**kafka_range_options(**options))
    return reader.load().select(*ENVELOPE.names)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def arrive(spark: SparkSession, made: str, path: str) -> None:
    """Put a folder of envelopes where a stream reads; an empty one where none was made."""
    if not move_folder(spark, made, path):
        spark.createDataFrame([], ENVELOPE).write.parquet(path)


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Envelope rows as files arrive; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
