"""How far a stream has come, from its own checkpoint: offset, commit and source logs as tables.

The checkpoint is the truth about a stream that may be running, stopped or dead; nothing has to listen to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.sinks.listing import folders


def _logged(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """(batch_id, line) of one of the checkpoint's logs; compacted files count under their number."""
    if not folders(spark, f"{checkpoint}/{name}/[0-9]*"):
        return spark.createDataFrame([], "batch_id bigint, line string")
    lines = spark.read.text(f"{checkpoint}/{name}/[0-9]*")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)(\.compact)?$", 1).cast("bigint")
    return lines.select(number.alias("batch_id"), F.col("value").alias("line"))


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    return _logged(spark, checkpoint, "commits").agg(F.max("batch_id")).first()[0]


def committed_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(topic, partition, committed) of a broker's topic: where the last committed batch ended."""
    last = last_committed(spark, checkpoint)
    lines = _logged(spark, checkpoint, "offsets").where((F.col("batch_id") == F.lit(last)) & F.col("line").startswith('{"'))
    topics = lines.select(F.explode(F.from_json("line", "map<string,map<string,bigint>>")).alias("topic", "ends"))
    return topics.select("topic", F.explode("ends").alias("partition", "committed")).select("topic", F.col("partition").try_cast("int").alias("partition"), "committed").where("partition is not null")


def committed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(path) of the files of a file stream that committed batches have read."""
    last = last_committed(spark, checkpoint)
    offsets = _logged(spark, checkpoint, "offsets").where(F.col("batch_id") == F.lit(last))
    position = offsets.select(F.get_json_object("line", "$.logOffset").cast("bigint").alias("at")).where("at is not null").agg(F.max("at")).first()[0]
    entries = _logged(spark, checkpoint, f"sources/{source}").select(F.from_json("line", "path string, batchId bigint").alias("e"))
    return entries.where(F.col("e.batchId") <= F.lit(position)).select(F.col("e.path").alias("path")).distinct()


def file_stream_lag(log: DataFrame, checkpoint: str) -> DataFrame:
    """Per topic and partition: messages of the log, and how many of them no committed batch has read.

    log: the files of the stream, read as a table. Files are matched by name, messages only counted.
    """
    done = committed_files(log.sparkSession, checkpoint).select(F.url_decode(F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")).alias("file"), F.lit(True).alias("read"))
    name = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"^[a-z0-9]+:/+", "/"))
    counts = log.select("topic", "partition", "offset", name.alias("file")).groupBy("topic", "partition", "file").agg(F.count("*").alias("n"), F.max("offset").alias("last"))
    marked = counts.join(done, "file", "left")
    return marked.groupBy("topic", "partition").agg(
        F.sum("n").alias("messages"),
        (F.max("last") + 1).alias("log_end"),
        F.sum(F.when(F.col("read").isNull(), F.col("n")).otherwise(0)).alias("lag"),
    )
