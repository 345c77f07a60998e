"""Analysis of structured logs: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators.decode import field, parse_objects, settle

LOG_TEXTS = ["timestamp", "level", "service", "logger", "message", "correlation_id", "exception"]


def parse(lines: DataFrame, text: str = "value") -> DataFrame:
    """Typed log records; lines that are no JSON object are found by ``rejected``.

    ``extra`` keeps the free fields as VARIANT.
    """
    docs = parse_objects(lines.select(F.col(text).alias("text")))
    record = docs.select(
        "is_object",
        *[field(name, "string").alias(name) for name in LOG_TEXTS],
        field("extra").alias("extra"),
        field("extra.processing_time_ms", "double").alias("processing_time_ms"),
    )
    logged_at = F.col("timestamp").try_cast("timestamp").cast("timestamp_ntz")
    return settle(record.withColumn("logged_at", logged_at)).where("is_object").drop("is_object")


def rejected(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines that ``parse`` leaves out, as they are; null lines too."""
    docs = parse_objects(lines.select(F.col(text).alias("line")), "line")
    return docs.where(~F.coalesce("is_object", F.lit(False))).select("line")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Log records from folders of JSON-lines files."""
    return parse(spark.read.text(path))


def with_level(records: DataFrame, *levels: str) -> DataFrame:
    return records.where(F.col("level").isin(*levels))


def error_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("service", "level").agg(F.count("*").alias("records"))


def trace(records: DataFrame, correlation_id: str) -> DataFrame:
    """One order's way through the services, in time order."""
    steps = records.where(F.col("correlation_id") == correlation_id)
    return steps.select("logged_at", "service", "level", "message", "processing_time_ms").orderBy(
        "logged_at", "service", "message"
    )


def trace_summary(records: DataFrame) -> DataFrame:
    """Per order: steps, services, first and last time, errors, processing time.

    Only combining aggregates, since one id may hold any share of the log; the
    steps themselves are listed by ``trace``.
    """
    took = F.col("processing_time_ms")
    return (
        records.where("correlation_id is not null")
        .groupBy("correlation_id")
        .agg(
            F.count("*").alias("steps"),
            F.min("logged_at").alias("first_at"),
            F.max("logged_at").alias("last_at"),
            F.min("service").alias("first_service"),
            F.max("service").alias("last_service"),
            F.sum(F.when(F.col("level") == "ERROR", 1).otherwise(0)).alias("errors"),
            F.min(took).alias("fastest_ms"),
            F.max(took).alias("slowest_ms"),
        )
    )


def processing_time_percentiles(records: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Median, 95th and 99th percentile of the processing time per service, by sketch."""
    marks = F.percentile_approx("processing_time_ms", [0.5, 0.95, 0.99], accuracy)
    known = records.where("processing_time_ms is not null")
    stats = known.groupBy("service").agg(F.count("*").alias("records"), marks.alias("m"))
    names = ["median_ms", "p95_ms", "p99_ms"]
    return stats.select("service", "records", *[F.col("m")[i].alias(n) for i, n in enumerate(names)])
