"""Outcome of every message of a log, duplicates included, and its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.classify import MESSAGE_COLUMNS, classify, outcome_of
from tallybrook.operators.dedup import first_copies, mark_copies
from tallybrook.schemas import ENVELOPE


def outcomes(envelopes: DataFrame) -> DataFrame:
    """One row per message with its outcome and reason, for an empty target."""
    judged = classify(envelopes)
    marked = mark_copies(judged, "order_id", F.col("reason").isNull())
    final = F.when(F.col("is_copy"), "duplicate").otherwise(F.col("reason"))
    return (
        marked.withColumn("reason", final)
        .withColumn("outcome", outcome_of(F.col("reason")))
        .drop("is_copy")
    )


def accepted_orders(envelopes: DataFrame) -> DataFrame:
    """Orders a log leads to, each once, with the place of the copy that won."""
    fit = classify(envelopes).where("reason is null")
    return first_copies(fit).select(*MESSAGE_COLUMNS, "order_month", "partition", "offset")


def reason_counts(envelopes: DataFrame) -> DataFrame:
    """Messages per outcome and reason.

    Duplicates are counted, not marked: they are the fit messages beyond the
    first of each id, so one row per id (not one per message) is shuffled.
    """
    judged = classify(envelopes).select("order_id", "reason")
    fit_key = F.when(F.col("reason").isNull(), F.col("order_id"))
    per_key = judged.groupBy("reason", fit_key.alias("fit_id")).agg(F.count("*").alias("n"))
    per_reason = per_key.groupBy("reason").agg(
        F.sum("n").alias("messages"),
        F.count("fit_id").alias("ids"),
    )
    fit = F.col("reason").isNull()
    stored = F.struct(F.lit(None).cast("string").alias("reason"), F.col("ids").alias("n"))
    copies = F.struct(F.lit("duplicate").alias("reason"), (F.col("messages") - F.col("ids")).alias("n"))
    other = F.struct(F.col("reason").alias("reason"), F.col("messages").alias("n"))
    rows = F.when(fit, F.array(stored, copies)).otherwise(F.array(other))
    return (
        per_reason.select(F.explode(rows).alias("r"))
        .where("r.n > 0")
        .select(
            outcome_of(F.col("r.reason")).alias("outcome"),
            F.coalesce("r.reason", F.lit("")).alias("reason"),
            F.col("r.n").alias("messages"),
        )
    )


def quarantine(envelopes: DataFrame) -> DataFrame:
    """Messages that failed or broke a constraint, with the raw value."""
    return (
        classify(envelopes)
        .where("reason is not null")
        .select(*ENVELOPE.names, "order_id", "missing_fields", "reason",
                outcome_of(F.col("reason")).alias("outcome"))
    )
