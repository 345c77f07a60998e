"""Reading and writing of ISO-8601 times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A bare cast takes more than a message may say: "14:30:00" would mean today.
_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)?"
_DAY = r"\d{4}-\d{2}-\d{2}"
EXTENDED = rf"^{_DAY}([T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d+)?{_OFFSET})?\z"
COMMA = rf"^{_DAY}[T ]\d{{2}}:\d{{2}}:\d{{2}},\d+{_OFFSET}\z"
TO_MINUTE = rf"^{_DAY}[T ]\d{{2}}:\d{{2}}{_OFFSET}\z"
TO_HOUR = rf"^{_DAY}[T ]\d{{2}}{_OFFSET}\z"
BASIC = rf"^\d{{8}}T\d{{6}}{_OFFSET}\z"


def utc_wall_clock(text: Column) -> Column:
    """ISO-8601 text to a UTC wall-clock time, null where it is not one.

    Offsets are honoured and times without one are taken as UTC.
    """
    shaped = (
        F.when(text.rlike(EXTENDED), text)
        .when(text.rlike(COMMA), F.replace(text, F.lit(","), F.lit(".")))
        .when(text.rlike(TO_MINUTE), F.regexp_replace(text, r"^(.{16})", "$1:00"))
        .when(text.rlike(TO_HOUR), F.regexp_replace(text, r"^(.{13})", "$1:00:00"))
        .when(
            text.rlike(BASIC),
            F.regexp_replace(
                text, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})", "$1-$2-$3T$4:$5:$6"
            ),
        )
    )
    return shaped.try_cast("timestamp").cast("timestamp_ntz")


def iso_seconds(ts: Column) -> Column:
    """``2025-01-10T14:30:00``, with microseconds only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fine = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(ts == F.date_trunc("second", ts), whole).otherwise(fine)


def epoch_to_iso_millis(epoch_seconds: Column) -> Column:
    """Unix time to ``2025-01-10T14:30:00.123Z``, cut (not rounded) to milliseconds."""
    micros = F.round(epoch_seconds * 1_000_000).cast("bigint")
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)
