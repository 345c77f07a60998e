"""Log envelopes to typed message fields.

Messages are read as VARIANT, not with a fixed JSON schema, because the rules
need to tell a missing key from an explicit null and a number from a text that
looks like one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import utc_wall_clock
from tallybrook.schemas import ENVELOPE, REQUIRED_FIELDS

_ITEMS = (
    "array<struct<item_id:string,name:string,quantity:int,"
    "price:decimal(10,2),subtotal:decimal(10,2)>>"
)
TEXT_FIELDS = [f for f in REQUIRED_FIELDS if f not in ("items", "total_amount", "created_at")]


def field(name: str, target: str = "variant") -> Column:
    """One key of the message; null where it is missing or of another type."""
    return F.try_variant_get("doc", f"$[0].{name}", target)


def kind(value: Column) -> Column:
    """JSON type of a scalar VARIANT, such as BIGINT, DECIMAL(4,2) or STRING."""
    return F.schema_of_variant(value)


def parse_objects(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``whole`` (the text is one JSON value), ``is_object`` and ``doc``.

    The parser ignores what follows the first value. So the text is parsed as
    the first of two array elements, the second being a hash of the text: that
    hash turns up in second place only if the text was exactly one value.
    ``doc`` is that pair, null unless the value is an object; ``field`` reads it.
    """
    sealed = F.concat(F.lit("["), F.col(text), F.lit(","), F.col("_seal").cast("string"), F.lit("]"))
    kept = F.try_variant_get("_pair", "$[1]", "bigint") == F.col("_seal")
    return (
        df.withColumn("_seal", F.xxhash64(text))
        .withColumn("_pair", F.try_parse_json(sealed))
        .withColumn("whole", F.coalesce(kept, F.lit(False)))
        .withColumn("is_object", F.col("whole") & F.col(text).rlike(r"^\s*\{"))
        .withColumn("doc", F.when(F.col("is_object"), F.col("_pair")))
        .drop("_seal", "_pair")
    )


def decode(envelopes: DataFrame) -> DataFrame:
    """Add the message as text and as VARIANT."""
    shown = envelopes.select(*ENVELOPE.names, F.col("value").cast("string").alias("text"))
    # the JSON parser would replace bad bytes without a word
    return parse_objects(shown.withColumn("valid_utf8", F.is_valid_utf8("text")))


def typed_fields(decoded: DataFrame) -> DataFrame:
    """Typed message fields beside the VARIANT, which is kept for the rules."""
    # money is rounded half up to cents and null when it does not fit; whole
    # numbers are exact, others go by the shortest text of the double
    cents = F.col("amount_raw").cast("string").try_cast("decimal(10,2)")
    amount = F.when(F.col("amount_kind") == "BIGINT", field("total_amount", "decimal(10,2)"))
    return (
        decoded.select(
            "*",
            *[field(f, "string").alias(f) for f in TEXT_FIELDS],
            field("items", _ITEMS).alias("items"),
            kind(field("total_amount")).alias("amount_kind"),
            field("total_amount", "double").alias("amount_raw"),
            # no JSON number, list or object reads like a time
            field("created_at", "string").alias("created_text"),
        )
        .withColumn("total_amount", amount.otherwise(cents))
        .withColumn("created_at", utc_wall_clock(F.col("created_text")))
    )


def settle(df: DataFrame) -> DataFrame:
    """The same rows, evaluated once.

    Filters are otherwise pushed below the projections that compute their
    columns, and every message would be parsed again in each condition.
    Filters do not pass a generator whose output they use.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def extract_order_id(envelopes: DataFrame) -> DataFrame:
    """Order id of every raw message, null on any failure."""
    return decode(envelopes).select(*ENVELOPE.names, field("order_id", "string").alias("order_id"))
