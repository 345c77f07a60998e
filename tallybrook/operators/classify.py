"""Outcome and reason of each message; the first rule that applies decides.

=====  ========================================  =======  ================
order  condition                                 outcome  reason
=====  ========================================  =======  ================
1      no value                                  failed   tombstone
2      not UTF-8                                 failed   bad_utf8
3      not one whole JSON value                  failed   undecodable
4      JSON, but not an object                   failed   not_object
5      a required key is missing                 failed   missing_fields
6      items not a list, or empty                failed   bad_items
7      amount not a number, or not above zero    failed   bad_amount
8      amount is ``true``                        failed   bad_amount_type
9      created_at not an ISO-8601 text           failed   bad_timestamp
10     a text holds an object or a list          failed   bad_text_type
11     text too long, or amount too large        failed   out_of_range
12     null in a column that may not be null     skipped  null_violation
13     amount rounds to zero                     skipped  check_violation
14     order stored before (see ``dedup``)       skipped  duplicate
15     otherwise                                 processed
=====  ========================================  =======  ================
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.ids import order_month
from tallybrook.operators.decode import TEXT_FIELDS, decode, field, kind, settle, typed_fields
from tallybrook.schemas import ENVELOPE, MAX_LENGTH, ORDERS, REQUIRED_FIELDS

REASONS = [
    "tombstone", "bad_utf8", "undecodable", "not_object", "missing_fields", "bad_items", "bad_quantity", "bad_amount", "bad_amount_type",
    "bad_timestamp", "bad_text_type", "out_of_range", "null_violation", "check_violation",
]
SKIPPED_REASONS = ["null_violation", "check_violation", "duplicate"]
# typed message columns, in table order, without the load time
MESSAGE_COLUMNS = [c for c in ORDERS.names if c != "processed_at"]


def missing_fields() -> Column:
    """Names of the required keys an object does not carry, comma separated."""
    typed = {**{f: F.col(f) for f in TEXT_FIELDS}, "created_at": F.col("created_text")}
    names = []
    for f in REQUIRED_FIELDS:
        # a typed value proves the key is there; only a null needs another look
        gone = field(f).isNull()
        names.append(F.when(typed[f].isNull() & gone if f in typed else gone, F.lit(f)))
    return F.when(F.col("is_object"), F.concat_ws(",", *names))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _nested(name: str) -> Column:
    # the costly type question is put only to a text that starts like one
    looks = F.substring(name, 1, 1).isin("{", "[")
    return F.when(looks, kind(field(name)).rlike("^(OBJECT|ARRAY)")).otherwise(False)


def reason(check_quantity: bool = False) -> Column:
    """Reason of the first rule that applies, null for a message fit to store."""
    number = F.col("amount_kind").rlike("^(BIGINT|DECIMAL|DOUBLE)")
    is_true = (F.col("amount_kind") == "BOOLEAN") & (F.col("amount_raw") > 0)
    lengths = [F.coalesce(F.char_length(f) > n, F.lit(False)) for f, n in MAX_LENGTH.items()]
    rules = [
        (F.col("value").isNull(), "tombstone"),
        (~F.col("valid_utf8"), "bad_utf8"),
        (~F.col("whole"), "undecodable"),
        (~F.col("is_object"), "not_object"),
        (F.col("missing_fields") != "", "missing_fields"),
        (F.coalesce(F.size("items"), F.lit(0)) <= 0, "bad_items"),
        (~is_true & (~number | ~(F.col("amount_raw") > 0)), "bad_amount"),
        (is_true, "bad_amount_type"),
        (F.col("created_at").isNull(), "bad_timestamp"),
        (_any([_nested(f) for f in TEXT_FIELDS]), "bad_text_type"),
        (_any(lengths) | F.col("total_amount").isNull(), "out_of_range"),
        (_any([F.col(f).isNull() for f in TEXT_FIELDS]), "null_violation"),
        (F.col("total_amount") <= 0, "check_violation"),
    ]
    if check_quantity:
        all_positive = F.forall("items", lambda i: F.coalesce(i["quantity"] > 0, F.lit(False)))
        rules.insert(6, (~all_positive, "bad_quantity"))
    first, *rest = rules
    return reduce(lambda chain, rule: chain.when(rule[0], rule[1]), rest, F.when(*first))


def outcome_of(reason_col: Column) -> Column:
    return (
        F.when(reason_col.isNull(), "processed")
        .when(reason_col.isin(SKIPPED_REASONS), "skipped")
        .otherwise("failed")
    )


def classify(envelopes: DataFrame, check_quantity: bool = False, whole_items: bool = False) -> DataFrame:
    """Decode and judge every message on its own; no shuffle.

    Duplicates are found across messages, by ``operators.dedup``. With
    ``whole_items`` the items come as JSON text too (``items_json``): every key and
    element as sent, keys sorted and numbers without trailing zeros.
    """
    judged = (
        typed_fields(decode(envelopes))
        .withColumn("missing_fields", missing_fields())
        .withColumn("reason", reason(check_quantity))
    )
    month = order_month(F.col("order_id")).alias("order_month")
    whole = [field("items").alias("items_json")] if whole_items else []
    settled = settle(judged.select(*ENVELOPE.names, *MESSAGE_COLUMNS, *whole, "missing_fields", "reason"))
    # neither needs a parse; within the fused code of the parse they would make a method too long for the JVM to compile
    later = {"items_json": F.to_json("items_json").alias("items_json")}
    return settled.select(*[later.get(c, F.col(c)) for c in settled.columns[:-2]], month, "missing_fields", "reason")


def parse_lenient(envelopes: DataFrame) -> DataFrame:
    """The parser without the pipeline's rules.

    Items may be empty or an object (they come back as JSON text), a missing
    status means pending, and an amount may be a text that spells a number.
    Messages that cannot be parsed at all have ``parsed`` false.
    """
    needed = [f for f in REQUIRED_FIELDS if f != "status"]
    text_amount = field("total_amount", "string").try_cast("decimal(10,2)")
    total = F.when(F.col("amount_kind") == "STRING", text_amount).otherwise(F.col("total_amount"))
    complete = reduce(lambda a, b: a & b, [field(f).isNotNull() for f in needed])
    status = F.when(field("status").isNull(), "pending").otherwise(F.col("status"))
    parsed = (
        F.coalesce(F.col("is_object"), F.lit(False))
        & complete
        & F.col("created_at").isNotNull()
        & F.coalesce(F.col("amount_kind") != "BOOLEAN", F.lit(False))
        & total.isNotNull()
    )
    rows = typed_fields(decode(envelopes)).select(
        *ENVELOPE.names,
        "order_id",
        "customer_id",
        "customer_name",
        "customer_email",
        F.to_json(field("items")).alias("items_json"),
        total.alias("total_amount"),
        status.alias("status"),
        "created_at",
        parsed.alias("parsed"),
    )
    return settle(rows)
