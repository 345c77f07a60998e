"""The same results in DuckDB's SQL, straight from the tables.

Nothing here reads JSON: what becomes of a message follows from the damage that
was done to it.
"""

from __future__ import annotations

from tallybrook.sources.generator import FIRST_NAMES, LAST_NAMES, MENU, menu_rows
from tallybrook.sources.warehouse import FAULT_DRAWS, FAULTS

ASOF = "TIMESTAMP '1998-12-31 00:00:00'"
CUSTOMER = "'CUST-00042'"
LISTED = "order_id, customer_id, total_amount, status, created_at"

LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
         p_name AS name, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         printf('ITEM-%03d', l_partkey) AS item_id,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER)
              AS DECIMAL(10,2)) AS subtotal
  FROM lineitem JOIN part ON p_partkey = l_partkey),
totals AS (
  SELECT l_orderkey, CAST(sum(subtotal) AS DECIMAL(10,2)) AS total_amount, count(*) AS n_items
  FROM lines GROUP BY 1),
head AS (
  SELECT o_orderkey,
         'ORD-' || strftime(o_orderdate, '%Y%m%d') || '-' || printf('%05d', o_orderkey) AS order_id,
         printf('CUST-%05d', o_custkey) AS customer_id, c_name AS customer_name,
         lower(replace(c_name, ' ', '.')) || '.' || o_custkey || '@example.com' AS customer_email,
         o_orderstatus, o_orderdate AS created_at
  FROM orders JOIN customer ON c_custkey = o_custkey)"""

STORED = (
    LINES
    + """,
stored AS (
  SELECT order_id, customer_id, customer_name, customer_email, total_amount,
         CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'processing'
              WHEN 'F' THEN 'completed' END AS status,
         created_at, created_at + to_seconds(o_orderkey % 97) AS processed_at, n_items, o_orderkey
  FROM head JOIN totals ON l_orderkey = o_orderkey)"""
)


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bytes_ = f"[ord(x)::BIGINT FOR x IN string_split({text}, '')]"
    step = "xor(y >> 1, 3988292384 * (y & 1))"
    one = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda y, i: {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: {one}), 4294967295)"


_LABEL = "CASE d " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(FAULTS)) + " ELSE 'none' END"

LOG = (
    LINES
    + f""",
places AS (
  SELECT cid, {crc32("cid")} AS crc
  FROM (SELECT printf('CUST-%05d', c_custkey) AS cid FROM customer)),
drawn AS (
  SELECT head.*, coalesce(n_items, 0) AS n_items, CAST(coalesce(total_amount, 0) AS DECIMAL(10,2)) AS total_amount,
         ('0x' || substr(md5('fault:' || o_orderkey), 1, 8))::BIGINT % {FAULT_DRAWS} AS d
  FROM head LEFT JOIN totals ON l_orderkey = o_orderkey),
labelled AS (SELECT *, {_LABEL} AS fault FROM drawn),
sent AS (
  SELECT *, unnest(CASE fault WHEN 'sent_twice' THEN [0, 1] WHEN 'truncated_then_whole' THEN [0, 1]
                        WHEN 'sent_three_times' THEN [0, 1, 2] ELSE [0] END) AS copy
  FROM labelled),
log AS (
  SELECT sent.*, 'order-messages' AS topic, crc, CAST(crc % 3 AS INTEGER) AS "partition",
         o_orderkey * 4 + copy AS "offset", created_at + to_seconds(copy) AS "timestamp"
  FROM sent JOIN places ON cid = customer_id),
judged AS (
  SELECT *,
    CASE WHEN fault = 'tombstone' THEN 'tombstone'
         WHEN fault = 'bad_utf8' THEN 'bad_utf8'
         WHEN fault IN ('truncated', 'trailing_text')
              OR (fault = 'truncated_then_whole' AND copy = 0) THEN 'undecodable'
         WHEN fault = 'in_array' THEN 'not_object'
         WHEN fault IN ('no_customer', 'no_email_no_status') THEN 'missing_fields'
         WHEN fault IN ('empty_items', 'object_items') OR n_items = 0 THEN 'bad_items'
         WHEN fault IN ('negative_amount', 'text_amount', 'false_amount') THEN 'bad_amount'
         WHEN fault = 'true_amount' THEN 'bad_amount_type'
         WHEN fault IN ('time_only', 'null_time') THEN 'bad_timestamp'
         WHEN fault IN ('long_name', 'huge_amount') THEN 'out_of_range'
         WHEN fault = 'null_status' THEN 'null_violation'
         WHEN fault = 'tiny_amount' THEN 'check_violation'
    END AS broken
  FROM log),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, broken IS NULL
                               ORDER BY "timestamp", "partition", "offset") AS place
  FROM judged),
final AS (
  SELECT *, CASE WHEN broken IS NULL AND place > 1 THEN 'duplicate' ELSE broken END AS reason,
         CASE WHEN broken IN ('tombstone', 'bad_utf8', 'undecodable', 'not_object')
              THEN NULL ELSE order_id END AS seen_id
  FROM ranked),
outcomes AS (
  SELECT *, CASE WHEN reason IS NULL THEN 'processed'
                 WHEN reason IN ('duplicate', 'null_violation', 'check_violation') THEN 'skipped'
                 ELSE 'failed' END AS outcome
  FROM final),
accepted AS (SELECT *, 'pending' AS status FROM outcomes WHERE outcome = 'processed')"""
)

ITEMS = """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_linenumber, l_partkey, quantity) - 1 AS position
  FROM lines)"""

EVENT_LOGS = """
logs AS (
  SELECT event_id AS n, date_trunc('milliseconds', ts) AS logged_at,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
         CASE WHEN event_type IN ('click', 'view') THEN 'sender' ELSE 'loader' END AS service,
         'saw ' || event_type AS message,
         CASE WHEN event_type <> 'view' THEN printf('CUST-%05d', user_id) END AS correlation_id,
         value AS processing_time_ms
  FROM events)"""


def draw(n: int, *parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {n})"


def short(amount: str) -> str:
    """An amount of two decimals without its trailing zeros."""
    return f"regexp_replace(regexp_replace(CAST({amount} AS VARCHAR), '0+$', ''), '[.]$', '')"


ITEM_TEXT = f"""'{{"item_id":"' || item_id || '","name":"' || name || '",'
         || CASE WHEN fault = 'further_key' AND position = 0 THEN '"note":"by hand",' ELSE '' END
         || '"price":' || {short("price")} || ',"quantity":' || quantity || ',"subtotal":' || {short("subtotal")} || '}}'"""


def _texts(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def customer_sql(n: str) -> dict[str, str]:
    first = f"{_texts(FIRST_NAMES)}[{draw(len(FIRST_NAMES), repr('42'), repr('first'), n)} + 1]"
    last = f"{_texts(LAST_NAMES)}[{draw(len(LAST_NAMES), repr('42'), repr('last'), n)} + 1]"
    name = f"{first} || ' ' || {last}"
    return {
        "id": f"printf('CUST-%05d', {n})",
        "name": name,
        "email": f"lower(replace({name}, ' ', '.')) || '.' || {n} || '@example.com'",
    }


def digits(name: str, count: int) -> str:
    parts = [f"md5('42:{name}:' || o_orderkey || ':{i}')" for i in range(-(-count // 8))]
    return " || ".join(parts)


_BUYER = customer_sql("c")


def generated(customers: int = 100, items: int = len(MENU)) -> str:
    """Generated orders of a pool of customers and the first items of the menu."""
    menu = ", ".join(f"({i}, '{row[0]}', '{row[1]}', CAST({row[3]} AS DECIMAL(10,2)))" for i, row in enumerate(menu_rows(items)))
    return f"""
menu(n, item_id, name, price) AS (VALUES {menu}),
digits AS (
  SELECT o_orderkey, {digits("pick", items)} AS marks, {digits("quantity", 5)} AS amounts,
         {draw(5, "'42'", "'count'", "o_orderkey")} + 1 AS k
  FROM orders),
picks AS (
  SELECT o_orderkey, item_id, name, price, k, amounts,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY substr(marks, n * 4 + 1, 4), n) AS r
  FROM digits CROSS JOIN menu),
chosen AS (
  SELECT *, ('0x' || substr(amounts, (r - 1) * 4 + 1, 4))::BIGINT % 3 + 1 AS quantity,
         CAST(price * quantity AS DECIMAL(10,2)) AS subtotal
  FROM picks WHERE r <= k),
sums AS (
  SELECT o_orderkey, count(*) AS item_count, CAST(sum(subtotal) AS DECIMAL(10,2)) AS total_amount
  FROM chosen GROUP BY 1),
made AS (
  SELECT o_orderkey, o_orderdate,
         'ORD-' || strftime(o_orderdate, '%Y%m%d') || '-' || printf('%05d', o_orderkey) AS order_id,
         {draw(customers, "'42'", "'customer'", "o_orderkey")} + 1 AS c
  FROM orders)"""


GENERATED = generated()


def over(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}{body if body.startswith(",") else " " + body}"


def stored(body: str) -> str:
    return over(STORED, body)


def log(body: str) -> str:
    return over(LOG, body)


ORACLES: dict[str, str] = {
    # log to stored orders
    "log_revenue_per_customer": log(
        "SELECT customer_id, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_spent "
        "FROM accepted GROUP BY 1"
    ),
    "message_outcomes": log(
        'SELECT "partition", "offset", seen_id AS order_id, outcome, coalesce(reason, \'\') AS reason '
        "FROM outcomes"
    ),
    "outcome_counters": log(
        "SELECT outcome, coalesce(reason, '') AS reason, count(*) AS messages FROM outcomes GROUP BY 1, 2"
    ),
    "success_rate": log(
        "SELECT CAST(sum(CASE WHEN outcome <> 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS succeeded, "
        "CAST(sum(CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed, "
        "round(succeeded::DOUBLE * 100 / (succeeded + failed), 4) AS success_rate, "
        "round((succeeded - failed)::DOUBLE * 100 / succeeded, 4) AS reported_rate FROM outcomes"
    ),
    "missing_field_report": log(
        "SELECT field, count(*) AS messages FROM (SELECT unnest(CASE fault WHEN 'no_customer' "
        "THEN ['customer_id'] ELSE ['customer_email', 'status'] END) AS field "
        "FROM outcomes WHERE reason = 'missing_fields') GROUP BY 1"
    ),
    "quarantine": log(
        'SELECT customer_id AS key, "partition", "offset", seen_id AS order_id, outcome, reason '
        "FROM outcomes WHERE broken IS NOT NULL"
    ),
    "dedup_orders": log(
        "SELECT order_id, customer_id, customer_name, customer_email, n_items AS item_count, total_amount, "
        'status, created_at, "partition", "offset" FROM accepted'
    ),
    "duplicate_report": log(
        "SELECT order_id, count(*) AS copies FROM outcomes WHERE broken IS NULL GROUP BY 1 HAVING count(*) > 1"
    ),
    "lenient_orders": log(
        'SELECT "partition", "offset", order_id, '
        "CAST(CASE fault WHEN 'negative_amount' THEN -total_amount WHEN 'tiny_amount' THEN 0 "
        "ELSE total_amount END AS DECIMAL(10,2)) AS total_amount, "
        "CASE WHEN fault = 'null_status' THEN NULL ELSE 'pending' END AS status, created_at "
        "FROM outcomes WHERE seen_id IS NOT NULL AND fault NOT IN ('no_customer', 'no_email_no_status', "
        "'true_amount', 'false_amount', 'time_only', 'null_time', 'huge_amount')"
    ),
    "extracted_order_ids": log('SELECT "partition", "offset", seen_id AS order_id FROM outcomes'),
    "quantity_rule": log(
        ", positive AS (SELECT l_orderkey, bool_and(quantity > 0) AS fine FROM lines GROUP BY 1) "
        "SELECT reason, count(*) AS messages FROM (SELECT CASE WHEN broken IN ('tombstone', 'bad_utf8', "
        "'undecodable', 'not_object', 'missing_fields', 'bad_items') THEN broken "
        "WHEN NOT coalesce(fine, true) THEN 'bad_quantity' ELSE coalesce(broken, '') END AS reason "
        "FROM outcomes LEFT JOIN positive ON l_orderkey = o_orderkey) GROUP BY 1"
    ),
    "order_items": over(
        LOG + ITEMS,
        "SELECT order_id, position, item_id, name, quantity, price, subtotal "
        "FROM accepted JOIN placed ON l_orderkey = o_orderkey",
    ),
    "stored_items_text": over(
        LOG + ITEMS,
        f"SELECT order_id, '[' || string_agg({ITEM_TEXT}, ',' ORDER BY position) || ']' AS items_json "
        "FROM accepted JOIN placed ON l_orderkey = o_orderkey GROUP BY order_id",
    ),
    "order_totals": log(
        "SELECT order_id, total_amount, CAST(total_amount AS DECIMAL(38,2)) AS item_total FROM accepted"
    ),
    "topic_messages": over(
        STORED + f", places AS (SELECT DISTINCT customer_id AS cid, {crc32('customer_id')} AS crc FROM head)",
        'SELECT CAST(crc % 3 AS INTEGER) AS "partition", order_id, customer_id, total_amount, status, '
        "created_at, 'processed' AS outcome FROM stored JOIN places ON cid = customer_id",
    ),
    "live_revenue": stored(
        "SELECT customer_id, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_spent "
        "FROM stored GROUP BY 1"
    ),
    "stream_without_copies": log("SELECT order_id, customer_id, total_amount FROM accepted"),
    "pipeline_replay": log(
        "SELECT 0::BIGINT AS batch_id, outcome, coalesce(reason, '') AS reason, count(*) AS messages "
        "FROM outcomes GROUP BY 2, 3 UNION ALL SELECT 1::BIGINT, outcome, reason, count(*) FROM (SELECT "
        "CASE WHEN broken IS NULL THEN 'skipped' ELSE outcome END AS outcome, "
        "coalesce(broken, 'duplicate') AS reason FROM outcomes) GROUP BY 2, 3"
    ),
    # counts and sums
    "total_orders": stored("SELECT count(*) AS orders FROM stored"),
    "orders_per_customer": stored("SELECT customer_id, count(*) AS orders FROM stored GROUP BY 1"),
    "orders_by_status": stored("SELECT status, count(*) AS orders FROM stored GROUP BY 1"),
    "revenue_per_customer": stored(
        "SELECT customer_id, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_spent "
        "FROM stored GROUP BY 1 ORDER BY total_spent DESC, customer_id"
    ),
    "average_order_value": stored(
        "SELECT round(CAST(sum(total_amount) AS DOUBLE) / count(*), 2) AS average_value FROM stored"
    ),
    "unique_customers": stored("SELECT count(DISTINCT customer_id) AS customers FROM stored"),
    "unique_customers_estimate": stored("SELECT count(DISTINCT customer_id) AS customers, true AS within_error FROM stored"),
    "uniqueness": stored(
        "SELECT 'orders' AS subject, count(*) AS row_count, count(DISTINCT order_id) AS distinct_ids "
        "FROM stored UNION ALL SELECT 'items', count(*), count(DISTINCT item_id) FROM lines"
    ),
    "item_counts": stored("SELECT order_id, n_items AS item_count FROM stored"),
    # listings
    "all_orders": over(
        STORED + ITEMS,
        "SELECT order_id, customer_id, customer_name, customer_email, items, total_amount, status, "
        "created_at, processed_at FROM stored JOIN (SELECT l_orderkey, "
        "string_agg(item_id || 'x' || quantity, ',' ORDER BY position) AS items FROM placed GROUP BY 1) "
        "ON l_orderkey = o_orderkey",
    ),
    "all_orders_newest_first": stored(f"SELECT {LISTED} FROM stored ORDER BY created_at DESC, order_id"),
    "latest_orders": stored(f"SELECT {LISTED} FROM stored ORDER BY created_at DESC, order_id LIMIT 10"),
    "customer_orders": stored(f"SELECT {LISTED} FROM stored WHERE customer_id = {CUSTOMER}"),
    "customer_history": stored(
        f"SELECT {LISTED} FROM stored WHERE customer_id = {CUSTOMER} ORDER BY created_at, order_id"
    ),
    "customer_time_range": stored(
        f"SELECT {LISTED} FROM stored WHERE customer_id = {CUSTOMER} "
        "AND created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '2001-04-01'"
    ),
    "orders_last_hour": stored(
        f"SELECT {LISTED} FROM stored WHERE created_at > {ASOF} - INTERVAL 1 HOUR AND created_at <= {ASOF}"
    ),
    "orders_last_day": stored(
        f"SELECT {LISTED} FROM stored WHERE created_at > {ASOF} - INTERVAL 24 HOUR AND created_at <= {ASOF}"
    ),
    "orders_with_status": stored(f"SELECT {LISTED} FROM stored WHERE status = 'pending'"),
    "order_lookup": stored(f"SELECT {LISTED} FROM stored WHERE order_id = 'ORD-19990116-00002' LIMIT 1"),
    "orders_containing_items": stored(
        f"SELECT {LISTED} FROM stored WHERE o_orderkey IN (SELECT l_orderkey FROM lines "
        "WHERE name = 'red widget') AND o_orderkey IN (SELECT l_orderkey FROM lines WHERE name = 'hot ring')"
    ),
    "orders_containing_item_quantity": stored(
        f"SELECT {LISTED} FROM stored WHERE o_orderkey IN (SELECT l_orderkey FROM lines "
        "WHERE name = 'red widget' AND quantity = 10)"
    ),
    # latency and the log
    "latency_report": stored(
        "SELECT order_id, created_at, processed_at, "
        "date_diff('microsecond', created_at, processed_at) / 1e6 AS latency_seconds FROM stored"
    ),
    "latency_of_latest": stored(
        "SELECT order_id, customer_id, created_at, processed_at, "
        "date_diff('microsecond', created_at, processed_at) / 1e3 AS latency_ms FROM stored "
        "ORDER BY created_at DESC, order_id LIMIT 10"
    ),
    "partition_inventory": log(
        'SELECT topic, "partition", count(*) AS messages, min("offset") AS first_offset, '
        'max("offset") AS last_offset FROM log GROUP BY 1, 2'
    ),
    "partition_distribution": log(
        'SELECT topic, "partition", count(*) AS messages, '
        "round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY topic), 4) AS share "
        "FROM log GROUP BY 1, 2"
    ),
    "partitions_in_use": log(
        'SELECT topic, count(DISTINCT "partition") AS partitions, count(DISTINCT "partition") > 1 AS spread '
        "FROM log GROUP BY 1"
    ),
    "key_consistency": log(
        "SELECT count(*) AS key_count, CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) "
        'AS split_keys FROM (SELECT customer_id, count(DISTINCT "partition") AS n FROM log GROUP BY 1)'
    ),
    "key_inconsistencies": log(
        "SELECT customer_id AS key, min(p) AS lowest_partition, max(p) AS highest_partition FROM "
        f'(SELECT customer_id, CAST(CASE WHEN "timestamp" < {ASOF} THEN crc % 3 ELSE crc % 4 END AS INTEGER) '
        "AS p FROM log) GROUP BY 1 HAVING min(p) <> max(p)"
    ),
    "consumer_lag": log(
        ', ends AS (SELECT topic, "partition", min("offset") AS lo, max("offset") + 1 AS log_end, '
        f'max(CASE WHEN "timestamp" <= {ASOF} THEN "offset" END) + 1 AS done FROM log GROUP BY 1, 2) '
        'SELECT topic, "partition", log_end, coalesce(done, lo) AS committed, '
        "log_end - coalesce(done, lo) AS lag FROM ends"
    ),
    "throughput": log(
        "SELECT count(*) AS messages, "
        "date_diff('microsecond', min(\"timestamp\"), max(\"timestamp\")) / 1e6 AS elapsed_seconds, "
        "round(count(*) / elapsed_seconds, 6) AS actual_rate, "
        "round(count(*) / elapsed_seconds * 100 / 10.0::DOUBLE, 6) AS target_share FROM log"
    ),
    "retained_messages": log(
        'SELECT customer_id AS key, "partition", "offset", "timestamp" FROM log '
        "WHERE \"timestamp\" >= TIMESTAMP '2001-08-01' - INTERVAL 7 DAY"
    ),
    "sequence_check": log(
        ", ordered AS (SELECT customer_id, \"partition\", order_id, \"offset\", "
        "lag(order_id) OVER w AS previous_order_id, lag(\"offset\") OVER w AS previous_offset FROM accepted "
        'WINDOW w AS (PARTITION BY customer_id, "partition" ORDER BY created_at, order_id)) '
        "SELECT * FROM ordered WHERE previous_offset > \"offset\""
    ),
    # checks
    "quality_rules": stored(
        ", facts AS (SELECT l_orderkey, bool_and(price BETWEEN 0.99 AND 50) AS price_ok, "
        "bool_and(quantity > 0) AS some_ok, bool_and(quantity BETWEEN 1 AND 5) AS quantity_ok FROM lines GROUP BY 1), "
        "flags AS (SELECT unnest([{'rule': 'subtotal_is_price_times_quantity', 'bad': 0}, "
        "{'rule': 'total_is_sum_of_subtotals', 'bad': 0}, "
        "{'rule': 'price_in_range', 'bad': (NOT price_ok)::INT}, "
        "{'rule': 'quantity_positive', 'bad': (NOT some_ok)::INT}, "
        "{'rule': 'quantity_in_range', 'bad': (NOT quantity_ok)::INT}, "
        "{'rule': 'item_count_in_range', 'bad': (n_items NOT BETWEEN 1 AND 5)::INT}, "
        "{'rule': 'order_id_format', 'bad': (NOT regexp_matches(order_id, '^ORD-\\d{8}-\\d{5,}$'))::INT}, "
        "{'rule': 'customer_id_format', 'bad': (NOT regexp_matches(customer_id, '^CUST-\\d{5,}$'))::INT}, "
        "{'rule': 'email_format', 'bad': (NOT regexp_matches(customer_email, '^[^@]+@[^@]+\\.[^@]+$'))::INT}, "
        "{'rule': 'name_has_two_words', 'bad': (NOT contains(trim(customer_name), ' '))::INT}]) AS f "
        "FROM stored JOIN facts ON l_orderkey = o_orderkey) "
        "SELECT f.rule AS rule, count(*) AS orders, CAST(sum(f.bad) AS BIGINT) AS violations FROM flags GROUP BY 1"
    ),
    "referential_check": log(
        'SELECT "partition", "offset", seen_id AS order_id, NULL::VARCHAR AS customer_id FROM outcomes '
        "WHERE seen_id IS NULL OR fault = 'no_customer'"
    ),
    # columns
    "exported_orders": stored(
        "SELECT order_id, '{\"order_id\":\"' || order_id || '\",\"customer_id\":\"' || customer_id || "
        "'\",\"customer_name\":\"' || customer_name || '\",\"customer_email\":\"' || customer_email || "
        "'\",\"total_amount\":' || CAST(CAST(total_amount AS DOUBLE) AS VARCHAR) || ',\"status\":\"' || status || "
        "'\",\"created_at\":\"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '\",\"processed_at\":\"' || "
        "strftime(processed_at, '%Y-%m-%dT%H:%M:%S') || '\"}' AS exported FROM stored"
    ),
    "display_texts": stored(
        "SELECT order_id, 'Order ' || order_id || ' - ' || customer_id || ' - $' || total_amount AS shown, "
        "'<Order(order_id=' || order_id || ', customer_id=' || customer_id || ', total_amount=' || "
        "total_amount || ', status=' || status || ')>' AS debug FROM stored"
    ),
    "order_id_parts": stored(
        "SELECT order_id, 'ORD' AS prefix, CAST(created_at AS DATE) AS order_date, o_orderkey AS sequence FROM stored"
    ),
    "customer_emails": (
        "SELECT c_custkey, lower(replace(c_name, ' ', '.')) || '.' || c_custkey || '@example.com' AS email "
        "FROM customer"
    ),
    "log_times": (
        "SELECT event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS logged "
        "FROM events"
    ),
    "masked_urls": (
        "SELECT page_id, url, regexp_replace(url, '^([a-z]+://)', "
        "'\\1user' || page_id || ':p@ss:***@') AS masked FROM pages"
    ),
    # table maintenance
    "status_updates": stored(
        ", news AS (SELECT l_orderkey, max(struct_pack(t := l_shipdate, s := CASE l_linestatus WHEN 'F' "
        "THEN 'completed' ELSE 'processing' END)).s AS new_status FROM lineitem GROUP BY 1) "
        "SELECT order_id, customer_id, total_amount, coalesce(new_status, status) AS status, created_at "
        "FROM stored LEFT JOIN news ON l_orderkey = o_orderkey"
    ),
    "migrated_orders": stored(
        f"SELECT order_id, customer_id, CASE WHEN created_at >= {ASOF} THEN customer_name END AS customer_name, "
        f"CASE WHEN created_at >= {ASOF} THEN customer_email END AS customer_email, total_amount FROM stored"
    ),
    # event log and structured logs
    "order_state_latest": (
        "SELECT user_id, event_type, value, ts, events FROM (SELECT *, count(*) OVER (PARTITION BY user_id) "
        "AS events, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) "
        "WHERE r = 1"
    ),
    "order_state_asof": (
        "SELECT user_id, event_type, value, ts, events FROM (SELECT *, count(*) OVER (PARTITION BY user_id) "
        "AS events, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events "
        "WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') WHERE r = 1"
    ),
    "compacted_log": (
        "SELECT key, value, \"partition\", \"offset\" FROM (SELECT *, row_number() OVER (PARTITION BY key "
        "ORDER BY ts DESC, \"partition\" DESC, \"offset\" DESC) AS r FROM (SELECT ts, event_id AS \"offset\", "
        "CAST(user_id % 3 AS INTEGER) AS \"partition\", "
        "CASE WHEN event_type = 'error' THEN user_id::VARCHAR ELSE user_id || '-' || event_type END AS key, "
        "CASE WHEN event_type <> 'error' THEN props END AS value FROM events)) WHERE r = 1 AND value IS NOT NULL"
    ),
    "parsed_logs": over(EVENT_LOGS, "SELECT * FROM logs"),
    "rejected_log_lines": (
        "SELECT 'worker stopped at ' || event_id AS line FROM events WHERE event_type = 'error' "
        "UNION ALL SELECT '[\"' || event_id || '\"]' FROM events WHERE event_type = 'signup'"
    ),
    "error_logs": over(
        EVENT_LOGS, "SELECT logged_at, service, message, correlation_id FROM logs WHERE level = 'ERROR'"
    ),
    "log_level_counts": over(
        EVENT_LOGS, "SELECT service, level, count(*) AS records FROM logs GROUP BY 1, 2"
    ),
    "order_trace": over(
        EVENT_LOGS,
        "SELECT logged_at, service, level, message, processing_time_ms FROM logs "
        "WHERE correlation_id = 'CUST-00007'",
    ),
    "trace_summary": over(
        EVENT_LOGS,
        "SELECT correlation_id, count(*) AS steps, min(logged_at) AS first_at, max(logged_at) AS last_at, "
        "min(service) AS first_service, max(service) AS last_service, "
        "CAST(sum(CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END) AS BIGINT) AS errors, "
        "min(processing_time_ms) AS fastest_ms, max(processing_time_ms) AS slowest_ms "
        "FROM logs WHERE correlation_id IS NOT NULL GROUP BY 1",
    ),
    "processing_time_percentiles": over(
        EVENT_LOGS,
        "SELECT service, count(*) AS records, quantile_disc(processing_time_ms, 0.5) AS median_ms, "
        "quantile_disc(processing_time_ms, 0.95) AS p95_ms, quantile_disc(processing_time_ms, 0.99) AS p99_ms, true AS within_error "
        "FROM logs WHERE processing_time_ms IS NOT NULL GROUP BY 1",
    ),
    # generated data
    "generated_customers": (
        "SELECT {id} AS customer_id, {name} AS name, {email} AS email, ".format(**customer_sql("c_custkey"))
        + f"printf('+1-555-%03d-%04d', {draw(1000, repr('42'), repr('exchange'), 'c_custkey')}, "
        f"{draw(10000, repr('42'), repr('line'), 'c_custkey')}) AS phone FROM customer"
    ),
    "generated_orders": over(
        GENERATED,
        "SELECT order_id, {id} AS customer_id, {name} AS customer_name, {email} AS customer_email, ".format(**_BUYER)
        + "item_count, total_amount, 'pending' AS status, "
        "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS created_at "
        "FROM made JOIN sums USING (o_orderkey)",
    ),
    "generated_items": over(
        GENERATED,
        "SELECT order_id, r - 1 AS position, item_id, name, CAST(quantity AS INTEGER) AS quantity, price, subtotal "
        "FROM chosen JOIN made USING (o_orderkey)",
    ),
    "customer_draws": over(GENERATED, "SELECT c AS customer, count(*) AS orders FROM made GROUP BY 1"),
}

_TABLE = (
    "SELECT order_id, customer_id, customer_name, customer_email, total_amount, status, created_at FROM accepted"
)
ORACLES["pipeline_batch"] = ORACLES["pipeline_stream"] = log(_TABLE)
ORACLES["pipeline_counters"] = ORACLES["live_outcomes"] = ORACLES["outcome_counters"]
ORACLES["stored_after_retention"] = log(_TABLE + " WHERE created_at >= TIMESTAMP '1998-01-01'")
# two runs of 600 messages, each shared evenly among the partitions
_RUN = (
    'SELECT "partition", "offset" FROM (SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS k FROM {rest}) '
    'ORDER BY k, "partition" LIMIT 600'
)
ORACLES["bounded_run"] = log(
    f', first_run AS ({_RUN.format(rest="log")}), rest AS (SELECT * FROM log ANTI JOIN first_run USING ("partition", "offset")), '
    f'second_run AS ({_RUN.format(rest="rest")}), runs AS (FROM first_run UNION ALL FROM second_run) '
    'SELECT order_id, customer_id, customer_name, customer_email, total_amount, status, created_at '
    'FROM accepted SEMI JOIN runs USING ("partition", "offset")'
)
ORACLES["status_asof"] = stored(
    ", events AS (SELECT o_orderkey, status, created_at AS since FROM stored UNION ALL SELECT l_orderkey, "
    "CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'processing' END, l_shipdate FROM lineitem) "
    "SELECT order_id, created_at + INTERVAL 60 DAY AS asked_at, max(CASE WHEN since <= created_at + INTERVAL 60 DAY "
    "THEN struct_pack(t := since, s := events.status) END).s AS status_then "
    "FROM stored JOIN events ON events.o_orderkey = stored.o_orderkey GROUP BY 1, 2"
)
_RECONCILE = LOG + (
    ", kept AS (SELECT order_id FROM accepted), "
    "produced AS (SELECT order_id, CASE o_orderstatus WHEN 'O' THEN '' ELSE 'status' END AS different "
    "FROM head JOIN totals ON l_orderkey = o_orderkey), "
    "compared AS (SELECT coalesce(p.order_id, k.order_id) AS order_id, "
    "CASE WHEN k.order_id IS NULL THEN 'missing' WHEN p.order_id IS NULL THEN 'extra' "
    "WHEN different <> '' THEN 'mismatch' ELSE 'match' END AS state, "
    "CASE WHEN k.order_id IS NULL OR p.order_id IS NULL THEN '' ELSE different END AS different "
    "FROM produced p FULL JOIN kept k ON p.order_id = k.order_id)"
)
ORACLES["reconcile"] = over(_RECONCILE, "SELECT * FROM compared")
ORACLES["reconcile_summary"] = over(
    _RECONCILE, "SELECT state, different, count(*) AS orders FROM compared GROUP BY 1, 2"
)
ORACLES["stream_lag"] = log(
    'SELECT topic, "partition", count(*) AS messages, max("offset") + 1 AS log_end, '
    f'CAST(sum(CASE WHEN "timestamp" > {ASOF} THEN 1 ELSE 0 END) AS BIGINT) AS lag FROM log GROUP BY 1, 2'
)
ORACLES["late_customers"] = log(
    "SELECT order_id, customer_id, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'at once' "
    f"WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN CASE WHEN \"timestamp\" > {ASOF} THEN 'at once' ELSE 'after waiting' END "
    "ELSE 'waiting' END AS state FROM accepted JOIN customer ON printf('CUST-%05d', c_custkey) = customer_id"
)
ORACLES["exported_orders_with_items"] = over(
    STORED + ITEMS,
    "SELECT order_id, '{\"order_id\":\"' || order_id || '\",\"customer_id\":\"' || customer_id || "
    "'\",\"customer_name\":\"' || customer_name || '\",\"customer_email\":\"' || customer_email || '\",\"items\":[' || items || "
    "'],\"total_amount\":' || CAST(CAST(total_amount AS DOUBLE) AS VARCHAR) || ',\"status\":\"' || status || "
    "'\",\"created_at\":\"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '\",\"processed_at\":\"' || "
    "strftime(processed_at, '%Y-%m-%dT%H:%M:%S') || '\"}' AS exported FROM stored JOIN (SELECT l_orderkey, string_agg("
    "'{\"item_id\":\"' || item_id || '\",\"name\":\"' || name || '\",\"quantity\":' || quantity || ',\"price\":' || price || "
    "',\"subtotal\":' || subtotal || '}', ',' ORDER BY position) AS items FROM placed GROUP BY 1) ON l_orderkey = o_orderkey",
)
ORACLES["unsendable_orders"] = log(
    "SELECT o_orderkey, CASE WHEN fault <> 'tombstone' THEN order_id END AS order_id, "
    "CASE WHEN fault <> 'no_customer' THEN customer_id END AS customer_id, "
    "CASE fault WHEN 'tombstone' THEN 'no_order_id' ELSE 'no_customer_id' END AS reason "
    "FROM labelled WHERE fault IN ('tombstone', 'no_customer')"
)
ORACLES["id_uniqueness"] = " UNION ALL ".join(
    f"SELECT '{subject}' AS subject, count(*) AS row_count, count(DISTINCT {column}) AS distinct_ids, count(*) = count(DISTINCT {column}) AS all_distinct FROM {name}"
    for subject, column, name in (("orders", "o_orderkey", "orders"), ("customers", "c_custkey", "customer"), ("items", "p_partkey", "part"))
)
ORACLES["generated_orders_of_pools"] = over(
    generated(17, 27),
    "SELECT order_id, printf('CUST-%05d', c) AS customer_id, items, total_amount FROM made JOIN sums USING (o_orderkey) "
    "JOIN (SELECT o_orderkey, string_agg(name || ' x' || quantity, ', ' ORDER BY r) AS items FROM chosen GROUP BY 1) USING (o_orderkey)",
)
