"""Orders into a relational table over JDBC.

Rows go to a staging table in parallel; one statement then moves them over and
leaves orders alone that are there already. No database is at hand, so only the
options and statements are checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.schemas import MAX_LENGTH, ORDERS

RULES = {
    "order_id": " PRIMARY KEY",
    "total_amount": " NOT NULL CHECK (total_amount > 0)",
    "processed_at": " DEFAULT CURRENT_TIMESTAMP",
}

def create_statement(table: str = "orders") -> str:
    """The table with its constraints, made from the schema and the length limits."""
    columns = []
    for name, kind in ((f.name, f.dataType) for f in ORDERS.fields):
        if name in MAX_LENGTH:
            sql = f"VARCHAR({MAX_LENGTH[name]})"
        elif isinstance(kind, T.DecimalType):
            sql = f"DECIMAL({kind.precision},{kind.scale})"
        else:
            sql = "JSONB" if isinstance(kind, T.ArrayType) else "TIMESTAMP"
        columns.append(f"{name} {sql}{RULES.get(name, ' NOT NULL')}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def write_options(url: str, table: str, batch_size: int = 5000) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": "READ_COMMITTED",
        # text columns may be stored as jsonb
        "stringtype": "unspecified",
    }


def read_options(url: str, table: str, column: str, low: str, high: str, parts: int) -> dict[str, str]:
    """Read a table in ranges of one column, one connection per range."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": low,
        "upperBound": high,
        "numPartitions": str(parts),
    }


def merge_statement(staging: str, table: str = "orders") -> str:
    names = ", ".join(ORDERS.names)
    chosen = ", ".join("items::jsonb" if c == "items" else c for c in ORDERS.names)
    return (
        f"INSERT INTO {table} ({names}) SELECT {chosen} FROM {staging} "
        "ON CONFLICT (order_id) DO NOTHING"
    )


def flat(orders: DataFrame) -> DataFrame:
    """Items as JSON text, which is what a driver can send: as they came, where the rows still have that."""
    items = F.to_json("items")
    if "items_json" in orders.columns:
        items = F.coalesce("items_json", items)
    return orders.select(*[items.alias(c) if c == "items" else F.col(c) for c in ORDERS.names])


def write(
    orders: DataFrame, url: str, staging: str, execute: Callable[[str], None], connections: int = 16
) -> None:
    """``execute`` runs one statement in the database, with the caller's client.

    The rows are dealt to the connections by a shuffle, so that what makes them keeps its own tasks.
    """
    rows = flat(orders).repartition(connections)
    rows.write.format("jdbc").options(**write_options(url, staging)).mode("overwrite").save()
    execute(merge_statement(staging))
