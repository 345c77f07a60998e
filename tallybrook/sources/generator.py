"""Synthetic customers, menu and orders, the same on any cluster for one seed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import ids
from tallybrook.functions.draws import draw, four_digits, hex_digits
from tallybrook.functions.times import iso_seconds
from tallybrook.schemas import ITEM, MONEY

SEED = 42
CUSTOMERS = 100
MENU_ITEMS = 20
ITEMS_TYPE = f"array<{ITEM.simpleString()}>"

# The menu (name, description, price, category).
MENU = [
    ("Classic Burger", "Beef patty with lettuce, tomato, and cheese", "8.99", "Burgers"),
    ("Cheeseburger", "Double cheese with beef patty", "9.99", "Burgers"),
    ("Bacon Burger", "Beef patty with crispy bacon", "10.99", "Burgers"),
    ("Veggie Burger", "Plant-based patty with vegetables", "8.49", "Burgers"),
    ("French Fries", "Crispy golden fries", "3.49", "Sides"),
    ("Onion Rings", "Beer-battered onion rings", "4.49", "Sides"),
    ("Sweet Potato Fries", "Crispy sweet potato fries", "4.99", "Sides"),
    ("Coleslaw", "Fresh cabbage slaw", "2.99", "Sides"),
    ("Caesar Salad", "Romaine with Caesar dressing", "6.99", "Salads"),
    ("Garden Salad", "Mixed greens with vegetables", "5.99", "Salads"),
    ("Coke", "Coca-Cola classic", "2.49", "Beverages"),
    ("Sprite", "Lemon-lime soda", "2.49", "Beverages"),
    ("Iced Tea", "Freshly brewed iced tea", "2.99", "Beverages"),
    ("Lemonade", "Homemade lemonade", "2.99", "Beverages"),
    ("Milkshake", "Chocolate, vanilla, or strawberry", "4.99", "Beverages"),
    ("Apple Pie", "Warm apple pie with cinnamon", "3.99", "Desserts"),
    ("Ice Cream Sundae", "Vanilla ice cream with toppings", "4.49", "Desserts"),
    ("Brownie", "Chocolate fudge brownie", "3.49", "Desserts"),
    ("Chicken Nuggets", "Crispy chicken nuggets (6 pieces)", "5.99", "Chicken"),
    ("Chicken Sandwich", "Grilled chicken with lettuce", "7.99", "Chicken"),
]

FIRST_NAMES = [
    "Ada", "Bruno", "Carla", "Dimitri", "Elena", "Farid", "Grace", "Hugo", "Ines", "Jonas",
    "Kira", "Liam", "Mona", "Nadia", "Oscar", "Petra", "Quentin", "Rosa", "Stefan", "Tara",
]
LAST_NAMES = [
    "Abbott", "Berger", "Castillo", "Dawson", "Eriksen", "Fischer", "Grant", "Haddad",
    "Ivanov", "Jensen", "Keller", "Lopez", "Moreau", "Novak", "Olsen", "Park", "Quinn",
    "Rossi", "Silva", "Turner",
]


def _pick(words: list[str], *parts) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), draw(len(words), *parts).cast("int"))


def customer_columns(n: Column, seed: int = SEED) -> dict[str, Column]:
    """A customer is a function of its number, so no pool has to be joined."""
    first, last = (_pick(w, seed, s, n) for w, s in ((FIRST_NAMES, "first"), (LAST_NAMES, "last")))
    name = F.concat_ws(" ", first, last)
    exchange, line = draw(1000, seed, "exchange", n), draw(10000, seed, "line", n)
    return {
        "customer_id": ids.customer_id(n),
        "name": name,
        "email": ids.email(name, n),
        "phone": F.concat(F.lit("+1-555-"), ids.padded(exchange, 3), F.lit("-"), ids.padded(line, 4)),
    }


def customers(numbers: DataFrame, seed: int = SEED, column: str = "id") -> DataFrame:
    made = customer_columns(F.col(column), seed)
    return numbers.select(*[value.alias(name) for name, value in made.items()])


def customer_pool(spark: SparkSession, count: int = CUSTOMERS, seed: int = SEED) -> DataFrame:
    return customers(spark.range(1, count + 1), seed)


def menu_rows(count: int = MENU_ITEMS) -> list[tuple]:
    """The first ``count`` items; past the fixed menu, numbered versions of it."""
    rows = []
    for i in range(count):
        name, description, price, category = MENU[i % len(MENU)]
        version = i // len(MENU)
        shown = name if version == 0 else f"{name} {version + 1}"
        item_id = f"{ids.ITEM_PREFIX}{i + 1:0{ids.ITEM_DIGITS}d}"
        rows.append((item_id, shown, description, Decimal(price), category))
    return rows


def menu(spark: SparkSession, count: int = MENU_ITEMS) -> DataFrame:
    shape = "item_id string, name string, description string, price decimal(10,2), category string"
    return spark.createDataFrame(menu_rows(count), shape)


def with_items(
    orders: DataFrame, seed: int, menu_size: int, min_items: int, max_items: int
) -> DataFrame:
    """Add ``items``: distinct items of the menu, one to three of each.

    Every item of the menu gets four digits of a random text and the lowest are
    chosen, so all choices are equally likely.
    """
    most = min(max_items, menu_size)
    least = min(min_items, most)
    number = F.col("id")
    count = draw(most - least + 1, seed, "count", number).cast("int") + least
    marked = [
        F.struct(
            four_digits(F.col("_marks"), i).alias("mark"),
            F.lit(i).alias("n"),
            F.lit(item_id).alias("item_id"),
            F.lit(name).alias("name"),
            F.lit(price).cast(MONEY).alias("price"),
        )
        for i, (item_id, name, _, price, _) in enumerate(menu_rows(menu_size))
    ]

    def item(chosen: Column, place: Column) -> Column:
        digits = four_digits(F.col("_quantities"), place)
        quantity = (F.conv(digits, 16, 10).cast("int") % 3 + 1).cast("int")
        return F.struct(
            chosen["item_id"].alias("item_id"),
            chosen["name"].alias("name"),
            quantity.alias("quantity"),
            chosen["price"].alias("price"),
            (chosen["price"] * quantity).cast(MONEY).alias("subtotal"),
        )

    return (
        orders.withColumn("_marks", hex_digits(menu_size, seed, "pick", number))
        .withColumn("_quantities", hex_digits(most, seed, "quantity", number))
        .withColumn("_chosen", F.slice(F.sort_array(F.array(*marked)), 1, count))
        .withColumn("items", F.transform("_chosen", item).cast(ITEMS_TYPE))
        .drop("_marks", "_quantities", "_chosen")
    )


def orders(
    numbers: DataFrame,
    seed: int = SEED,
    customer_count: int = CUSTOMERS,
    menu_size: int = MENU_ITEMS,
    min_items: int = 1,
    max_items: int = 5,
) -> DataFrame:
    """Orders for rows of (id, created_at); one order per row, no shuffle."""
    number = F.col("id")
    customer = customer_columns(F.col("_customer"), seed)
    total = F.aggregate(
        "items", F.lit(0).cast("decimal(20,2)"), lambda a, i: (a + i["subtotal"]).cast("decimal(20,2)")
    )
    return (
        with_items(numbers, seed, menu_size, min_items, max_items)
        .withColumn("_customer", draw(customer_count, seed, "customer", number) + 1)
        .select(
            ids.order_id(F.col("created_at"), number).alias("order_id"),
            customer["customer_id"].alias("customer_id"),
            customer["name"].alias("customer_name"),
            customer["email"].alias("customer_email"),
            "items",
            total.cast(MONEY).alias("total_amount"),
            F.lit("pending").alias("status"),
            F.concat(iso_seconds(F.col("created_at")), F.lit("Z")).alias("created_at"),
        )
    )


def numbered(spark: SparkSession, count: int, start: str, rate: float = 10.0) -> DataFrame:
    """Order numbers 1..count, created at ``rate`` a second from ``start`` on."""
    after = F.make_dt_interval(secs=((F.col("id") - 1) / F.lit(rate)).cast("decimal(18,6)"))
    return spark.range(1, count + 1).withColumn(
        "created_at", F.lit(start).cast("timestamp_ntz") + after
    )


def rate_numbers(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Endless order numbers at a steady rate, at least one a second."""
    if rows_per_second < 1:
        raise ValueError("rows_per_second must be at least 1")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return ticks.select((F.col("value") + 1).alias("id"), F.col("timestamp").cast("timestamp_ntz").alias("created_at"))
