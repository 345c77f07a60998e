"""Every query against its SQL on the small tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as driver

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = driver.queries()[name](spark, SF)
    wanted = duck.sql(driver.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    assert sorted_rows(found.columns, found.collect()) == sorted_rows(wanted.columns, wanted.fetchall())


def test_every_query_without_sql_is_known():
    # the training-data operators, which may be absent, have tests of their own
    assert set(driver.QUERIES) == set(driver.ORACLES)


def test_entry(spark):
    assert driver.entry(spark).columns == ["customer_id", "orders", "total_spent"]


def test_distinct_sketch_is_near_the_truth(spark):
    estimate = driver.queries()["unique_customers_estimate"](spark, SF).first().customers
    exact = driver.queries()["unique_customers"](spark, SF).first().customers
    assert abs(estimate - exact) <= 0.06 * exact


def test_percentile_sketch_is_near_the_truth(spark):
    rows = driver.queries()["processing_time_percentiles"](spark, SF).collect()
    took = driver.queries()["parsed_logs"](spark, SF).select("service", "processing_time_ms").collect()
    for row in rows:
        mine = sorted(r.processing_time_ms for r in took if r.service == row.service)
        assert row.records == len(mine)
        for mark, share in ((row.median_ms, 0.5), (row.p95_ms, 0.95), (row.p99_ms, 0.99)):
            rank = sum(v <= mark for v in mine) / len(mine)
            assert abs(rank - share) < 0.01
