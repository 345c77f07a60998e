import json
import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallybrook.schemas import ENVELOPE  # noqa: E402
from tallybrook.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
START = datetime(2025, 1, 10, 14, 30, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def order(n=1, **changes):
    """A valid message as a dict; a change to ... drops the key."""
    message = {
        "order_id": f"ORD-20250110-{n:05d}",
        "customer_id": f"CUST-{n % 5:05d}",
        "customer_name": "Mira Stone",
        "customer_email": "mira.stone.1@example.com",
        "items": [
            {"item_id": "ITEM-001", "name": "Dumplings", "quantity": 2, "price": 7.25, "subtotal": 14.50},
            {"item_id": "ITEM-002", "name": "Rice", "quantity": 1, "price": 2.85, "subtotal": 2.85},
        ],
        "total_amount": 17.35,
        "status": "pending",
        "created_at": "2025-01-10T14:30:00+00:00",
    }
    message.update(changes)
    return {k: v for k, v in message.items() if v is not ...}


def as_bytes(message):
    if message is None or isinstance(message, bytes):
        return message
    text = message if isinstance(message, str) else json.dumps(message, ensure_ascii=False)
    return text.encode()


def envelopes(spark, messages, first_offset=0, partition=0):
    rows = [
        (b"key", as_bytes(m), "order-messages", partition, first_offset + i, START + timedelta(seconds=first_offset + i))
        for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


@pytest.fixture
def log_of(spark):
    return lambda messages, first_offset=0, partition=0: envelopes(spark, messages, first_offset, partition)
