from __future__ import annotations

import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartlytics.session import local_session  # noqa: E402
from cartlytics.sources import schemas as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="*", shuffle_partitions=8, app_name="cartlytics-tests")


def D(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def d(s: str) -> date:
    return date.fromisoformat(s)


@pytest.fixture()
def shop(spark):
    """Hand-made tables: an order without items, two orders on one day, a
    day gap, equal revenues (rank ties) and a NULL header revenue."""
    customers = spark.createDataFrame([
        (1, d("2024-01-05"), "QA", "age-a", "inc-a", "flyer"),
        (2, d("2024-01-20"), "ZU", "age-b", "inc-b", "radio"),
        (3, d("2024-02-03"), "TK", "age-c", "inc-c", "stall"),
        (4, d("2024-02-10"), "VB", "age-d", "inc-d", "guild"),
    ], S.CUSTOMERS)
    products = spark.createDataFrame([
        (10, "Brindle Kettle", "kitchen", D(100)),
        (11, "Corvid Lantern", "lighting", D(50)),
        (12, "Dapple Spade", "garden", D(30)),
    ], S.PRODUCTS)
    orders = spark.createDataFrame([
        (100, 1, ts("2024-03-01 10:00:00"), "web", D(250)),
        (101, 1, ts("2024-03-01 15:30:00"), "app", D(50)),
        (102, 2, ts("2024-03-03 09:00:00"), "web", D(300)),
        (103, 3, ts("2024-03-04 12:00:00"), "sales", None),
        (104, 4, ts("2024-04-02 08:00:00"), "guild", D(300)),
    ], S.ORDERS)
    items = spark.createDataFrame([
        (100, 10, 2, D(100)),
        (100, 11, 1, D(50)),
        (101, 11, 1, D(50)),
        (102, 10, 3, D(100)),
        (104, 12, 1, D(30)),
        (104, 11, 4, D("67.5")),
    ], S.ORDER_ITEMS)
    return {"customers": customers, "products": products, "orders": orders, "order_items": items}
