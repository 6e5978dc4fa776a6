"""Small hand-made frames shared by the tests."""

from __future__ import annotations

import datetime
from decimal import Decimal

FACT_SCHEMA = """order_id string, order_date date, order_month bigint, seller_id string,
seller_state string, customer_state string, delivered_date date, estimated_date date,
late_days bigint, is_late boolean, delivery_days bigint, item_count bigint,
order_value decimal(38,9), freight_value decimal(38,9)"""

GOOD = {
    "order_id": "o1",
    "order_date": datetime.date(2018, 1, 5),
    "order_month": 201801,
    "seller_id": "s1",
    "seller_state": "SP",
    "customer_state": "RJ",
    "delivered_date": datetime.date(2018, 1, 10),
    "estimated_date": datetime.date(2018, 1, 12),
    "late_days": -2,
    "is_late": False,
    "delivery_days": 5,
    "item_count": 1,
    "order_value": Decimal("10.50"),
    "freight_value": Decimal("2.25"),
}


def fact(spark, *changes):
    """One good row per entry of ``changes``, with that entry's values put in."""
    rows = [
        tuple({**GOOD, "order_id": f"o{i}", **change}.values()) for i, change in enumerate(changes)
    ]
    return spark.createDataFrame(rows, FACT_SCHEMA)


def bad_rows(report):
    """check name -> bad rows, of the checks that failed."""
    return {row.check_name: row.bad_rows for row in report.collect() if row.status == "FAIL"}
