"""The fact against a row-by-row computation in plain Python, on random small inputs."""

from __future__ import annotations

import datetime
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from punctual.plans import marts

BASE = datetime.datetime(2018, 1, 30, 22, 0)


def random_raw(seed):
    pick = random.Random(seed)
    ids = [None, *(f"o{i}" for i in range(30))]
    sellers, customers = [f"s{i}" for i in range(5)], [f"c{i}" for i in range(6)]

    def moment():
        late = BASE + datetime.timedelta(hours=pick.randrange(24 * 40))
        return pick.choice([late, late, late, None])

    orders = [
        (order, pick.choice([*customers, None]), pick.choice(["delivered"] * 4 + ["shipped"]))
        + (moment(), moment(), moment())
        for order in [*ids, *ids[:4]]
    ]
    items = [
        (
            pick.choice(ids),
            i,
            "p",
            pick.choice([*sellers, "unlisted", None]),
            pick.choice([None, Decimal(pick.randrange(10_000)) / 100]),
            Decimal(pick.randrange(1000)) / 100,
        )
        for i in range(120)
    ]
    return {
        "orders": orders,
        "order_items": items,
        "customers": [(c, f"X{c}") for c in customers[:5]],
        "sellers": [(s, f"Y{s}") for s in sellers],
    }


SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string,"
    "order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
    "order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string,"
    "price decimal(18,2), freight_value decimal(18,2)",
    "customers": "customer_id string, customer_state string",
    "sellers": "seller_id string, seller_state string",
}


def expected_fact(raw):
    lines = defaultdict(list)
    for order, _, _, seller, price, freight in raw["order_items"]:
        lines[order].append((seller, price, freight))
    customers, sellers = dict(raw["customers"]), dict(raw["sellers"])
    rows = []
    for order, customer, status, bought, delivered, promised in raw["orders"]:
        if status != "delivered" or None in (order, bought, delivered, promised):
            continue
        if order not in lines or customer not in customers:
            continue
        votes = Counter(seller for seller, _, _ in lines[order])
        # NULL sorts before every id
        seller = min(votes, key=lambda s: (-votes[s], s is not None, s or ""))
        if seller not in sellers:
            continue
        day, got, due = bought.date(), delivered.date(), promised.date()
        prices = [price for _, price, _ in lines[order] if price is not None]
        rows.append(
            (
                order,
                day,
                day.year * 100 + day.month,
                seller,
                sellers[seller],
                customers[customer],
                got,
                due,
                (got - due).days,
                got > due,
                (got - day).days,
                len(lines[order]),
                sum(prices) if prices else None,
                sum(freight for _, _, freight in lines[order]),
            )
        )
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_fact_equals_brute_force(spark, seed, hot_rows, monkeypatch):
    monkeypatch.setattr("punctual.operators.joins.AQE_FACTOR", 1e-3)  # size alone makes a key hot
    raw = random_raw(seed)
    tables = {name: spark.createDataFrame(raw[name], SCHEMAS[name]) for name in SCHEMAS}
    found = [tuple(row) for row in marts.staged_fact(tables, marts.hot_orders(tables, hot_rows)).collect()]
    expected = expected_fact(raw)
    assert expected
    assert sorted(found, key=str) == sorted(
        (
            (*row[:12], row[12] if row[12] is None else round(row[12], 9), round(row[13], 9))
            for row in expected
        ),
        key=str,
    )
