from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from frames import fact
from pyspark.sql import functions as F

from punctual.operators.joins import heavy_keys, join_rollup
from punctual.operators.rollup import (
    items_per_order,
    order_rollup,
    order_rollup_by_order,
    order_totals,
    primary_seller,
)
from punctual.plans import bi, marts, reports
from punctual.sources import fixture
from punctual.sources.states import ref_br_state

ITEMS = [
    ("majority", "s2", "10.00", "1.00"),
    ("majority", "s2", "20.00", "2.00"),
    ("majority", "s1", "70.00", "7.00"),
    ("tie", "s9", "1.00", "0.10"),
    ("tie", "s3", "2.00", "0.20"),
    ("single", "s1", "5.00", "0.50"),
    ("unknown", None, "3.00", "0.30"),
    ("unknown", "s1", "3.00", "0.30"),
    ("gap", "s1", None, "0.30"),
    (None, "s1", "1.00", "0.10"),
]


@pytest.fixture(scope="module")
def items(spark):
    raw = spark.createDataFrame(ITEMS, "order_id string, seller_id string, p string, f string")
    return raw.select(
        "order_id",
        "seller_id",
        F.col("p").cast("decimal(38,9)").alias("price"),
        F.col("f").cast("decimal(38,9)").alias("freight_value"),
    )


def test_primary_seller(items):
    picked = {r.order_id: r.seller_id for r in primary_seller(items_per_order(items)).collect()}
    # most items wins over most money; a tie goes to the smallest id, NULL before all
    assert picked == {
        "majority": "s2",
        "tie": "s3",
        "single": "s1",
        "unknown": None,
        "gap": "s1",
        None: "s1",
    }


def test_order_totals_cover_all_sellers(items):
    totals = {r.order_id: r for r in order_totals(items_per_order(items)).collect()}
    assert totals["majority"].item_count == 3
    assert totals["majority"].order_value == Decimal(100)
    assert totals["gap"].order_value is None


def test_one_pass_rollup_is_primary_seller_plus_totals(items):
    per_seller = items_per_order(items)
    a, b = primary_seller(per_seller).alias("a"), order_totals(per_seller).alias("b")
    two_pass = a.join(b, F.col("a.order_id").eqNullSafe(F.col("b.order_id"))).select(
        "a.order_id", "seller_id", "item_count", "order_value", "freight_value"
    )
    for one_pass in (order_rollup(items), order_rollup_by_order(items)):
        assert one_pass.exceptAll(two_pass).isEmpty()
        assert two_pass.exceptAll(one_pass).isEmpty()


def test_one_pass_rollup_on_test_tables(spark, sf_dir):
    staged = marts.stg_order_items(fixture.raw_order_items(spark, sf_dir))
    per_seller = items_per_order(staged)
    two_pass = (
        primary_seller(per_seller)
        .join(order_totals(per_seller), "order_id")
        .select("order_id", "seller_id", "item_count", "order_value", "freight_value")
    )
    for one_pass in (order_rollup(staged), order_rollup_by_order(staged)):
        assert one_pass.exceptAll(two_pass).isEmpty()
        assert two_pass.exceptAll(one_pass).isEmpty()


def raw(spark):
    ts = "2018-01-05 10:00:00"
    orders = [
        ("majority", "c1", "delivered", ts, "2018-01-10 23:59:59", "2018-01-10 00:00:00"),
        ("tie", "c2", "delivered", ts, "2018-01-11 00:00:00", "2018-01-10 23:00:00"),
        ("single", "c1", "shipped", ts, "2018-01-10 00:00:00", "2018-01-12 00:00:00"),
        ("unknown", "c1", "delivered", ts, "2018-01-10 00:00:00", "2018-01-12 00:00:00"),
        ("gap", "c1", "delivered", ts, None, "2018-01-12 00:00:00"),
        ("itemless", "c1", "delivered", ts, "2018-01-10 00:00:00", "2018-01-12 00:00:00"),
        (None, "c1", "delivered", ts, "2018-01-10 00:00:00", "2018-01-12 00:00:00"),
        ("majority", "c3", "delivered", "bad", "2018-01-10 00:00:00", "2018-01-12 00:00:00"),
        ("majority", "c2", "delivered", ts, "2018-01-01 00:00:00", "2018-01-12 00:00:00"),
    ]
    return {
        "orders": spark.createDataFrame(
            orders,
            "order_id string, customer_id string, order_status string,"
            "order_purchase_timestamp string, order_delivered_customer_date string,"
            "order_estimated_delivery_date string",
        ),
        "order_items": spark.createDataFrame(
            [(o, 1, "p", s, p, f) for o, s, p, f in ITEMS],
            "order_id string, order_item_id int, product_id string, seller_id string,"
            "price string, freight_value string",
        ),
        "customers": spark.createDataFrame(
            [("c1", "RJ"), ("c2", "SP"), ("c3", "AC")], "customer_id string, customer_state string"
        ),
        "sellers": spark.createDataFrame(
            [("s1", "MG"), ("s2", "SP"), ("s3", "BA")], "seller_id string, seller_state string"
        ),
    }


def test_fact(spark):
    rows = marts.staged_fact(raw(spark)).orderBy("order_id", "customer_state").collect()
    assert [(r.order_id, r.seller_id, r.customer_state) for r in rows] == [
        ("majority", "s2", "RJ"),
        ("majority", "s2", "SP"),
        ("tie", "s3", "SP"),
    ]
    on_the_day, early, late = rows
    # lateness counts calendar days, not hours
    assert (on_the_day.late_days, on_the_day.is_late, on_the_day.delivery_days) == (0, False, 5)
    assert (early.late_days, early.delivery_days) == (-11, -4)
    assert (late.late_days, late.is_late) == (1, True)
    assert on_the_day.order_month == 201801
    assert on_the_day.order_date == datetime.date(2018, 1, 5)
    # money of the order, not of the primary seller
    assert (on_the_day.item_count, on_the_day.order_value) == (3, Decimal(100))


def repeat(df, times, *ids):
    copies = df.where(F.col("order_id").isin(*ids)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(times)))
    )
    return df.unionByName(copies.drop("copy"))


def test_hot_orders_go_their_own_way_with_the_same_result(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("punctual.operators.joins.AQE_FACTOR", 1e-3)  # size alone makes a key hot
    tables = fixture.raw_tables(spark, sf_dir)
    ids = [r.order_id for r in marts.staged_fact(tables).orderBy("order_id").limit(2).collect()]
    tables["orders"] = repeat(tables["orders"], 3000, ids[0])
    tables["order_items"] = repeat(tables["order_items"], 10_000, ids[1])
    orders = marts.delivered_orders(marts.stg_orders(tables["orders"]))
    items = tables["order_items"]
    assert heavy_keys("order_id", orders, items, min_rows=2000) == ids
    assert heavy_keys("order_id", orders, items) == []
    assert heavy_keys("order_id", orders.where("false"), items.where("false")) == []

    plain, split = marts.staged_fact(tables), marts.staged_fact(tables, marts.hot_orders(tables, 2000))
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in split._jdf.queryExecution().analyzed().toString()
    assert split.exceptAll(plain).isEmpty()
    assert plain.exceptAll(split).isEmpty()
    assert split.where(F.col("order_id") == ids[0]).count() == 3001
    assert split.where(F.col("order_id") == ids[1]).first().item_count > 10_000


def test_a_key_is_hot_by_its_share_too(spark):
    key = F.when(F.col("id") < 7000, 1).otherwise(F.col("id"))
    rows = spark.range(10_000).select(key.alias("k"))
    assert heavy_keys("k", rows, min_rows=1000) == [1]  # 8 partitions: above 5/8 of all rows
    assert heavy_keys("k", rows.where("k > 1 OR rand(1) < 0.2"), min_rows=1000) == []


def test_no_hot_key_is_left_out_for_their_number(spark):
    """300 equally hot keys among 30,000 partitions, and the fact split by all of them."""
    partitions = "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    rows = spark.range(300 * 40).select((F.col("id") % 300).alias("k"))
    try:
        spark.conf.set(partitions, "30000")
        found = heavy_keys("k", rows, min_rows=1)
    finally:
        spark.conf.set(partitions, before)
    assert found == list(range(300))
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    nothing = counts.where(F.raise_error(F.lit("a hot key went the cold way")).isNull())
    both = join_rollup(rows, nothing.where(~F.col("k").isin(found)), counts, "k", found)
    assert both.agg(F.sum("n")).first()[0] == 300 * 40 * 40


def test_dim_seller(spark):
    table = fact(
        spark,
        {"is_late": True, "delivery_days": 4, "freight_value": Decimal("1.005")},
        {"order_date": datetime.date(2018, 2, 1), "freight_value": Decimal("1.005")},
        {"is_late": None},
        {"seller_id": "s2", "seller_state": "MG"},
    )
    dim = {r.seller_id: r for r in marts.dim_seller(table).collect()}
    assert dim["s1"].on_time_rate == 0.6667  # unknown counts as on time
    assert dim["s1"].delivered_orders == 3
    assert dim["s1"].avg_delivery_days == 4.67
    assert dim["s1"].avg_freight_value == Decimal("1.42")
    assert dim["s1"].first_order_date == datetime.date(2018, 1, 5)
    assert dim["s1"].last_order_date == datetime.date(2018, 2, 1)
    assert dim["s2"].seller_state == "MG"


def test_dim_seller_stays_one_row_per_seller(spark):
    table = fact(
        spark,
        {"seller_state": "SP", "delivery_days": None, "freight_value": None},
        {"seller_state": "MG", "delivery_days": None, "freight_value": None},
    )
    row = marts.dim_seller(table).collect()
    assert [(r.seller_state, r.delivered_orders) for r in row] == [("MG", 2)]
    assert (row[0].avg_delivery_days, row[0].avg_freight_value) == (None, None)


# -- BI layer --------------------------------------------------------------------------


def test_reference_states(spark):
    states = ref_br_state(spark)
    assert states.count() == states.select("code").distinct().count() == 27
    regions = {r.region: r["count"] for r in states.groupBy("region").count().collect()}
    assert regions == {"Norte": 7, "Nordeste": 9, "Centro-Oeste": 4, "Sudeste": 4, "Sul": 3}


def test_bi_orders_keeps_unknown_states(spark):
    orders = bi.bi_orders(
        fact(spark, {"customer_state": "SP"}, {"customer_state": "XX"}, {"customer_state": None}),
        ref_br_state(spark),
    )
    got = {r.customer_state: r for r in orders.collect()}
    assert got["SP"].customer_state_geo == "São Paulo, Brazil"
    assert got["SP"].customer_region_code == "BR-SP"
    assert (got["XX"].customer_region_code, got["XX"].customer_state_geo) == ("BR-XX", None)
    assert got[None].customer_region_code is None


def test_calendar_spans_whole_months(spark):
    days = bi.bi_calendar(
        fact(
            spark,
            {"order_date": datetime.date(2017, 12, 30)},
            {"order_date": datetime.date(2018, 2, 2)},
        )
    )
    rows = days.orderBy("date").collect()
    assert len(rows) == 31 + 31 + 28
    assert rows[0].date == datetime.date(2017, 12, 1)
    assert rows[-1].date == datetime.date(2018, 2, 28)
    assert (rows[0].year, rows[0].month_number) == (2017, 12)
    assert (rows[0].month_label, rows[0].order_month) == ("Dec 2017", 201712)
    assert bi.bi_calendar(fact(spark)).isEmpty()


def test_trend_shows_months_without_orders_as_gap(spark):
    table = fact(
        spark,
        {"order_date": datetime.date(2017, 12, 30), "order_month": 201712},
        {"order_date": datetime.date(2018, 2, 2), "order_month": 201802},
    )
    orders = bi.bi_orders(table, ref_br_state(spark))
    trend = reports.monthly_trend(orders, bi.bi_calendar(table))
    assert [(r.month_label, r.delivered_orders, r.on_time_rate) for r in trend.collect()] == [
        ("Dec 2017", 1, 1.0),
        ("Jan 2018", None, None),
        ("Feb 2018", 1, 1.0),
    ]
    assert reports.trend_above_floor(trend, 1).count() == 2


def test_star_keeps_orders_of_the_blank_member(spark):
    table = fact(spark, *[{"seller_id": "big"}] * 20, {"seller_id": "small"})
    orders = bi.bi_orders(table, ref_br_state(spark))
    board = bi.bi_seller_leaderboard(marts.dim_seller(table))
    joined = reports.star(orders, bi.bi_calendar(table), board)
    assert joined.count() == 21
    assert joined.where("ranked_seller_id IS NULL").count() == 1
    # the blank member would not even show up as a top seller
    assert [r.seller_id for r in reports.top_sellers(orders, board).collect()] == ["big"]
    coverage = {
        r.on_leaderboard: r.delivered_orders
        for r in reports.leaderboard_coverage(orders, board).collect()
    }
    assert coverage == {True: 20, False: 1}


def test_top_sellers_break_ties_by_id(spark):
    rows = [{"seller_id": f"s{i:02}"} for i in range(12) for _ in range(20)]
    table = fact(spark, *rows)
    orders = bi.bi_orders(table, ref_br_state(spark))
    board = bi.bi_seller_leaderboard(marts.dim_seller(table))
    top = [r.seller_id for r in reports.top_sellers(orders, board).collect()]
    assert top == [f"s{i:02}" for i in range(10)]


def test_state_ranking_and_spread(spark):
    table = fact(
        spark,
        {"customer_state": "SP"},
        {"customer_state": "AL", "is_late": True},
        {"customer_state": "AL"},
    )
    orders = bi.bi_orders(table, ref_br_state(spark))
    ranked = reports.state_ranking(orders).collect()
    assert [r.customer_state_name for r in ranked] == ["Alagoas", "São Paulo"]
    row = reports.state_spread(orders).first()
    assert (row.worst_state, row.best_state, row.spread) == ("Alagoas", "São Paulo", 0.5)
