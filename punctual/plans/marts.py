"""Staging, the delivered-order fact and the seller dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.contracts import (
    DELIVERED,
    DIM_SELLER,
    FACT,
    FACT_COLUMNS,
    NUMERIC,
    RAW_TABLES,
)
from punctual.functions.scalar import (
    days_between,
    month_key,
    safe_numeric,
    safe_timestamp,
)
from punctual.operators.joins import HOT_ROWS, heavy_keys, hot_in, join_rollup
from punctual.operators.rollup import order_rollup, order_rollup_by_order
from punctual.sources.warehouse import Warehouse


def stg_orders(orders: DataFrame) -> DataFrame:
    """Orders with typed timestamps; nothing is filtered."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        safe_timestamp(orders, "order_purchase_timestamp").alias("purchased_at"),
        safe_timestamp(orders, "order_delivered_customer_date").alias("delivered_at"),
        safe_timestamp(orders, "order_estimated_delivery_date").alias("estimated_at"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    """Order items with exact money; nothing is filtered."""
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        safe_numeric("price").alias("price"),
        safe_numeric("freight_value").alias("freight_value"),
    )


def delivered_orders(staged: DataFrame) -> DataFrame:
    """Delivered orders with all three dates, as dates: narrow before any shuffle."""
    return staged.where(
        (F.col("order_status") == DELIVERED)
        & F.col("delivered_at").isNotNull()
        & F.col("estimated_at").isNotNull()
        & F.col("purchased_at").isNotNull()
    ).select(
        "order_id",
        "customer_id",
        F.to_date("purchased_at").alias("order_date"),
        F.to_date("delivered_at").alias("delivered_date"),
        F.to_date("estimated_at").alias("estimated_date"),
    )


def fct_delivery_performance(
    staged_orders: DataFrame,
    staged_items: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    hot_orders: list | None = None,
) -> DataFrame:
    """One row per delivered order, attributed to its primary seller.

    Customers join first, while order rows are narrow. The item rollup is already
    partitioned by order, so that join shuffles the order side only. No table is forced
    to broadcast: customers and sellers grow with the data, and the optimizer knows
    their size; a hot customer or seller is split by adaptive execution. ``hot_orders``,
    which a job finds beforehand, are rolled up apart.
    """
    delivered = delivered_orders(staged_orders)
    orders = delivered.join(
        customers.select("customer_id", "customer_state"), "customer_id"
    ).drop("customer_id")
    by_order, spread = order_rollup_by_order(staged_items), order_rollup(staged_items)
    late_days = days_between(F.col("delivered_date"), F.col("estimated_date"))
    return (
        join_rollup(orders, by_order, spread, "order_id", hot_orders or [])
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
        .withColumns(
            {
                "order_month": month_key(F.col("order_date")),
                "late_days": late_days,
                "is_late": late_days > 0,
                "delivery_days": days_between(F.col("delivered_date"), F.col("order_date")),
            }
        )
        .select(*FACT_COLUMNS)
    )


def dim_seller(fact: DataFrame) -> DataFrame:
    """One row per seller that is primary on at least one delivered order.

    The state depends on the seller alone, but picking it by an aggregate on text would
    sort the whole fact. As a grouping key it is hashed; a second, small aggregation over
    the sellers then keeps one row each even where the state is not unique.
    """
    per_state = fact.groupBy("seller_id", "seller_state").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("is_late").alias("late"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("timed"),
        F.sum("freight_value").alias("freight"),
        F.count("freight_value").alias("priced"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
    )
    orders, late = F.sum("orders"), F.sum("late")
    mean_days = F.try_divide(F.sum("days"), F.sum("timed"))
    mean_freight = F.try_divide(F.sum("freight"), F.sum("priced")).cast(NUMERIC)
    return per_state.groupBy("seller_id").agg(
        F.min("seller_state").alias("seller_state"),
        orders.alias("delivered_orders"),
        # an integer numerator: 1 - late/orders could land just under a rounding tie
        F.round(F.try_divide(orders - late, orders), 4).alias("on_time_rate"),
        F.round(mean_days, 2).alias("avg_delivery_days"),
        F.round(mean_freight, 2).alias("avg_freight_value"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
    )


def hot_orders(raw: dict[str, DataFrame], hot_rows: int = HOT_ROWS) -> list:
    """Orders that are too large for one task. This runs a job."""
    return heavy_keys("order_id", raw["orders"], raw["order_items"], min_rows=hot_rows)


def known_hot_orders(warehouse: Warehouse, hot_rows: int = HOT_ROWS) -> list | None:
    """The same from what the load observed, without a job; None if it observed nothing."""
    tables = ("orders", "order_items")
    seen = [warehouse.stats(t) if warehouse.exists(t) else {} for t in tables]
    if not all("top" in sketch for sketch in seen):
        return None
    partitions = int(warehouse.spark.conf.get("spark.sql.shuffle.partitions"))
    return hot_in(seen, partitions, hot_rows)


def staged_fact(raw: dict[str, DataFrame], hot: list | None = None) -> DataFrame:
    return fct_delivery_performance(
        stg_orders(raw["orders"]),
        stg_order_items(raw["order_items"]),
        raw["customers"],
        raw["sellers"],
        hot,
    )


def _span(key: str) -> list[Column]:
    """What tells the gate how close a table's keys are; the write sees them anyway."""
    return [
        F.count(key).alias("rows"),
        F.min(key).alias("low"),
        F.max(key).alias("high"),
    ]


def build_marts(
    warehouse: Warehouse, raw: dict[str, DataFrame] | None = None, hot_rows: int = HOT_ROWS
) -> None:
    """Replace the fact and the dimension, which reads the written fact, in one commit.

    Without ``raw`` the marts are those of the warehouse's own raw tables, whose load has
    observed which orders are hot. Tables from elsewhere are looked through by a job.
    """
    hot = known_hot_orders(warehouse, hot_rows) if raw is None else None
    if raw is None:
        raw = {table: warehouse.read(table) for table in RAW_TABLES}
    if hot is None:
        hot = hot_orders(raw, hot_rows)
    # the dimension needs the written fact before anybody else may see it
    draft = warehouse.draft()
    fact = draft.replace(FACT, staged_fact(raw, hot), observe=_span("order_id"))
    draft.replace(DIM_SELLER, dim_seller(fact), observe=_span("seller_id"))
    warehouse.commit_all(draft.staged)
