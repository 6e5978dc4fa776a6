"""The BI layer: the views a report reads, over the partitioned fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.contracts import (
    COUNTRY_PREFIX,
    COUNTRY_SUFFIX,
    DIM_SELLER,
    FACT_OPT,
    LEADERBOARD_FLOOR,
)
from punctual.functions.scalar import flag, mean_money, month_key, month_label, month_start
from punctual.sources.warehouse import Warehouse


def region_code() -> Column:
    return F.concat(F.lit(COUNTRY_PREFIX), F.col("customer_state")).alias("customer_region_code")


def bi_orders(opt: DataFrame, states: DataFrame, *carried: str) -> DataFrame:
    """Detail view: the fact with state names, region and flags. No row is dropped.

    ``carried`` are further columns of ``opt`` to pass on, such as where a row was read.
    """
    named = states.select(
        F.col("code").alias("customer_state"),
        F.col("name").alias("customer_state_name"),
        F.col("region").alias("customer_region"),
    )
    return opt.join(named, "customer_state", "left").select(
        "order_id",
        "order_date",
        "order_month",
        "seller_id",
        "seller_state",
        "customer_state",
        region_code(),
        "customer_state_name",
        "customer_region",
        F.concat("customer_state_name", F.lit(COUNTRY_SUFFIX)).alias("customer_state_geo"),
        "delivered_date",
        "estimated_date",
        "delivery_days",
        "late_days",
        "is_late",
        flag(F.col("is_late"), 1).alias("on_time_flag"),
        flag(F.col("is_late"), 100).alias("on_time_pct"),
        "item_count",
        "order_value",
        "freight_value",
        *carried,
    )


def _rates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("orders"),
        F.round(F.avg(flag(F.col("is_late"), 1)), 4).alias("on_time_rate"),
        F.round(F.avg(flag(F.col("is_late"), 100)), 2).alias("on_time_pct"),
        F.round(F.avg("delivery_days"), 2).alias("avg_delivery_days"),
        F.round(mean_money("freight_value"), 2).alias("avg_freight_value"),
    ]


def bi_monthly(opt: DataFrame) -> DataFrame:
    """Monthly trend. The month's first day is derived after the grouping."""
    return (
        opt.groupBy("order_month")
        .agg(*_rates(), F.round(F.sum("order_value"), 2).alias("order_value"))
        .select(
            "order_month",
            month_start(F.col("order_month")).alias("month_start"),
            "orders",
            "on_time_rate",
            "on_time_pct",
            "avg_delivery_days",
            "avg_freight_value",
            "order_value",
        )
    )


def bi_by_state(opt: DataFrame) -> DataFrame:
    """Geography: delays and freight per customer state."""
    return (
        opt.groupBy("customer_state")
        .agg(*_rates())
        .select(
            "customer_state",
            region_code(),
            "orders",
            "on_time_rate",
            "on_time_pct",
            "avg_delivery_days",
            "avg_freight_value",
        )
    )


def bi_seller_leaderboard(dim: DataFrame, floor: int = LEADERBOARD_FLOOR) -> DataFrame:
    """Sellers with enough delivered orders for their rate to mean something."""
    return dim.where(F.col("delivered_orders") >= floor).select(
        "seller_id",
        "seller_state",
        "delivered_orders",
        "on_time_rate",
        F.round(F.col("on_time_rate") * 100, 2).alias("on_time_pct"),
        "avg_delivery_days",
        "avg_freight_value",
        "first_order_date",
        "last_order_date",
    )


def bi_calendar(opt: DataFrame) -> DataFrame:
    """One row per day, from the first day of the first month to the last of the last.

    The months name the copy's folders: the first and the last are found without reading a
    column, and dates are read in these two only. No orders means no days.
    """
    month = F.col("order_month")
    ends = opt.agg(F.struct(F.min(month).alias("first"), F.max(month).alias("last"))).scalar()
    bounds = opt.where((month == ends["first"]) | (month == ends["last"])).agg(
        F.trunc(F.min("order_date"), "MM").alias("first"),
        F.last_day(F.max("order_date")).alias("last"),
    )
    day = F.col("date")
    return bounds.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    ).select(
        day,
        F.trunc(day, "MM").alias("month_start"),
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month_number"),
        month_label(day).alias("month_label"),
        month_key(day).alias("order_month"),
    )


def bi_views(warehouse: Warehouse, states: DataFrame) -> dict[str, DataFrame]:
    """All BI views over the written marts, by name. Lazy, like a SQL view."""
    opt, dim = warehouse.read(FACT_OPT), warehouse.read(DIM_SELLER)
    return {
        "ref_br_state": states,
        "vw_bi_orders": bi_orders(opt, states),
        "vw_bi_monthly": bi_monthly(opt),
        "vw_bi_by_state": bi_by_state(opt),
        "vw_bi_seller_leaderboard": bi_seller_leaderboard(dim),
        "vw_bi_calendar": bi_calendar(opt),
    }


def register_views(views: dict[str, DataFrame]) -> None:
    """Create or replace each view, so that SQL can name it."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
