"""The report queries over the star: order view, calendar and seller leaderboard."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.measures import (
    DELIVERED_ORDERS,
    all_measures,
    avg_delivery_days,
    delivered_orders,
    on_time_rate,
)


def headline(fact: DataFrame) -> DataFrame:
    """The one-row summary: volume, date range, punctuality, speed and slack."""
    return fact.agg(
        delivered_orders(),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.avg(F.when(F.col("is_late"), 0).otherwise(1)).alias("on_time_rate"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg(-F.col("late_days")).alias("avg_slack_days"),
    )


def star(orders: DataFrame, calendar: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Orders with their calendar day and leaderboard seller.

    Both links are one-to-many from the dimension; an order without a member keeps its
    row under the blank member, whose columns are NULL.
    """
    days = calendar.select(
        F.col("date").alias("calendar_date"),
        F.col("month_start").alias("calendar_month_start"),
        F.col("month_label").alias("calendar_month_label"),
    )
    ranked = leaderboard.select(
        F.col("seller_id").alias("ranked_seller_id"),
        F.col("seller_state").alias("ranked_seller_state"),
    )
    return orders.join(days, orders.order_date == days.calendar_date, "left").join(
        ranked, orders.seller_id == ranked.ranked_seller_id, "left"
    )


def slice_orders(
    orders: DataFrame,
    date_from: datetime.date | None = None,
    date_to: datetime.date | None = None,
    region: str | None = None,
) -> DataFrame:
    """The page slicers: date between, region equals.

    A date range implies a month range. Stating it lets the scan skip whole month
    folders, which a filter on the date alone would not.
    """
    if date_from is not None:
        orders = orders.where(
            (F.col("order_date") >= F.lit(date_from))
            & (F.col("order_month") >= date_from.year * 100 + date_from.month)
        )
    if date_to is not None:
        orders = orders.where(
            (F.col("order_date") <= F.lit(date_to))
            & (F.col("order_month") <= date_to.year * 100 + date_to.month)
        )
    if region is not None:
        orders = orders.where(F.col("customer_region") == region)
    return orders


def measures_total(orders: DataFrame) -> DataFrame:
    return orders.agg(*all_measures())


def measures_by_region(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_region").agg(*all_measures())


def state_ranking(orders: DataFrame) -> DataFrame:
    """States by on-time rate, worst first."""
    return (
        orders.groupBy("customer_state_name")
        .agg(on_time_rate(), delivered_orders())
        .orderBy("on_time_rate", "customer_state_name")
    )


def state_spread(orders: DataFrame) -> DataFrame:
    """The worst and the best state with their rates, and the points between them."""
    ranked = state_ranking(orders)
    key = F.struct("on_time_rate", "customer_state_name")
    return ranked.agg(
        F.min(key).alias("worst"),
        F.max(key).alias("best"),
    ).select(
        F.col("worst.customer_state_name").alias("worst_state"),
        F.col("worst.on_time_rate").alias("worst_rate"),
        F.col("best.customer_state_name").alias("best_state"),
        F.col("best.on_time_rate").alias("best_rate"),
        (F.col("best.on_time_rate") - F.col("worst.on_time_rate")).alias("spread"),
    )


def monthly_trend(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Volume and rate per calendar month, in time order.

    Orders are grouped to months first; the calendar supplies the months without
    orders, which stay as a gap (NULL), not as a zero.
    """
    months = calendar.select("order_month", "month_start", "month_label").distinct()
    monthly = orders.groupBy("order_month").agg(delivered_orders(), on_time_rate())
    return (
        months.join(monthly, "order_month", "left")
        .orderBy("order_month")
        .select("order_month", "month_start", "month_label", DELIVERED_ORDERS, "on_time_rate")
    )


def star_members(orders: DataFrame, calendar: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Orders per calendar month and ranked seller state; the blank member included.

    Orders are counted per day and seller before they meet their members.
    """
    per_link = orders.groupBy("order_date", "seller_id").agg(delivered_orders())
    return (
        star(per_link, calendar, leaderboard)
        .groupBy("calendar_month_start", "ranked_seller_state")
        .agg(F.sum(DELIVERED_ORDERS).alias(DELIVERED_ORDERS))
    )


def trend_above_floor(trend: DataFrame, floor: int) -> DataFrame:
    """The trend without months of too little volume to carry a rate."""
    return trend.where(F.col(DELIVERED_ORDERS) >= floor)


def top_sellers(orders: DataFrame, leaderboard: DataFrame, k: int = 10) -> DataFrame:
    """The k leaderboard sellers with the most delivered orders in ``orders``.

    Orders are grouped by seller before the join, so the join sees one row per seller.
    The inner join leaves out the blank member; the id breaks ties.
    """
    per_seller = orders.groupBy("seller_id").agg(
        delivered_orders(), on_time_rate(), avg_delivery_days()
    )
    return (
        leaderboard.select("seller_id", "seller_state")
        .join(per_seller, "seller_id")
        .orderBy(F.desc(DELIVERED_ORDERS), "seller_id")
        .limit(k)
    )


def leaderboard_coverage(orders: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Orders and rate with and without a leaderboard seller."""
    per_seller = orders.groupBy("seller_id").agg(
        delivered_orders(), F.sum("on_time_flag").alias("on_time")
    )
    members = leaderboard.select("seller_id", F.lit(True).alias("on_leaderboard"))
    return (
        per_seller.join(members, "seller_id", "left")
        .groupBy(F.coalesce("on_leaderboard", F.lit(False)).alias("on_leaderboard"))
        .agg(
            F.sum(DELIVERED_ORDERS).alias(DELIVERED_ORDERS),
            (F.sum("on_time") / F.sum(DELIVERED_ORDERS)).alias("on_time_rate"),
        )
    )
