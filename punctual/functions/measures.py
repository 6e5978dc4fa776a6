"""The six report measures, as aggregate columns over the order view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual.functions.scalar import mean_money

DELIVERED_ORDERS = "delivered_orders"
ON_TIME_RATE = "on_time_rate"


def delivered_orders() -> Column:
    return F.count(F.lit(1)).alias(DELIVERED_ORDERS)


def on_time_rate() -> Column:
    return F.avg("on_time_flag").alias(ON_TIME_RATE)


def late_orders() -> Column:
    return F.count_if("is_late").alias("late_orders")


def avg_delivery_days() -> Column:
    return F.avg("delivery_days").alias("avg_delivery_days")


def avg_freight() -> Column:
    return mean_money("freight_value").alias("avg_freight")


def order_value() -> Column:
    return F.sum("order_value").alias("order_value")


def all_measures() -> list[Column]:
    return [
        delivered_orders(),
        on_time_rate(),
        late_orders(),
        avg_delivery_days(),
        avg_freight(),
        order_value(),
    ]
