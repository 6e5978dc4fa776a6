"""Order items rolled up to one row per order, and the order's primary seller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def items_per_order(items: DataFrame) -> DataFrame:
    """Items and money per (order, seller). Combined map-side before the shuffle."""
    return items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("price").alias("order_value"),
        F.sum("freight_value").alias("freight_value"),
    )


def primary_seller(per_seller: DataFrame) -> DataFrame:
    """The seller with the most items of each order, ties to the smallest id.

    ``row_number`` with a filter on 1 becomes a group limit that already runs before
    the shuffle, so even one huge order sends one row per task.
    """
    ranked = Window.partitionBy("order_id").orderBy(
        F.desc("item_count"), F.asc_nulls_first("seller_id")
    )
    return (
        per_seller.withColumn("rn", F.row_number().over(ranked))
        .where("rn = 1")
        .select("order_id", "seller_id")
    )


def order_totals(per_seller: DataFrame) -> DataFrame:
    """Items and money per order, over all its sellers."""
    return per_seller.groupBy("order_id").agg(
        F.sum("item_count").alias("item_count"),
        F.sum("order_value").alias("order_value"),
        F.sum("freight_value").alias("freight_value"),
    )


def _lead() -> Column:
    """Orders sellers so that the smallest is primary: most items, then smallest id."""
    return F.struct((-F.col("item_count")).alias("fewest"), F.col("seller_id"))


def _with_primary(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "order_id",
        F.col("lead.seller_id").alias("seller_id"),
        "item_count",
        "order_value",
        "freight_value",
    )


def order_rollup(items: DataFrame) -> DataFrame:
    """Primary seller and totals of each order, for orders of any size.

    Both come out of the same second aggregation, so items are read once and no join is
    needed. Both aggregations combine map-side: a hot order or seller reaches its
    reducer as one row per task. The price is two shuffles.
    """
    return _with_primary(
        items_per_order(items)
        .groupBy("order_id")
        .agg(
            F.min(_lead()).alias("lead"),
            F.sum("item_count").alias("item_count"),
            F.sum("order_value").alias("order_value"),
            F.sum("freight_value").alias("freight_value"),
        )
    )


def order_rollup_by_order(items: DataFrame) -> DataFrame:
    """The same rollup with one shuffle and one sort, for orders that each fit a task.

    Items are partitioned by order and sorted by (order, seller) once. That serves the
    count per seller, the aggregation per order, which streams over the sorted rows, and
    the later join by order. Combining map-side would save next to nothing, because few
    items share order and seller. Hot orders must be kept out.
    """
    per_seller = Window.partitionBy("order_id", "seller_id")
    return _with_primary(
        items.select("order_id", "seller_id", "price", "freight_value")
        .repartition("order_id")
        .withColumn("item_count", F.count(F.lit(1)).over(per_seller))
        .groupBy("order_id")
        .agg(
            F.min(_lead()).alias("lead"),
            F.count(F.lit(1)).alias("item_count"),
            F.sum("price").alias("order_value"),
            F.sum("freight_value").alias("freight_value"),
        )
    )
