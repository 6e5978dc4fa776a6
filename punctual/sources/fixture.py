"""Adapter from the order-management test tables to the four raw tables.

Only this module knows the test tables. They hold neither a promised nor a delivery
date, so both are derived: the *clean* variant makes dates every check accepts, the
*dirty* variant takes the last ship date, which is unrelated to the purchase date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_COUNT = 25
QUARTER = (199801, 199803)
HALF_YEAR = (199801, 199806)
ONE_STATE = "AD"
MONTH_BOUNDS = (199501, 200112, 1)


TABLES = ("orders", "lineitem", "customer", "supplier", "nation", "region", "events")


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def paths(sf_dir: str) -> list[str]:
    return [path(sf_dir, name) for name in TABLES]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def _state_code(nation_key: str) -> Column:
    return F.expr(f"concat(char(65 + {nation_key} div 5), char(65 + {nation_key} % 5))")


def raw_orders(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if dirty:
        shipped = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.max("l_shipdate").alias("delivered_at"))
        )
        orders = orders.join(shipped, "o_orderkey", "left")
    else:
        transit = F.expr("make_dt_interval(cast(3 + (o_orderkey * 7) % 26 as int))")
        orders = orders.withColumn(
            "delivered_at", F.when(F.expr("o_orderkey % 97 != 0"), F.col("o_orderdate") + transit)
        )
    promised = F.expr("make_dt_interval(14 + 3 * cast(substr(o_orderpriority, 1, 1) as int))")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("delivered_at").alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + promised).alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        # each factor becomes exact before the product
        (price * F.col("l_discount").cast("decimal(4,2)")).alias("freight_value"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), _state_code("c_nationkey").alias("customer_state")
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seller_id"), _state_code("s_nationkey").alias("seller_state")
    )


def raw_tables(spark: SparkSession, sf_dir: str, dirty: bool = False) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir, dirty),
        "order_items": raw_order_items(spark, sf_dir),
        "customers": raw_customers(spark, sf_dir),
        "sellers": raw_sellers(spark, sf_dir),
    }


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counterpart of the reference states: nations with their region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        _state_code("n_nationkey").alias("code"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
    )


def _where(condition: str, column: str, changed: str) -> Column:
    return F.expr(f"CASE WHEN {condition} THEN {changed} ELSE {column} END")


def damaged_marts(fact: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A fact and a dimension with defects of each kind the mart gate looks for."""
    fact = fact.unionByName(fact.where("order_id % 11 = 0")).withColumns(
        {
            "order_date": _where("order_id % 13 = 0", "order_date", "NULL"),
            "order_month": _where("order_id % 17 = 0", "order_month", "order_month + 1"),
            "order_value": _where("order_id % 19 = 0", "order_value", "-order_value"),
            "delivered_date": _where(
                "order_id % 23 = 0", "delivered_date", "date_sub(order_date, 1)"
            ),
            "is_late": _where("order_id % 29 = 0", "is_late", "NULL"),
            "delivery_days": _where("order_id % 31 = 0", "delivery_days", "delivery_days + 400"),
        }
    )
    dim = dim.where("seller_id % 5 <> 0")
    dim = dim.unionByName(dim.where("seller_id % 7 = 0")).withColumn(
        "on_time_rate", _where("seller_id % 3 = 0", "on_time_rate", "on_time_rate + 1")
    )
    return fact, dim


def damaged_layer(opt: DataFrame, views: dict[str, DataFrame]) -> tuple[DataFrame, dict]:
    """A copy and BI views with defects of each kind the BI gate looks for."""
    orders, monthly, by_state, board, calendar, states = (
        views[name]
        for name in (
            "vw_bi_orders", "vw_bi_monthly", "vw_bi_by_state", "vw_bi_seller_leaderboard",
            "vw_bi_calendar", "ref_br_state",
        )
    )
    return opt.where("NOT (is_late AND order_id % 2 = 0)"), {
        "vw_bi_orders": orders.where("order_id % 43 <> 0").withColumns(
            {
                "on_time_pct": _where("order_id % 47 = 0", "on_time_pct", "on_time_pct + 1"),
                "customer_region": _where("customer_state = 'AD'", "customer_region", "NULL"),
            }
        ),
        "vw_bi_monthly": monthly.withColumns(
            {
                "orders": _where("order_month % 2 = 0", "orders", "orders + 1"),
                "month_start": _where(
                    "order_month % 3 = 0", "month_start", "add_months(month_start, 1)"
                ),
                "on_time_rate": _where("order_month % 5 = 0", "on_time_rate", "on_time_rate + 1"),
            }
        ),
        "vw_bi_by_state": by_state.where("customer_state <> 'AD'").withColumn(
            "customer_region_code",
            _where("customer_state > 'C'", "customer_region_code", "lower(customer_region_code)"),
        ),
        "vw_bi_seller_leaderboard": board.withColumns(
            {
                "on_time_pct": _where("seller_id % 3 = 0", "on_time_pct", "on_time_pct + 1"),
                "delivered_orders": _where(
                    "seller_id % 4 = 0", "delivered_orders", "delivered_orders - 1000"
                ),
            }
        ),
        "vw_bi_calendar": calendar.where("day(date) <> 15"),
        "ref_br_state": states.where("code <> 'AA'"),
    }
