"""The persistent layer: tables and views that any session or tool finds in the catalog.

Catalog views are stored as SQL text, so this is the one place that states the staging and
BI views as SQL. A test reads each view by its catalog name and compares it with the
DataFrame that the rest of the package uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from punctual.contracts import (
    COUNTRY_PREFIX,
    COUNTRY_SUFFIX,
    DIM_SELLER,
    FACT_OPT,
    LEADERBOARD_FLOOR,
    NUMERIC,
)
from punctual.functions.scalar import TIMESTAMP_TEXT, ZONED_TEXT
from punctual.sources.states import ref_br_state
from punctual.sources.warehouse import Warehouse

UTC = (
    "(timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, cast("
    "cast(unix_micros({0}) as decimal(18,0)) / cast(1000000 as decimal(7,0)) as decimal(18,6))))"
)
PER_ORDER = """count(1) AS orders,
  round(avg(CASE WHEN is_late THEN 0 ELSE 1 END), 4) AS on_time_rate,
  round(avg(CASE WHEN is_late THEN 0 ELSE 100 END), 2) AS on_time_pct,
  round(avg(delivery_days), 2) AS avg_delivery_days,
  round(cast(try_divide(sum(freight_value), count(freight_value)) as {numeric}), 2)
    AS avg_freight_value"""


def _text(pattern: str) -> str:
    """A string literal, with backslashes as the parser wants them."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _timestamp(df: DataFrame, name: str) -> str:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return UTC.format(name)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return f"cast({name} as timestamp_ntz)"
    text = f"cast({name} as string)"
    zoned = UTC.format(f"try_cast({text} as timestamp)")
    return (
        f"CASE WHEN {text} rlike {_text(ZONED_TEXT)} THEN {zoned}"
        f" WHEN {text} rlike {_text(TIMESTAMP_TEXT)} THEN try_cast({text} as timestamp_ntz) END"
    )


def view_texts(warehouse: Warehouse, database: str, states: DataFrame) -> dict[str, str]:
    """The query of each view, by name, in the order in which they can be created."""
    orders = warehouse.read("orders")
    opt, dim = f"{database}.{FACT_OPT}", f"{database}.{DIM_SELLER}"
    rates = PER_ORDER.format(numeric=NUMERIC)
    # the reference has a row per state: it is stored inline, whatever table it came from
    rows = ", ".join(
        f"({', '.join(_text(str(v)) for v in (r['code'], r['name'], r['region']))})"
        for r in states.select("code", "name", "region").collect()
    )
    region_code = f"concat('{COUNTRY_PREFIX}', customer_state) AS customer_region_code"
    return {
        "stg_orders": f"""SELECT order_id, customer_id, order_status,
            {_timestamp(orders, "order_purchase_timestamp")} AS purchased_at,
            {_timestamp(orders, "order_delivered_customer_date")} AS delivered_at,
            {_timestamp(orders, "order_estimated_delivery_date")} AS estimated_at
            FROM {database}.orders""",
        "stg_order_items": f"""SELECT order_id, order_item_id, product_id, seller_id,
            try_cast(price as {NUMERIC}) AS price,
            try_cast(freight_value as {NUMERIC}) AS freight_value FROM {database}.order_items""",
        "ref_br_state": f"SELECT * FROM VALUES {rows} AS states (code, name, region)",
        "vw_bi_orders": f"""SELECT order_id, order_date, order_month, seller_id, seller_state,
            customer_state, {region_code}, s.name AS customer_state_name,
            s.region AS customer_region,
            concat(s.name, '{COUNTRY_SUFFIX}') AS customer_state_geo, delivered_date,
            estimated_date, delivery_days, late_days, is_late,
            cast(CASE WHEN is_late THEN 0 ELSE 1 END as bigint) AS on_time_flag,
            cast(CASE WHEN is_late THEN 0 ELSE 100 END as bigint) AS on_time_pct,
            item_count, order_value, freight_value
            FROM {opt} f LEFT JOIN {database}.ref_br_state s ON s.code = f.customer_state""",
        "vw_bi_monthly": f"""SELECT order_month,
            to_date(cast(order_month as string), 'yyyyMM') AS month_start, {rates},
            round(sum(order_value), 2) AS order_value FROM {opt} GROUP BY order_month""",
        "vw_bi_by_state": f"""SELECT customer_state, {region_code}, {rates}
            FROM {opt} GROUP BY customer_state""",
        "vw_bi_seller_leaderboard": f"""SELECT seller_id, seller_state, delivered_orders,
            on_time_rate, round(on_time_rate * 100, 2) AS on_time_pct, avg_delivery_days,
            avg_freight_value, first_order_date, last_order_date
            FROM {dim} WHERE delivered_orders >= {LEADERBOARD_FLOOR}""",
        "vw_bi_calendar": f"""SELECT date, trunc(date, 'MM') AS month_start,
            cast(year(date) as bigint) AS year, cast(month(date) as bigint) AS month_number,
            date_format(date, 'MMM yyyy') AS month_label,
            cast(year(date) * 100 + month(date) as bigint) AS order_month
            FROM (SELECT explode(sequence(trunc(min(order_date), 'MM'),
                last_day(max(order_date)), interval 1 day)) AS date FROM {opt}
              WHERE order_month = (SELECT min(order_month) FROM {opt})
                 OR order_month = (SELECT max(order_month) FROM {opt}))""",
    }


def publish(warehouse: Warehouse, database: str, states: DataFrame | None = None) -> None:
    """Create or replace the tables and all views of the layer in ``database``."""
    spark = warehouse.spark
    warehouse.publish(database)
    states = ref_br_state(spark) if states is None else states
    for name, text in view_texts(warehouse, database, states).items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
