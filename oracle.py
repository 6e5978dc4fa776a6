"""The registered queries once more, as plain SQL over the test tables for DuckDB.

Written independently of the Spark plans: money is integer arithmetic in 1/100 or
1/10000 units, and rounding is integer division, so no engine's floating point or
decimal rules enter the expected values.
"""

from __future__ import annotations

import re

# Names and texts of the checks, as the reports print them.
MART_CHECKS = {
    "fct_is_empty": "the fact table holds at least one row",
    "fct_duplicate_order_id": "each order_id occurs once in the fact",
    "fct_null_key": "order_id, seller_id and order_date are always set",
    "order_month_mismatch": "order_month is the year and month of order_date",
    "fct_orphan_seller": "each seller of the fact is in dim_seller",
    "negative_money": "order value and freight are not below zero",
    "delivered_before_purchase": "no delivery precedes its purchase",
    "null_late_flag": "lateness is known for every delivered order",
    "implausible_delivery_days": "delivery took between 0 and 365 days",
    "dim_duplicate_seller": "each seller_id occurs once in dim_seller",
    "on_time_rate_out_of_range": "the seller's on-time rate lies in 0 to 1",
    "dim_order_count_mismatch": "the sellers' order counts add up to the fact",
}
BI_CHECKS = {
    "opt_row_count_mismatch": "the partitioned copy has as many rows as the fact",
    "opt_on_time_rate_drift": "the on-time rate is the same in both layouts",
    "bi_orders_row_mismatch": "the order view neither drops nor repeats an order",
    "bi_monthly_order_mismatch": "the months' order counts add up to the fact",
    "bi_state_order_mismatch": "the states' order counts add up to the fact",
    "bi_month_start_mismatch": "month_start leads back to its order_month",
    "bi_region_code_malformed": "region codes read BR- and two capital letters",
    "bi_on_time_rate_out_of_range": "rates per month and state lie in 0 to 1",
    "on_time_pct_scale_drift": "the percentage is 100 times the rate, per month and state",
    "leaderboard_on_time_pct_drift": "the percentage is 100 times the rate, per seller",
    "orders_on_time_pct_mismatch": "the percentage is 100 times the flag, per order",
    "state_name_missing": "each order has a state name and a region",
    "ref_state_count": "the reference holds the expected number of states",
    "calendar_misses_order_dates": "each order date is a calendar day",
    "calendar_has_gaps": "the calendar has every day once",
    "leaderboard_below_floor": "no seller under the order floor is ranked",
}

STATE = "chr(CAST(65 + {0} // 5 AS INTEGER)) || chr(CAST(65 + {0} % 5 AS INTEGER))"
MONTH = "CAST(year({0}) * 100 + month({0}) AS BIGINT)"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator, rounded half away from zero, from integers only."""
    scaled = f"(2 * abs({numerator}) * {10**digits} + ({denominator})) // (2 * ({denominator}))"
    return f"CAST(sign({numerator}) * ({scaled}) AS DOUBLE) / {10**digits}"


def money(cents: str, digits: int = 2) -> str:
    return f"CAST({cents} AS DOUBLE) / {10**digits}"


def n(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def common(dirty: bool = False) -> str:
    delivered = (
        "(SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey)"
        if dirty
        else "CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate"
        " + to_days(CAST(3 + (o_orderkey * 7) % 26 AS INTEGER)) END"
    )
    return f"""
WITH stg_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
              ELSE 'processing' END AS order_status,
         o_orderdate AS purchased_at, {delivered} AS delivered_at,
         o_orderdate + to_days(14 + 3 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER))
           AS estimated_at
  FROM orders),
stg_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)
           * CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT) AS freight_value
  FROM lineitem),
customers AS (
  SELECT c_custkey AS customer_id, {STATE.format('c_nationkey')} AS customer_state FROM customer),
sellers AS (
  SELECT s_suppkey AS seller_id, {STATE.format('s_nationkey')} AS seller_state FROM supplier),
states AS (
  SELECT {STATE.format('n_nationkey')} AS code, n_name AS name, r_name AS region
  FROM nation JOIN region ON r_regionkey = n_regionkey),
per_seller AS (
  SELECT order_id, seller_id, count(*) AS item_count,
         {n('sum(price)')} AS order_value, {n('sum(freight_value)')} AS freight_value
  FROM stg_order_items GROUP BY order_id, seller_id),
primary_seller AS (
  SELECT order_id, seller_id FROM per_seller
  QUALIFY row_number() OVER (
    PARTITION BY order_id ORDER BY item_count DESC, seller_id NULLS FIRST) = 1),
totals AS (
  SELECT order_id, {n('sum(item_count)')} AS item_count, {n('sum(order_value)')} AS order_value,
         {n('sum(freight_value)')} AS freight_value
  FROM per_seller GROUP BY order_id),
fact AS (
  SELECT o.order_id, CAST(o.purchased_at AS DATE) AS order_date,
         {MONTH.format('o.purchased_at')} AS order_month, p.seller_id, s.seller_state,
         c.customer_state, CAST(o.delivered_at AS DATE) AS delivered_date,
         CAST(o.estimated_at AS DATE) AS estimated_date,
         date_diff('day', CAST(o.estimated_at AS DATE), CAST(o.delivered_at AS DATE)) AS late_days,
         CAST(o.delivered_at AS DATE) > CAST(o.estimated_at AS DATE) AS is_late,
         date_diff('day', CAST(o.purchased_at AS DATE), CAST(o.delivered_at AS DATE))
           AS delivery_days,
         t.item_count, t.order_value, t.freight_value
  FROM stg_orders o JOIN primary_seller p USING (order_id) JOIN totals t USING (order_id)
  JOIN customers c USING (customer_id) JOIN sellers s ON s.seller_id = p.seller_id
  WHERE o.order_status = 'delivered' AND o.delivered_at IS NOT NULL
    AND o.estimated_at IS NOT NULL AND o.purchased_at IS NOT NULL),
dim AS (
  SELECT seller_id, min(seller_state) AS seller_state, count(*) AS delivered_orders,
         {half_up('count(*) - count(*) FILTER (is_late)', 'count(*)', 4)} AS on_time_rate,
         {half_up('sum(delivery_days)', 'count(*)', 2)} AS avg_delivery_days,
         {half_up('sum(freight_value)', 'count(*) * 10000', 2)} AS avg_freight_value,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM fact GROUP BY seller_id),
bi_orders AS (
  SELECT f.*, 'BR-' || customer_state AS customer_region_code, s.name AS customer_state_name,
         s.region AS customer_region, s.name || ', Brazil' AS customer_state_geo,
         CAST(CASE WHEN is_late THEN 0 ELSE 1 END AS BIGINT) AS on_time_flag,
         CAST(CASE WHEN is_late THEN 0 ELSE 100 END AS BIGINT) AS on_time_pct
  FROM fact f LEFT JOIN states s ON s.code = f.customer_state),
leaderboard AS (
  SELECT seller_id, seller_state, delivered_orders, on_time_rate,
         round(on_time_rate * 10000) / 100 AS on_time_pct, avg_delivery_days,
         avg_freight_value, first_order_date, last_order_date
  FROM dim WHERE delivered_orders >= 20),
calendar AS (
  SELECT CAST(d AS DATE) AS date, CAST(date_trunc('month', d) AS DATE) AS month_start,
         year(d) AS year, month(d) AS month_number, strftime(d, '%b %Y') AS month_label,
         {MONTH.format('d')} AS order_month
  FROM (SELECT unnest(generate_series(
          CAST(date_trunc('month', min(order_date)) AS TIMESTAMP),
          CAST(last_day(max(order_date)) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM fact))
"""


RATES = f"""count(*) AS orders,
  {half_up('count(*) - count(*) FILTER (is_late)', 'count(*)', 4)} AS on_time_rate,
  {half_up('100 * (count(*) - count(*) FILTER (is_late))', 'count(*)', 2)} AS on_time_pct,
  {half_up('sum(delivery_days)', 'count(*)', 2)} AS avg_delivery_days,
  {half_up('sum(freight_value)', 'count(*) * 10000', 2)} AS avg_freight_value"""

MEASURES = f"""count(*) AS delivered_orders,
  CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS on_time_rate,
  count(*) FILTER (is_late) AS late_orders,
  CAST(sum(delivery_days) AS DOUBLE) / count(*) AS avg_delivery_days,
  {half_up('sum(freight_value)', 'count(*) * 10000', 9)} AS avg_freight,
  {money('sum(order_value)')} AS order_value"""

FACT = f"""SELECT * REPLACE ({money('order_value')} AS order_value,
  {money('freight_value', 4)} AS freight_value) FROM """

MONTHLY = f"""SELECT order_month, CAST(strptime(CAST(order_month AS VARCHAR), '%Y%m') AS DATE)
  AS month_start, {RATES}, {money('sum(order_value)')} AS order_value
  FROM fact GROUP BY order_month"""

BY_STATE = f"""SELECT customer_state, 'BR-' || customer_state AS customer_region_code, {RATES}
  FROM fact GROUP BY customer_state"""

TREND = """SELECT c.order_month, c.month_start, c.month_label,
  CAST(m.delivered_orders AS DOUBLE) AS delivered_orders, m.on_time_rate
  FROM (SELECT DISTINCT order_month, month_start, month_label FROM calendar) c
  LEFT JOIN (SELECT order_month, count(*) AS delivered_orders,
                    CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS on_time_rate
             FROM bi_orders WHERE customer_state = 'AD' GROUP BY order_month) m
    USING (order_month)"""

STATE_RANKING = """SELECT customer_state_name, count(*) AS delivered_orders,
  CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS on_time_rate
  FROM bi_orders GROUP BY customer_state_name"""

WHOLE_TREND = TREND.replace("WHERE customer_state = 'AD' ", "")

TOP_SELLERS = """SELECT l.seller_id, l.seller_state, s.delivered_orders, s.on_time_rate,
  s.avg_delivery_days
  FROM leaderboard l JOIN (
    SELECT seller_id, count(*) AS delivered_orders,
           CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS on_time_rate,
           CAST(sum(delivery_days) AS DOUBLE) / count(*) AS avg_delivery_days
    FROM bi_orders GROUP BY seller_id) s USING (seller_id)"""

BENCH_Q1 = f"""SELECT seller_state, {half_up('sum(late_days)', 'count(*)', 2)}
  AS avg_late_days, count(*) AS orders FROM fact
  WHERE order_month BETWEEN 199801 AND 199803 GROUP BY seller_state"""

BENCH_Q2 = f"""SELECT order_month, count(*) AS orders,
  {half_up('sum(freight_value)', 'count(*) * 10000', 2)} AS avg_freight
  FROM fact WHERE seller_state = 'AD' GROUP BY order_month"""

BUSIEST = f"""SELECT seller_id, count(*) AS orders,
  {half_up('sum(delivery_days)', 'count(*)', 2)} AS avg_delivery_days FROM fact
  WHERE order_month BETWEEN 199801 AND 199806 GROUP BY seller_id"""


def placed(sql: str, order: str, limit: int | None = None) -> str:
    """A query with the place of each row in an order."""
    first = f" WHERE place <= {limit}" if limit else ""
    return (
        f"SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS place"
        f" FROM ({sql})){first}"
    )


SLICE = "order_date BETWEEN DATE '1997-01-15' AND DATE '1998-06-30'"

MART_RULES = {
    "fct_is_empty": "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM fact",
    "fct_duplicate_order_id": "SELECT count(*) - count(DISTINCT order_id) FROM fact",
    "fct_null_key": "SELECT count(*) FROM fact"
    " WHERE order_id IS NULL OR seller_id IS NULL OR order_date IS NULL",
    "order_month_mismatch": "SELECT count(*) FROM fact WHERE order_month IS NULL"
    " OR order_month <> CAST(strftime(order_date, '%Y%m') AS BIGINT)",
    "fct_orphan_seller": "SELECT count(*) FROM fact f LEFT JOIN dim d USING (seller_id)"
    " WHERE d.seller_id IS NULL",
    "negative_money": "SELECT count(*) FROM fact WHERE order_value < 0 OR freight_value < 0",
    "delivered_before_purchase": "SELECT count(*) FROM fact WHERE delivered_date < order_date",
    "null_late_flag": "SELECT count(*) FROM fact WHERE is_late IS NULL OR late_days IS NULL",
    "implausible_delivery_days": "SELECT count(*) FROM fact"
    " WHERE delivery_days < 0 OR delivery_days > 365",
    "dim_duplicate_seller": "SELECT count(*) - count(DISTINCT seller_id) FROM dim",
    "on_time_rate_out_of_range": "SELECT count(*) FROM dim"
    " WHERE on_time_rate < 0 OR on_time_rate > 1",
    "dim_order_count_mismatch": "SELECT CASE WHEN (SELECT sum(delivered_orders) FROM dim)"
    " = (SELECT count(*) FROM fact) THEN 0 ELSE 1 END",
}

ON_TIME = "(SELECT avg(CASE WHEN is_late THEN 0.0 ELSE 1.0 END) FROM {0})"

BI_RULES = {
    "opt_row_count_mismatch": "SELECT CASE WHEN (SELECT count(*) FROM opt)"
    " = (SELECT count(*) FROM fact) THEN 0 ELSE 1 END",
    "opt_on_time_rate_drift": f"SELECT CASE WHEN abs({ON_TIME.format('fact')}"
    f" - {ON_TIME.format('opt')}) > 0.00005 THEN 1 ELSE 0 END",
    "bi_orders_row_mismatch": "SELECT CASE WHEN (SELECT count(*) FROM bi_orders)"
    " = (SELECT count(*) FROM opt) THEN 0 ELSE 1 END",
    "bi_monthly_order_mismatch": "SELECT CASE WHEN (SELECT sum(orders) FROM monthly)"
    " = (SELECT count(*) FROM opt) THEN 0 ELSE 1 END",
    "bi_state_order_mismatch": "SELECT CASE WHEN (SELECT sum(orders) FROM by_state)"
    " = (SELECT count(*) FROM opt) THEN 0 ELSE 1 END",
    "bi_month_start_mismatch": "SELECT count(*) FROM monthly WHERE month_start IS NULL"
    " OR strftime(month_start, '%Y%m') <> CAST(order_month AS VARCHAR)",
    "bi_region_code_malformed": "SELECT count(*) FROM by_state"
    " WHERE NOT regexp_full_match(customer_region_code, 'BR-[A-Z]{2}')",
    "bi_on_time_rate_out_of_range": "SELECT count(*) FROM"
    " (SELECT on_time_rate FROM monthly UNION ALL SELECT on_time_rate FROM by_state)"
    " WHERE on_time_rate < 0 OR on_time_rate > 1",
    "on_time_pct_scale_drift": "SELECT count(*) FROM"
    " (SELECT on_time_rate, on_time_pct FROM monthly"
    " UNION ALL SELECT on_time_rate, on_time_pct FROM by_state)"
    " WHERE abs(on_time_pct - on_time_rate * 100) > 0.01",
    "leaderboard_on_time_pct_drift": "SELECT count(*) FROM leaderboard"
    " WHERE abs(on_time_pct - on_time_rate * 100) > 0.01",
    "orders_on_time_pct_mismatch": "SELECT count(*) FROM bi_orders"
    " WHERE on_time_pct <> on_time_flag * 100",
    "state_name_missing": "SELECT count(*) FROM bi_orders"
    " WHERE customer_state_name IS NULL OR customer_region IS NULL",
    "ref_state_count": "SELECT CASE WHEN count(DISTINCT code) = 25 THEN 0 ELSE 1 END FROM states",
    "calendar_misses_order_dates": "SELECT count(*) FROM bi_orders o"
    " LEFT JOIN calendar c ON c.date = o.order_date WHERE c.date IS NULL",
    "calendar_has_gaps": "SELECT CASE WHEN count(*) = count(DISTINCT date)"
    " AND date_diff('day', min(date), max(date)) + 1 = count(*) THEN 0 ELSE 1 END FROM calendar",
    "leaderboard_below_floor": "SELECT count(*) FROM leaderboard WHERE delivered_orders < 20",
}


DAMAGED_MARTS = """, bad_fact AS (
  SELECT * REPLACE (
    CASE WHEN order_id % 13 <> 0 THEN order_date END AS order_date,
    CASE WHEN order_id % 17 = 0 THEN order_month + 1 ELSE order_month END AS order_month,
    CASE WHEN order_id % 19 = 0 THEN -order_value ELSE order_value END AS order_value,
    CASE WHEN order_id % 23 <> 0 THEN delivered_date
         WHEN order_id % 13 <> 0 THEN order_date - 1 END AS delivered_date,
    CASE WHEN order_id % 29 <> 0 THEN is_late END AS is_late,
    CASE WHEN order_id % 31 = 0 THEN delivery_days + 400 ELSE delivery_days END
      AS delivery_days)
  FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE order_id % 11 = 0)),
bad_dim AS (
  SELECT * REPLACE (on_time_rate + CASE WHEN seller_id % 3 = 0 THEN 1 ELSE 0 END AS on_time_rate)
  FROM (SELECT * FROM dim UNION ALL SELECT * FROM dim WHERE seller_id % 7 = 0)
  WHERE seller_id % 5 <> 0),
no_fact AS (SELECT * FROM fact WHERE order_id IS NULL) """

DAMAGED_LAYER = """, bad_opt AS (
  SELECT * FROM fact WHERE NOT (coalesce(is_late, false) AND order_id % 2 = 0)),
bad_bi_orders AS (
  SELECT * REPLACE (
    on_time_pct + CASE WHEN order_id % 47 = 0 THEN 1 ELSE 0 END AS on_time_pct,
    CASE WHEN customer_state <> 'AD' THEN customer_region END AS customer_region)
  FROM bi_orders WHERE order_id % 43 <> 0),
bad_monthly AS (
  SELECT * REPLACE (
    orders + CASE WHEN order_month % 2 = 0 THEN 1 ELSE 0 END AS orders,
    CASE WHEN order_month % 3 = 0 THEN CAST(month_start + INTERVAL 1 MONTH AS DATE)
         ELSE month_start END AS month_start,
    on_time_rate + CASE WHEN order_month % 5 = 0 THEN 1 ELSE 0 END AS on_time_rate)
  FROM monthly),
bad_by_state AS (
  SELECT * REPLACE (
    CASE WHEN customer_state > 'C' THEN lower(customer_region_code)
         ELSE customer_region_code END AS customer_region_code)
  FROM by_state WHERE customer_state <> 'AD'),
bad_leaderboard AS (
  SELECT * REPLACE (
    on_time_pct + CASE WHEN seller_id % 3 = 0 THEN 1 ELSE 0 END AS on_time_pct,
    delivered_orders - CASE WHEN seller_id % 4 = 0 THEN 1000 ELSE 0 END AS delivered_orders)
  FROM leaderboard),
bad_calendar AS (SELECT * FROM calendar WHERE day(date) <> 15),
bad_states AS (SELECT * FROM states WHERE code <> 'AA') """


def renamed(rules: dict[str, str], names: dict[str, str]) -> dict[str, str]:
    """The rules over other relations."""
    return {
        check: re.sub(rf"\b({'|'.join(names)})\b", lambda m: names[m[0]], sql)
        for check, sql in rules.items()
    }


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def check_report(rules: dict[str, str], texts: dict[str, str]) -> str:
    arms = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, ({rule}) AS bad_rows, {quoted(texts[name])} AS description"
        for name, rule in rules.items()
    )
    return (
        "SELECT check_name, CAST(bad_rows AS BIGINT) AS bad_rows,"
        " CASE WHEN bad_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status, description"
        f" FROM ({arms})"
    )


def raw_counts(extra: str = "") -> str:
    tables = {
        "orders": "orders",
        "order_items": "lineitem",
        "customers": "customer",
        "sellers": "supplier",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count{extra} FROM {table}"
        for name, table in tables.items()
    )


# a further table: what partition pruning leaves of each layout for each query
LAYOUT_SIDES = """, sides AS (SELECT query, layout, order_month
  FROM fact, (VALUES ('q1_quarter_by_state', 199801, 199803),
    ('q2_one_state_all_time', NULL, NULL), ('q3_state_and_range', 199801, 199806))
    AS q(query, first, last), (VALUES ('base'), ('opt')) AS l(layout)
  WHERE layout = 'base' OR first IS NULL OR order_month BETWEEN first AND last)
"""


def object_counts(objects: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count{extra} FROM {source}"
        for name, source in objects.items()
    )


EXTRACT_OBJECTS = {
    "vw_bi_orders": "bi_orders",
    "vw_bi_calendar": "calendar",
    "vw_bi_seller_leaderboard": "leaderboard",
}
REBUILT_OBJECTS = {
    "fct_delivery_performance": "fact",
    "fct_delivery_performance_opt": "fact",
    "dim_seller": "dim",
    "ref_br_state": "states",
    "vw_bi_monthly": f"({MONTHLY})",
    "vw_bi_by_state": f"({BY_STATE})",
    **EXTRACT_OBJECTS,
}
PUBLISHED_OBJECTS = {
    "orders": "orders",
    "order_items": "lineitem",
    "customers": "customer",
    "sellers": "supplier",
    "stg_orders": "stg_orders",
    "stg_order_items": "stg_order_items",
    **REBUILT_OBJECTS,
}


def queries() -> dict[str, str]:
    clean, dirty = common(), common(dirty=True)
    bi = f"{clean}, monthly AS ({MONTHLY}), by_state AS ({BY_STATE}), opt AS (SELECT * FROM fact) "
    layer = ("opt", "bi_orders", "monthly", "by_state", "leaderboard", "calendar", "states")
    damaged_marts = renamed(MART_RULES, {"fact": "bad_fact", "dim": "bad_dim"})
    damaged_layer = renamed(BI_RULES, {name: f"bad_{name}" for name in layer})
    items = f"{money('order_value')} AS order_value, {money('freight_value', 4)} AS freight_value"
    on_clean = {
        "stg_orders": "SELECT * FROM stg_orders",
        "stg_order_items": f"""SELECT * REPLACE ({money('price')} AS price,
            {money('freight_value', 4)} AS freight_value) FROM stg_order_items""",
        "items_per_order": f"SELECT order_id, seller_id, item_count, {items} FROM per_seller",
        "primary_seller": "SELECT order_id, seller_id FROM primary_seller",
        "order_totals": f"SELECT order_id, item_count, {items} FROM totals",
        "fct_delivery_performance": FACT + "fact",
        "dim_seller": "SELECT * FROM dim",
        "fct_opt_roundtrip": FACT + "fact",
        "range_bucket": """SELECT order_month,
            CAST(len(list_filter(range(199501, 200113), lambda b: b <= order_month)) AS BIGINT)
              AS bucket,
            CAST(least(greatest(order_month - 199500, 0), 613) AS BIGINT) AS bounds_passed,
            order_month >= 199501 AND order_month < 200112 AS in_range, count(*) AS orders
            FROM fact GROUP BY order_month""",
        "ref_state": "SELECT code, name, region FROM states",
        "bi_orders": FACT + "bi_orders",
        "bi_monthly": MONTHLY,
        "bi_by_state": BY_STATE,
        "bi_seller_leaderboard": "SELECT * FROM leaderboard",
        "bi_calendar": "SELECT * FROM calendar",
        "mart_checks": check_report(MART_RULES, MART_CHECKS),
        "orphan_sellers": """SELECT count(*) AS bad_rows FROM fact f
            LEFT JOIN leaderboard d USING (seller_id) WHERE d.seller_id IS NULL""",
        "calendar_missing_dates": """SELECT count(*) AS bad_rows FROM bi_orders o
            LEFT JOIN (SELECT date FROM calendar WHERE order_month BETWEEN 199801 AND 199806) c
              ON c.date = o.order_date WHERE c.date IS NULL""",
        "headline": """SELECT count(*) AS delivered_orders, min(order_date) AS first_order_date,
            max(order_date) AS last_order_date,
            CAST(count(*) - count(*) FILTER (is_late) AS DOUBLE) / count(*) AS on_time_rate,
            CAST(sum(delivery_days) AS DOUBLE) / count(*) AS avg_delivery_days,
            CAST(sum(-late_days) AS DOUBLE) / count(*) AS avg_slack_days FROM fact""",
        "measures_total": f"SELECT {MEASURES} FROM bi_orders",
        "measures_by_region": f"""SELECT customer_region, {MEASURES} FROM bi_orders
            GROUP BY customer_region""",
        "state_ranking": STATE_RANKING,
        "state_spread": f"""SELECT w.customer_state_name AS worst_state,
            w.on_time_rate AS worst_rate, b.customer_state_name AS best_state,
            b.on_time_rate AS best_rate, b.on_time_rate - w.on_time_rate AS spread
            FROM (SELECT * FROM ({STATE_RANKING}) ORDER BY on_time_rate, customer_state_name
                  LIMIT 1) w,
                 (SELECT * FROM ({STATE_RANKING}) ORDER BY on_time_rate DESC,
                  customer_state_name DESC LIMIT 1) b""",
        "monthly_trend_with_gaps": TREND,
        "sparse_month_floor": f"SELECT * FROM ({TREND}) WHERE delivered_orders >= 2",
        "star_members": """SELECT c.month_start AS calendar_month_start,
            l.seller_state AS ranked_seller_state, count(*) AS delivered_orders
            FROM bi_orders o LEFT JOIN calendar c ON c.date = o.order_date
            LEFT JOIN leaderboard l ON l.seller_id = o.seller_id GROUP BY 1, 2""",
        "top_sellers": f"""SELECT l.seller_id, l.seller_state, s.delivered_orders,
            s.on_time_rate, s.avg_delivery_days
            FROM leaderboard l JOIN (
              SELECT seller_id, count(*) AS delivered_orders,
                     CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS on_time_rate,
                     CAST(sum(delivery_days) AS DOUBLE) / count(*) AS avg_delivery_days
              FROM bi_orders WHERE {SLICE} GROUP BY seller_id) s USING (seller_id)
            ORDER BY s.delivered_orders DESC, l.seller_id LIMIT 10""",
        "leaderboard_coverage": """SELECT l.seller_id IS NOT NULL AS on_leaderboard,
            count(*) AS delivered_orders,
            CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS on_time_rate
            FROM bi_orders o LEFT JOIN leaderboard l ON l.seller_id = o.seller_id GROUP BY 1""",
        "sliced_measures": f"""SELECT {MEASURES} FROM bi_orders
            WHERE {SLICE} AND customer_region = 'ASIA'""",
        "bench_q1": BENCH_Q1,
        "bench_q2": BENCH_Q2,
        "bench_q3": f"""SELECT seller_id, count(*) AS orders,
            {half_up('sum(delivery_days)', 'count(*)', 2)} AS avg_delivery_days FROM fact
            WHERE order_month BETWEEN 199801 AND 199806 AND seller_state = 'AD'
            GROUP BY seller_id ORDER BY orders DESC, seller_id LIMIT 10""",
        "layout_rows": """SELECT query, layout, CAST(count(*) FILTER (
              layout = 'base' OR first IS NULL OR order_month BETWEEN first AND last) AS BIGINT)
              AS rows
            FROM fact, (VALUES ('q1_quarter_by_state', 199801, 199803),
              ('q2_one_state_all_time', NULL, NULL),
              ('q3_state_and_range', 199801, 199806)) AS q(query, first, last),
              (VALUES ('base'), ('opt')) AS l(layout) GROUP BY query, layout""",
        "view_pruning": """SELECT 'view' AS source, order_month, count(*) AS orders, true AS alone
            FROM fact WHERE order_month BETWEEN 199801 AND 199803 GROUP BY order_month
            UNION ALL SELECT 'fact', order_month, count(*),
              (SELECT count(DISTINCT order_month) FROM fact) = 1 FROM fact GROUP BY order_month""",
        "planned_scans": LAYOUT_SIDES + """SELECT query, layout, count(DISTINCT order_month) AS months,
              count(*) AS rows, true AS as_planned FROM sides GROUP BY query, layout""",
        "measured_scans": LAYOUT_SIDES + """SELECT query, layout, count(*) AS planned_rows,
              CASE layout WHEN 'opt' THEN count(DISTINCT order_month) ELSE 0 END AS months,
              true AS files_as_planned, true AS rows_within_plan
            FROM sides GROUP BY query, layout""",
        "row_comparison": LAYOUT_SIDES + """SELECT query, base_rows, 0::BIGINT AS base_months,
              true AS base_within_plan, opt_rows, opt_months, true AS opt_within_plan,
              (2000 * (base_rows - opt_rows) + base_rows) // (2 * base_rows) / 10.0::DOUBLE
                AS rows_reduction_pct
            FROM (SELECT query, count(*) FILTER (layout = 'base') AS base_rows,
                count(*) FILTER (layout = 'opt') AS opt_rows,
                count(DISTINCT order_month) FILTER (layout = 'opt') AS opt_months
              FROM sides GROUP BY query)""",
        "catalog_views": object_counts(PUBLISHED_OBJECTS, ", true AS same_rows"),
        "failed_casts": """SELECT 'orders' AS table_name, 'order_purchase_timestamp' AS column_name,
              count(*) AS lost FROM stg_orders WHERE order_id % 9 = 0
            UNION ALL SELECT 'orders', 'order_delivered_customer_date', count(*)
              FROM stg_orders WHERE order_id % 10 = 0
            UNION ALL SELECT 'orders', 'order_estimated_delivery_date', 0
            UNION ALL SELECT 'order_items', 'price', count(*)
              FROM stg_order_items WHERE order_item_id = 3
            UNION ALL SELECT 'order_items', 'freight_value', 0""",
        "copy_difference": DAMAGED_MARTS + """SELECT
            (SELECT count(*) FROM (SELECT * FROM fact EXCEPT ALL SELECT * FROM bad_fact))
              AS only_left,
            (SELECT count(*) FROM (SELECT * FROM bad_fact EXCEPT ALL SELECT * FROM fact))
              AS only_right""",
        "inline_state_orders": """SELECT code, 'state ' || code AS name, code[1] AS region,
            (SELECT count(*) FROM customers WHERE customer_state = code) AS customers
            FROM (SELECT chr(CAST(65 + n // 5 AS INTEGER)) || chr(CAST(65 + n % 5 AS INTEGER))
                    AS code FROM range(25) r(n))""",
        "monthly_trend": WHOLE_TREND,
        "top_sellers_all": TOP_SELLERS + " ORDER BY s.delivered_orders DESC, l.seller_id LIMIT 10",
        "busiest_sellers": f"{BUSIEST} ORDER BY orders DESC, seller_id LIMIT 10",
        "ordered_busiest_sellers": placed(BUSIEST, "orders DESC, seller_id", 10),
        "ordered_top_sellers": placed(TOP_SELLERS, "delivered_orders DESC, seller_id", 10),
        "ordered_state_ranking": placed(STATE_RANKING, "on_time_rate, customer_state_name"),
        "ordered_trend": placed(WHOLE_TREND, "order_month"),
        "ordered_bench_q1": placed(BENCH_Q1, "orders DESC, seller_state"),
        "ordered_bench_q2": placed(BENCH_Q2, "order_month"),
        "rebuild_twice": object_counts(REBUILT_OBJECTS, ", true AS identical"),
        "bi_extract": object_counts(EXTRACT_OBJECTS, ", true AS same_rows"),
        "commit_order": """SELECT CAST(step AS BIGINT) AS step, count(*) AS orders
            FROM stg_orders, (VALUES (1, 1), (2, 3), (3, 2), (4, 5)) AS s(step, every)
            WHERE order_id % every = 0 GROUP BY step""",
        "pinned_tables": """SELECT reader, table_name, count(*) AS row_count FROM (
              SELECT order_id AS id, 'orders' AS table_name FROM stg_orders
              UNION ALL SELECT order_id, 'order_items' FROM stg_order_items
              UNION ALL SELECT 0, 'customers' FROM customer
              UNION ALL SELECT 0, 'sellers' FROM supplier),
              (VALUES ('pinned', 1), ('latest', 3)) AS r(reader, every)
            WHERE id % every = 0 GROUP BY reader, table_name""",
    }
    bad_rows = check_report(MART_RULES, MART_CHECKS)
    return {
        **{name: clean + sql for name, sql in on_clean.items()},
        "bi_checks": bi + check_report(BI_RULES, BI_CHECKS),
        "dirty_mart_checks": dirty + bad_rows,
        "damaged_mart_checks": clean + DAMAGED_MARTS + check_report(damaged_marts, MART_CHECKS),
        "empty_mart_checks": clean
        + DAMAGED_MARTS
        + check_report(renamed(MART_RULES, {"fact": "no_fact"}), MART_CHECKS),
        "damaged_bi_checks": bi + DAMAGED_LAYER + check_report(damaged_layer, BI_CHECKS),
        "gate_total": f"{dirty} SELECT {n('coalesce(sum(bad_rows), 0)')} AS bad_rows"
        f" FROM ({bad_rows})",
        "csv_load_roundtrip": raw_counts(", true AS same_rows"),
        "row_count_report": raw_counts(),
        "ordered_row_counts": placed(raw_counts(), "table_name"),
        "ordered_dirty_checks": dirty + placed(bad_rows, "bad_rows DESC, check_name"),
        "safe_cast_probe": f"""SELECT o_orderkey,
            TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS ts,
            CASE WHEN o_orderstatus <> 'O' THEN {money(
                'CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)')} END AS price
            FROM orders""",
        "history_filter": """SELECT event_id, ts, event_type, value FROM events
            WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
              AND event_type LIKE '%c%' AND event_type NOT LIKE '%err%'""",
        "run_tag_extract": """SELECT event_id,
            nullif(regexp_extract(props, '"k": ([0-9]+)', 1), '') AS tag,
            nullif(regexp_extract(props, '"k": ([5-9][0-9])', 1), '') AS high_tag FROM events""",
    }
