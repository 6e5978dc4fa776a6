"""The two quality gates: 12 checks on the marts, 16 on the layer built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.contracts import (
    DIM_SELLER,
    EXPECTED_STATES,
    FACT,
    FACT_OPT,
    LEADERBOARD_FLOOR,
    MAX_DELIVERY_DAYS,
    PCT_TOLERANCE,
    RATE_TOLERANCE,
    REGION_CODE_PATTERN,
)
from punctual.functions.scalar import flag, month_text, safe_numeric, safe_timestamp
from punctual.operators.checks import Check, report, zero_or_one
from punctual.sources.warehouse import Warehouse

# The check names, which reports and alerts refer to.
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


def absent(rows: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows whose ``key`` is no member, NULL keys included.

    Rows are counted per key first, so the anti join sees distinct keys only and a hot
    key costs no more than any other.
    """
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    absent = per_key.join(members, per_key[key] == members[member_key], "left_anti")
    return absent.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def _covered(per_key: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """``per_key`` with ``uncovered``: its rows where ``key`` is no member, else 0."""
    known = members.select(F.col(member_key).alias("member")).distinct()
    return per_key.join(known, per_key[key] == known.member, "left").withColumn(
        "uncovered", F.when(F.col("member").isNull(), F.col("rows")).otherwise(0)
    )


def _distinct(df: DataFrame, key: str, dense: bool = False) -> DataFrame:
    """Distinct keys, apart from the other measures of the table.

    In one aggregation with them, every partial sum would be shuffled along with its
    key. Alone, only the key column is read and shuffled. ``dense`` integers aren't even
    that: each task marks its keys in bitmaps of 32,768 neighbours, and only those move.
    """
    if not dense:
        return df.agg(F.count_distinct(key).alias("keys"))
    maps = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("map"))
    )
    return maps.agg(F.coalesce(F.sum(F.bitmap_count("map")), F.lit(0)).alias("keys"))


def is_dense(stats: dict) -> bool:
    """Whether bitmaps of a table's keys take no more room than the keys.

    ``stats`` are rows, low and high key as the table's write observed them. A bitmap takes
    a bit for each number between, a key 64; text and sparse numbers are no case for it.
    """
    low, high = stats.get("low"), stats.get("high")
    return isinstance(low, int) and isinstance(high, int) and high - low < 64 * stats["rows"]


def _outside(low: Column, value: Column, high: Column) -> Column:
    return (value < low) | (value > high)


def mart_checks(
    fact: DataFrame, dim: DataFrame, dense_orders: bool = False, dense_sellers: bool = False
) -> DataFrame:
    """The report over the fact and the seller dimension.

    ``dense_orders`` and ``dense_sellers`` say that order ids of the fact and seller ids
    of the dimension are integers close enough for bitmaps (see ``is_dense``).
    """
    c = F.col
    rate_range = _outside(F.lit(0), c("on_time_rate"), F.lit(1))
    month = month_text(c("order_date")).cast("bigint")
    measurements = {
        "fact": fact.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(
                c("order_id").isNull() | c("seller_id").isNull() | c("order_date").isNull()
            ).alias("null_key"),
            F.count_if(c("order_month").isNull() | (c("order_month") != month)).alias("month"),
            F.count_if((c("order_value") < 0) | (c("freight_value") < 0)).alias("money"),
            F.count_if(c("delivered_date") < c("order_date")).alias("order_of_dates"),
            F.count_if(c("is_late").isNull() | c("late_days").isNull()).alias("lateness"),
            F.count_if(
                _outside(F.lit(0), c("delivery_days"), F.lit(MAX_DELIVERY_DAYS))
            ).alias("duration"),
        ),
        "fact_orders": _distinct(fact, "order_id", dense_orders),
        "orphans": absent(fact, "seller_id", dim, "seller_id"),
        "dim": dim.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(rate_range).alias("rate"),
            F.sum("delivered_orders").alias("orders"),
        ),
        "dim_sellers": _distinct(dim, "seller_id", dense_sellers),
    }
    bad_rows = {
        "fct_is_empty": zero_or_one(c("fact.rows") != 0),
        "fct_duplicate_order_id": c("fact.rows") - c("fact_orders.keys"),
        "fct_null_key": c("fact.null_key"),
        "order_month_mismatch": c("fact.month"),
        "fct_orphan_seller": c("orphans.rows"),
        "negative_money": c("fact.money"),
        "delivered_before_purchase": c("fact.order_of_dates"),
        "null_late_flag": c("fact.lateness"),
        "implausible_delivery_days": c("fact.duration"),
        "dim_duplicate_seller": c("dim.rows") - c("dim_sellers.keys"),
        "on_time_rate_out_of_range": c("dim.rate"),
        "dim_order_count_mismatch": zero_or_one(c("dim.orders") == c("fact.rows")),
    }
    checks = [Check(name, bad_rows[name], text) for name, text in MART_CHECKS.items()]
    return report(fact.sparkSession, measurements, checks)


def _pct_drift() -> Column:
    return F.abs(F.col("on_time_pct") - F.col("on_time_rate") * 100) > PCT_TOLERANCE


def _grouped_view(view: DataFrame, *extra: Column) -> DataFrame:
    rate_range = _outside(F.lit(0), F.col("on_time_rate"), F.lit(1))
    return view.agg(
        F.sum("orders").alias("orders"),
        F.count_if(rate_range).alias("rate"),
        F.count_if(_pct_drift()).alias("pct"),
        *extra,
    )


def bi_checks(
    fact: DataFrame,
    opt: DataFrame,
    views: dict[str, DataFrame],
    expected_states: int = EXPECTED_STATES,
) -> DataFrame:
    """The report over the partitioned copy and the BI views."""
    c = F.col
    orders, calendar = views["vw_bi_orders"], views["vw_bi_calendar"]
    # one pass over the order view: everything about it comes from its rows per day
    per_day = orders.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(c("on_time_pct") != c("on_time_flag") * 100).alias("pct"),
        F.count_if(
            c("customer_state_name").isNull() | c("customer_region").isNull()
        ).alias("unnamed"),
    )
    on_time = F.avg(flag(c("is_late"), 1)).alias("on_time")
    rows = F.count(F.lit(1)).alias("rows")
    month = c("order_month").cast("string")
    measurements = {
        "fact": fact.agg(rows, on_time),
        "opt": opt.agg(rows, on_time),
        "detail": _covered(per_day, "order_date", calendar, "date").agg(
            *(
                F.coalesce(F.sum(name), F.lit(0)).alias(name)
                for name in ("rows", "pct", "unnamed", "uncovered")
            )
        ),
        "monthly": _grouped_view(
            views["vw_bi_monthly"],
            F.count_if(
                c("month_start").isNull() | (month_text(c("month_start")) != month)
            ).alias("start"),
        ),
        "by_state": _grouped_view(
            views["vw_bi_by_state"],
            F.count_if(~c("customer_region_code").rlike(REGION_CODE_PATTERN)).alias("code"),
        ),
        "leaderboard": views["vw_bi_seller_leaderboard"].agg(
            F.count_if(_pct_drift()).alias("pct"),
            F.count_if(c("delivered_orders") < LEADERBOARD_FLOOR).alias("small"),
        ),
        "states": views["ref_br_state"].agg(F.count_distinct("code").alias("codes")),
        "calendar": calendar.agg(
            rows,
            F.count_distinct("date").alias("days"),
            (F.datediff(F.max("date"), F.min("date")) + 1).alias("span"),
        ),
    }
    complete = (c("calendar.rows") == c("calendar.days")) & (
        c("calendar.span") == c("calendar.rows")
    )
    drift = F.abs(c("fact.on_time") - c("opt.on_time")) > RATE_TOLERANCE
    bad_rows = {
        "opt_row_count_mismatch": zero_or_one(c("fact.rows") == c("opt.rows")),
        "opt_on_time_rate_drift": F.when(drift, F.lit(1)).otherwise(F.lit(0)),
        "bi_orders_row_mismatch": zero_or_one(c("detail.rows") == c("opt.rows")),
        "bi_monthly_order_mismatch": zero_or_one(c("monthly.orders") == c("opt.rows")),
        "bi_state_order_mismatch": zero_or_one(c("by_state.orders") == c("opt.rows")),
        "bi_month_start_mismatch": c("monthly.start"),
        "bi_region_code_malformed": c("by_state.code"),
        "bi_on_time_rate_out_of_range": c("monthly.rate") + c("by_state.rate"),
        "on_time_pct_scale_drift": c("monthly.pct") + c("by_state.pct"),
        "leaderboard_on_time_pct_drift": c("leaderboard.pct"),
        "orders_on_time_pct_mismatch": c("detail.pct"),
        "state_name_missing": c("detail.unnamed"),
        "ref_state_count": zero_or_one(c("states.codes") == expected_states),
        "calendar_misses_order_dates": c("detail.uncovered"),
        "calendar_has_gaps": zero_or_one(complete),
        "leaderboard_below_floor": c("leaderboard.small"),
    }
    checks = [Check(name, bad_rows[name], text) for name, text in BI_CHECKS.items()]
    return report(fact.sparkSession, measurements, checks)


def failed_casts(raw: dict[str, DataFrame]) -> DataFrame:
    """Per column that staging casts: values that are there in the raw table and NULL after.

    One scan a table. Outside the two gates, as a failed cast is no bad row yet.
    """
    orders, items = raw["orders"], raw["order_items"]
    casts = {
        "orders": {
            name: safe_timestamp(orders, name)
            for name in (
                "order_purchase_timestamp",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        },
        "order_items": {name: safe_numeric(name) for name in ("price", "freight_value")},
    }
    rows = []
    for table, columns in casts.items():
        counts = raw[table].agg(
            *(
                F.count_if(F.col(name).isNotNull() & cast.isNull()).alias(name)
                for name, cast in columns.items()
            )
        )
        pairs = F.array(
            *(
                F.struct(F.lit(name).alias("column_name"), F.col(name).alias("lost"))
                for name in columns
            )
        )
        rows.append(counts.select(F.lit(table).alias("table_name"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, rows)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many rows, with their number of times, are on one side only.

    A row counts +1 on the left and -1 on the right under its 128-bit hash, so equal rows
    cancel out. Sums are combined before the one shuffle, which moves a hash and a number
    a row, not the columns; a row that occurs a million times moves once a task. Columns
    are matched by name, NULL equals NULL. Two different rows share a hash with a chance
    of about 1 in 10^38 a pair.
    """
    names = sorted(left.columns)
    if names != sorted(right.columns):
        raise ValueError(f"the tables have other columns: {names}, {sorted(right.columns)}")
    kinds = {f.name: f.dataType for f in left.schema}
    # a hash skips NULLs, so where they are is hashed as well
    values = [x for name in names for x in (F.col(name).isNull(), F.col(name).cast(kinds[name]))]
    sides = (
        side.select(
            F.xxhash64(F.lit(1), *values).alias("a"),
            F.xxhash64(F.lit(2), *reversed(values)).alias("b"),
            F.lit(sign).alias("sign"),
        )
        for side, sign in ((left, 1), (right, -1))
    )
    per_row = reduce(DataFrame.unionByName, sides).groupBy("a", "b").agg(F.sum("sign").alias("more"))
    return per_row.agg(
        F.coalesce(F.sum(F.greatest("more", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("more"), F.lit(0))), F.lit(0)).alias("only_right"),
    )


def warehouse_mart_checks(warehouse: Warehouse) -> DataFrame:
    dense = (is_dense(warehouse.stats(table)) for table in (FACT, DIM_SELLER))
    return mart_checks(warehouse.read(FACT), warehouse.read(DIM_SELLER), *dense)


def warehouse_bi_checks(
    warehouse: Warehouse, views: dict[str, DataFrame], expected_states: int = EXPECTED_STATES
) -> DataFrame:
    return bi_checks(warehouse.read(FACT), warehouse.read(FACT_OPT), views, expected_states)
