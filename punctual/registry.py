"""Every dataset, gate and report as a query over the test tables.

The marts are written once per session and input folder, as the rebuild job would, and
every query on the BI layer reads those tables. Results keep their contract's columns;
only decimals leave as doubles, so that they compare with any other engine's.
"""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.contracts import DIM_SELLER, FACT, FACT_OPT, RAW_TABLES
from punctual.functions.scalar import range_bucket, range_bucket_of, safe_numeric, safe_timestamp
from punctual.operators.checks import gate_total
from punctual.operators.layout import write_partitioned
from punctual.operators.rollup import items_per_order, order_totals, primary_seller
from punctual.plans import bi, gates, layout_bench, marts, reports
from punctual.plans.catalog import publish
from punctual.plans.rebuild import extract, rebuild
from punctual.session import prepare, scratch_dir
from punctual.sources import csv_load, files, fixture, history
from punctual.sources.states import inline_states
from punctual.sources.warehouse import Warehouse, contents, row_counts

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = layout_bench.Params(fixture.QUARTER, fixture.HALF_YEAR, fixture.ONE_STATE)
SLICE_FROM, SLICE_TO = datetime.date(1997, 1, 15), datetime.date(1998, 6, 30)
SLICE_REGION = "ASIA"
MONTH_FLOOR = 2
PUBLISHED = (
    *RAW_TABLES, FACT, DIM_SELLER, FACT_OPT, "stg_orders", "stg_order_items", "ref_br_state",
    "vw_bi_orders", "vw_bi_monthly", "vw_bi_by_state", "vw_bi_seller_leaderboard",
    "vw_bi_calendar",
)

_built: dict[tuple, Warehouse] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles; everything else as it is."""
    return df.select(
        *(
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        )
    )


def folder(spark: SparkSession, sf_dir: str, use: str) -> str:
    return f"{scratch_dir(spark)}/{hashlib.sha1(sf_dir.encode()).hexdigest()[:12]}/{use}"


def built(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Warehouse:
    """The written marts of ``sf_dir``, built on first use in this session.

    They are built anew when the input's files change.
    """
    inputs = tuple(files.fingerprint(spark, p) for p in fixture.paths(sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir, dirty, inputs)
    if key not in _built:
        warehouse = Warehouse(spark, folder(spark, sf_dir, "dirty" if dirty else "clean"))
        warehouse.ensure()
        marts.build_marts(warehouse, fixture.raw_tables(spark, sf_dir, dirty))
        if not dirty:  # dirty marts fail their gate, so no layer is built on them
            write_partitioned(warehouse)
        _built[key] = warehouse
    return _built[key]


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return bi.bi_views(built(spark, sf_dir), fixture.states(spark, sf_dir))


def _raw_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixture.raw_tables(spark, sf_dir)
    return marts.staged_fact(raw, marts.hot_orders(raw))


def _staged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stg_order_items(fixture.raw_order_items(spark, sf_dir))


# -- sources ---------------------------------------------------------------------------


def write_csv(spark: SparkSession, sf_dir: str, use: str, orders: Column | None = None) -> str:
    """The raw tables as CSV files with a header, for the load jobs to read.

    ``orders`` chooses some orders and their items.
    """
    target = folder(spark, sf_dir, use)
    for table, df in fixture.raw_tables(spark, sf_dir).items():
        if orders is not None and "order_id" in df.columns:
            df = df.where(orders)
        df.write.mode("overwrite").option("header", True).csv(f"{target}/{table}.csv")
    return target


def csv_load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables to CSV and back; the staged contents must be those of the source."""
    source = write_csv(spark, sf_dir, "csv")
    warehouse = Warehouse(spark, folder(spark, sf_dir, "loaded"))
    csv_load.load(warehouse, source)
    ids = ("order_id", "customer_id", "seller_id", "product_id", "order_item_id")

    def staged(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
        tables = {
            **raw,
            "orders": marts.stg_orders(raw["orders"]),
            "order_items": marts.stg_order_items(raw["order_items"]),
        }
        return {
            name: df.withColumns({c: F.col(c).cast("bigint") for c in ids if c in df.columns})
            for name, df in tables.items()
        }

    before = contents(staged(fixture.raw_tables(spark, sf_dir)))
    after = contents(staged({table: warehouse.read(table) for table in RAW_TABLES}))
    same = F.col("b.fingerprint").eqNullSafe(F.col("a.fingerprint"))
    return (
        after.alias("a")
        .join(before.alias("b"), "table_name")
        .select("table_name", F.col("a.row_count").alias("row_count"), same.alias("same_rows"))
    )


def row_count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(fixture.raw_tables(spark, sf_dir))


def safe_cast_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerant casts over text columns in which some values are no date or no number."""
    orders = fixture.table(spark, sf_dir, "orders")
    text = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("ts_text"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderstatus"))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("price_text"),
    )
    return text.select(
        "o_orderkey",
        safe_timestamp(text, "ts_text").alias("ts"),
        safe_numeric("price_text").alias("price"),
    )


def history_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job-history filter on the event table; "now" is its last event."""
    events = fixture.table(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now")).scalar()
    return history.recent(events, "ts", "event_type", now, 2, "%c%", "%err%").select(
        "event_id", "ts", "event_type", "value"
    )


def run_tag_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags recovered from free text by pattern; no match is NULL."""
    return fixture.table(spark, sf_dir, "events").select(
        "event_id",
        history.tag_part("props", '"k": ([0-9]+)').alias("tag"),
        history.tag_part("props", '"k": ([5-9][0-9])').alias("high_tag"),
    )


# -- marts -----------------------------------------------------------------------------


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stg_orders(fixture.raw_orders(spark, sf_dir))


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged_items(spark, sf_dir)


def per_order_and_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_per_order(_staged_items(spark, sf_dir))


def primary_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary_seller(per_order_and_seller(spark, sf_dir))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_totals(per_order_and_seller(spark, sf_dir))


def fct_delivery_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_fact(spark, sf_dir)


def dim_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_seller(built(spark, sf_dir).read(FACT))


def fct_opt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).read(FACT_OPT)


def range_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows per range partition; outside the bounds lies the catch-all partition."""
    low, high, step = fixture.MONTH_BOUNDS
    month = F.col("order_month")
    bucket = range_bucket(month, low, high, step)
    counted = range_bucket_of(month, F.sequence(F.lit(low), F.lit(high), F.lit(step)))
    inside = (bucket > 0) & (month < high)
    return (
        built(spark, sf_dir)
        .read(FACT_OPT)
        .groupBy("order_month")
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(
            "order_month",
            bucket.alias("bucket"),
            counted.alias("bounds_passed"),
            inside.alias("in_range"),
            "orders",
        )
    )


# -- BI layer --------------------------------------------------------------------------


def _view(name: str) -> Query:
    return lambda spark, sf_dir: views(spark, sf_dir)[name]


def mart_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.warehouse_mart_checks(built(spark, sf_dir))


def dirty_mart_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.warehouse_mart_checks(built(spark, sf_dir, dirty=True))


def damaged_mart_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart gate on marts with a known number of defects of each kind."""
    warehouse = built(spark, sf_dir)
    return gates.mart_checks(
        *fixture.damaged_marts(warehouse.read(FACT), warehouse.read(DIM_SELLER))
    )


def empty_mart_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart gate on a fact without rows and the sellers of the whole one."""
    warehouse = built(spark, sf_dir)
    return gates.mart_checks(
        warehouse.read(FACT).where("order_id IS NULL"), warehouse.read(DIM_SELLER)
    )


def damaged_bi_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The BI gate on a copy and views with a known number of defects of each kind."""
    warehouse = built(spark, sf_dir)
    opt, layer = fixture.damaged_layer(warehouse.read(FACT_OPT), views(spark, sf_dir))
    return gates.bi_checks(warehouse.read(FACT), opt, layer, fixture.STATE_COUNT)


def failed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost values per column, where some dates and prices are text of another kind."""
    raw = fixture.raw_tables(spark, sf_dir)
    dates = ("order_purchase_timestamp", "order_delivered_customer_date")
    orders = raw["orders"].withColumns(
        {
            name: F.expr(f"CASE WHEN order_id % {n} = 0 THEN 'soon' ELSE string({name}) END")
            for name, n in zip(dates, (9, 10), strict=True)
        }
    )
    price = F.expr("CASE WHEN order_item_id = 3 THEN 'n/a' ELSE string(price) END")
    items = raw["order_items"].withColumn("price", price)
    return gates.failed_casts({"orders": orders, "order_items": items})


def copy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that only the fact has, and only a damaged copy of it."""
    warehouse = built(spark, sf_dir)
    fact = warehouse.read(FACT)
    damaged, _ = fixture.damaged_marts(warehouse.read(FACT_OPT), warehouse.read(DIM_SELLER))
    return gates.difference(fact, damaged)


def bi_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.warehouse_bi_checks(
        built(spark, sf_dir), views(spark, sf_dir), fixture.STATE_COUNT
    )


def dirty_gate_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_total(dirty_mart_checks(spark, sf_dir))


def orphan_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose seller is missing from a dimension cut to the leaderboard."""
    warehouse = built(spark, sf_dir)
    known = bi.bi_seller_leaderboard(warehouse.read(DIM_SELLER))
    return gates.absent(warehouse.read(FACT), "seller_id", known, "seller_id").withColumnRenamed(
        "rows", "bad_rows"
    )


def calendar_missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders outside a calendar that only covers the first half of 1998."""
    layer = views(spark, sf_dir)
    calendar = layer["vw_bi_calendar"].where(F.col("order_month").between(*fixture.HALF_YEAR))
    missing = gates.absent(layer["vw_bi_orders"], "order_date", calendar, "date")
    return missing.withColumnRenamed("rows", "bad_rows")


# -- reports ---------------------------------------------------------------------------


def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.headline(_raw_fact(spark, sf_dir))


def _report(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(views(spark, sf_dir))


def _one_state(layer: dict[str, DataFrame]) -> DataFrame:
    return layer["vw_bi_orders"].where(F.col("customer_state") == fixture.ONE_STATE)


def _trend(layer: dict[str, DataFrame]) -> DataFrame:
    """The trend of one state, which has gaps.

    Its counts leave as doubles: a NULL among integers has no common form elsewhere.
    """
    trend = reports.monthly_trend(_one_state(layer), layer["vw_bi_calendar"])
    return trend.withColumn("delivered_orders", F.col("delivered_orders").cast("double"))


def _slice(layer: dict[str, DataFrame]) -> DataFrame:
    return reports.slice_orders(layer["vw_bi_orders"], SLICE_FROM, SLICE_TO, SLICE_REGION)


def _star_members(layer: dict[str, DataFrame]) -> DataFrame:
    return reports.star_members(
        layer["vw_bi_orders"], layer["vw_bi_calendar"], layer["vw_bi_seller_leaderboard"]
    )


def _whole_trend(layer: dict[str, DataFrame]) -> DataFrame:
    trend = reports.monthly_trend(layer["vw_bi_orders"], layer["vw_bi_calendar"])
    return trend.withColumn("delivered_orders", F.col("delivered_orders").cast("double"))


def _all_top_sellers(layer: dict[str, DataFrame]) -> DataFrame:
    return reports.top_sellers(layer["vw_bi_orders"], layer["vw_bi_seller_leaderboard"])


def in_order(query: Query) -> Query:
    """A sorted report with the place of each row, so that its order can be compared."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # one partition after the other: reports have a row per state, month or seller
        rows = query(spark, sf_dir).coalesce(1)
        return rows.withColumn("place", F.monotonically_increasing_id() + 1)

    return run


def inline_state_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per state of an inline relation; a state without customers counts 0."""
    codes = sorted(chr(65 + n // 5) + chr(65 + n % 5) for n in range(fixture.STATE_COUNT))
    inline = inline_states(spark, tuple((code, f"state {code}", code[0]) for code in codes))
    per_state = fixture.raw_customers(spark, sf_dir).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("customers")
    )
    return inline.join(per_state, inline.code == per_state.customer_state, "left").select(
        "code", "name", "region", F.coalesce("customers", F.lit(0)).alias("customers")
    )


def database(sf_dir: str) -> str:
    return "punctual_" + hashlib.sha1(sf_dir.encode()).hexdigest()[:8]


def same_contents(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table on the left, and whether the right one has the same rows."""
    one, other = contents(left).alias("l"), contents(right).alias("r")
    same = F.col("l.fingerprint").eqNullSafe(F.col("r.fingerprint"))
    return one.join(other, "table_name").select(
        "table_name",
        F.col("l.row_count").alias("row_count"),
        (same & (F.col("l.row_count") == F.col("r.row_count"))).alias("same_rows"),
    )


def catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each published table and view, read by its catalog name, against the frames.

    It is published once, over half the orders; two rebuilds later, the first of half the
    orders again and the second of all, the catalog must have what the last one left.
    """
    name, states = database(sf_dir), fixture.states(spark, sf_dir)
    warehouse = Warehouse(spark, folder(spark, sf_dir, "published"))
    whole = write_csv(spark, sf_dir, "published_csv")
    half = write_csv(spark, sf_dir, "published_half_csv", F.col("order_id") % 2 == 0)

    def once(source: str) -> None:
        csv_load.load(warehouse, source)
        marts.build_marts(warehouse)
        write_partitioned(warehouse)

    once(half)
    publish(warehouse, name, states)
    once(half)
    once(whole)
    now = warehouse.pinned()
    frames = {
        **{table: now.read(table) for table in (*RAW_TABLES, FACT, DIM_SELLER, FACT_OPT)},
        "stg_orders": marts.stg_orders(now.read("orders")),
        "stg_order_items": marts.stg_order_items(now.read("order_items")),
        **bi.bi_views(now, states),
    }
    return same_contents(
        {table: spark.table(f"{name}.{table}") for table in PUBLISHED},
        {table: frames[table] for table in PUBLISHED},
    )


def busiest_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third layout query over all states, where more than ten sellers compete."""
    fact = built(spark, sf_dir).read(FACT_OPT).withColumn("seller_state", F.lit(PARAMS.state))
    return layout_bench.state_and_range(fact, PARAMS)


def layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_bench.surviving_rows(built(spark, sf_dir), PARAMS)


def view_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_bench.view_pruning(
        built(spark, sf_dir), fixture.states(spark, sf_dir), PARAMS
    )


def planned_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_bench.planned_scans(built(spark, sf_dir), PARAMS)


def measured_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_bench.measured_scans(built(spark, sf_dir), PARAMS)


def row_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_bench.row_comparison(measured_scans(spark, sf_dir))


def _bench(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return layout_bench.QUERIES[name](built(spark, sf_dir).read(FACT_OPT), PARAMS)

    return query


def layout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = layout_bench.measure(built(spark, sf_dir), PARAMS, "report")
    return layout_bench.comparison(measured)


# -- jobs ------------------------------------------------------------------------------


def rebuild_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count per object after two full rebuilds, and whether both left the same."""
    source, root = write_csv(spark, sf_dir, "rebuild_csv"), folder(spark, sf_dir, "rebuilt")
    states = fixture.states(spark, sf_dir)
    objects = (FACT, DIM_SELLER, FACT_OPT)

    def once() -> list:
        layer = rebuild(
            spark, source, root, states=states, expected_states=fixture.STATE_COUNT
        )
        warehouse = Warehouse(spark, root)
        tables = {name: warehouse.read(name) for name in objects}
        return contents({**tables, **layer}).collect()  # one row per object

    first, second = once(), once()
    rows = [(b.table_name, b.row_count, a == b) for a, b in zip(first, second, strict=True)]
    return spark.createDataFrame(rows, "table_name string, row_count bigint, identical boolean")


def bi_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each extracted view, read back after a failed second extract, against the view."""
    layer, target = views(spark, sf_dir), folder(spark, sf_dir, "extract")
    paths = extract(layer, target)
    last = "vw_bi_seller_leaderboard"
    broken = layer[last].withColumn("seller_state", F.raise_error(F.lit("no view")))
    try:
        extract({**layer, last: broken}, target)
    except PySparkException:
        pass  # as it should: what is read now must be the first extract, whole
    extracted = {name: spark.read.parquet(path) for name, path in paths.items()}
    return same_contents(extracted, {name: layer[name] for name in extracted})


def commit_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are current after each commit of two writers, whose versions cross.

    The one that staged first commits last: what counts is the order of the commits.
    """
    orders = fixture.raw_orders(spark, sf_dir)
    root = folder(spark, sf_dir, "writers")
    one, other = Warehouse(spark, root), Warehouse(spark, root)
    counts = []

    def commit(writer: Warehouse, version: str) -> None:
        writer.commit("orders", version)
        counts.append(Warehouse(spark, root).read("orders").count())

    commit(one, one.stage("orders", orders))
    even = one.stage("orders", orders.where("order_id % 2 = 0"))
    commit(other, other.stage("orders", orders.where("order_id % 3 = 0")))
    commit(one, even)
    commit(other, other.stage("orders", orders.where("order_id % 5 = 0")))
    return spark.createDataFrame(list(enumerate(counts, 1)), "step bigint, orders bigint")


def pinned_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables as two readers see them after a second load, of every third order.

    The pinned reader began before it and must see the four tables of the first load.
    """
    warehouse = Warehouse(spark, folder(spark, sf_dir, "pinned"))
    csv_load.load(warehouse, write_csv(spark, sf_dir, "pinned_csv"))
    pinned = warehouse.pinned()
    some = write_csv(spark, sf_dir, "pinned_some_csv", F.col("order_id") % 3 == 0)
    csv_load.load(warehouse, some)
    seen = [
        row_counts({table: one.read(table) for table in RAW_TABLES}).withColumn("reader", F.lit(name))
        for name, one in (("pinned", pinned), ("latest", warehouse))
    ]
    return seen[0].unionByName(seen[1])


REGISTRY: dict[str, Query] = {
    "csv_load_roundtrip": csv_load_roundtrip,
    "row_count_report": row_count_report,
    "safe_cast_probe": safe_cast_probe,
    "stg_orders": stg_orders,
    "stg_order_items": stg_order_items,
    "items_per_order": per_order_and_seller,
    "primary_seller": primary_sellers,
    "order_totals": totals,
    "fct_delivery_performance": fct_delivery_performance,
    "dim_seller": dim_seller,
    "fct_opt_roundtrip": fct_opt_roundtrip,
    "range_bucket": range_buckets,
    "ref_state": _view("ref_br_state"),
    "bi_orders": _view("vw_bi_orders"),
    "bi_monthly": _view("vw_bi_monthly"),
    "bi_by_state": _view("vw_bi_by_state"),
    "bi_seller_leaderboard": _view("vw_bi_seller_leaderboard"),
    "bi_calendar": _view("vw_bi_calendar"),
    "mart_checks": mart_checks,
    "bi_checks": bi_checks,
    "dirty_mart_checks": dirty_mart_checks,
    "damaged_mart_checks": damaged_mart_checks,
    "empty_mart_checks": empty_mart_checks,
    "damaged_bi_checks": damaged_bi_checks,
    "failed_casts": failed_casts,
    "copy_difference": copy_difference,
    "gate_total": dirty_gate_total,
    "orphan_sellers": orphan_sellers,
    "calendar_missing_dates": calendar_missing_dates,
    "headline": headline,
    "measures_total": _report(lambda v: reports.measures_total(v["vw_bi_orders"])),
    "measures_by_region": _report(lambda v: reports.measures_by_region(v["vw_bi_orders"])),
    "state_ranking": _report(lambda v: reports.state_ranking(v["vw_bi_orders"])),
    "state_spread": _report(lambda v: reports.state_spread(v["vw_bi_orders"])),
    "monthly_trend_with_gaps": _report(_trend),
    "sparse_month_floor": _report(lambda v: reports.trend_above_floor(_trend(v), MONTH_FLOOR)),
    "star_members": _report(_star_members),
    "top_sellers": _report(
        lambda v: reports.top_sellers(
            reports.slice_orders(v["vw_bi_orders"], SLICE_FROM, SLICE_TO),
            v["vw_bi_seller_leaderboard"],
        )
    ),
    "leaderboard_coverage": _report(
        lambda v: reports.leaderboard_coverage(v["vw_bi_orders"], v["vw_bi_seller_leaderboard"])
    ),
    "sliced_measures": _report(lambda v: reports.measures_total(_slice(v))),
    "bench_q1": _bench("q1_quarter_by_state"),
    "bench_q2": _bench("q2_one_state_all_time"),
    "bench_q3": _bench("q3_state_and_range"),
    "history_filter": history_filter,
    "run_tag_extract": run_tag_extract,
    "layout_report": layout_report,
    "layout_rows": layout_rows,
    "view_pruning": view_pruning,
    "planned_scans": planned_scans,
    "measured_scans": measured_scans,
    "row_comparison": row_comparison,
    "catalog_views": catalog_views,
    "inline_state_orders": inline_state_orders,
    "monthly_trend": _report(_whole_trend),
    "top_sellers_all": _report(_all_top_sellers),
    "busiest_sellers": busiest_sellers,
    "ordered_busiest_sellers": in_order(busiest_sellers),
    "ordered_top_sellers": in_order(_report(_all_top_sellers)),
    "ordered_state_ranking": in_order(
        _report(lambda v: reports.state_ranking(v["vw_bi_orders"]))
    ),
    "ordered_trend": in_order(_report(_whole_trend)),
    "ordered_bench_q1": in_order(_bench("q1_quarter_by_state")),
    "ordered_bench_q2": in_order(_bench("q2_one_state_all_time")),
    "ordered_row_counts": in_order(row_count_report),
    "ordered_dirty_checks": in_order(dirty_mart_checks),
    "rebuild_twice": rebuild_twice,
    "bi_extract": bi_extract,
    "commit_order": commit_order,
    "pinned_tables": pinned_tables,
}


def queries() -> dict[str, Query]:
    """The registry, with the session fitted to the input and comparable result types."""

    def prepared(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark, sum(files.size_bytes(spark, p) for p in fixture.paths(sf_dir)))
            return comparable(query(spark, sf_dir))

        return run

    return {name: prepared(query) for name, query in REGISTRY.items()}
