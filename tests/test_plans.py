"""What the plans must look like to hold at scale."""

from __future__ import annotations

import datetime
import random
import re

import pytest
from frames import fact
from pyspark.sql import functions as F

from punctual import registry
from punctual.contracts import CLUSTER_KEYS, DIM_SELLER, FACT, FACT_COLUMNS, FACT_OPT
from punctual.operators.layout import write_partitioned
from punctual.operators.rollup import (
    items_per_order,
    order_rollup,
    order_rollup_by_order,
    primary_seller,
)
from punctual.operators.layout import plan_files
from punctual.plans import bi, gates, layout_bench, marts, reports
from punctual.sources import fixture
from punctual.sources.states import ref_br_state
from punctual.sources.warehouse import Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "FileScan" in line]


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir):
    return registry.built(spark, sf_dir)


@pytest.fixture(scope="module")
def layer(spark, sf_dir):
    return registry.views(spark, sf_dir)


@pytest.fixture
def unsized(spark):
    """Planning as if no table were known to be small, and without run-time re-planning."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_copy_holds_exactly_the_fact(warehouse):
    source, opt = warehouse.read(FACT), warehouse.read(FACT_OPT)
    assert opt.columns == list(FACT_COLUMNS) == source.columns
    assert [f.dataType for f in opt.schema] == [f.dataType for f in source.schema]
    assert source.exceptAll(opt).isEmpty()
    assert opt.exceptAll(source).isEmpty()


def test_copy_is_sorted_by_cluster_keys_in_each_file(warehouse):
    opt = warehouse.read(FACT_OPT).select(
        *CLUSTER_KEYS,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("i"),
    )
    for file in [r.file for r in opt.select("file").distinct().limit(5).collect()]:
        keys = [tuple(r[:2]) for r in opt.where(F.col("file") == file).orderBy("i").collect()]
        assert keys == sorted(keys)


def test_month_filter_prunes_partitions_through_the_view(layer):
    view = layer["vw_bi_orders"].where(F.col("order_month").between(199801, 199803))
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", scans(view)[0]).group(1)
    assert "order_month" in found and "199801" in found


def test_date_slicer_prunes_partitions_too(layer):
    cut = reports.slice_orders(
        layer["vw_bi_orders"], datetime.date(1998, 1, 10), datetime.date(1998, 2, 10)
    )
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", scans(cut)[0]).group(1)
    assert "199801" in found and "199802" in found


def test_date_slicer_equals_the_date_filter(layer):
    low, high = datetime.date(1998, 1, 10), datetime.date(1998, 2, 10)
    orders = layer["vw_bi_orders"]
    expected = orders.where(F.col("order_date").between(low, high))
    assert reports.slice_orders(orders, low, high).exceptAll(expected).isEmpty()
    assert expected.exceptAll(reports.slice_orders(orders, low, high)).isEmpty()


def test_state_filter_and_columns_reach_the_scan(warehouse):
    query = layout_bench.one_state_all_time(warehouse.read(FACT_OPT), registry.PARAMS)
    scan = scans(query)[0]
    assert "EqualTo(seller_state,AD)" in scan
    assert "ReadSchema: struct<seller_state:string,freight_value:decimal(38,9)>" in scan


def test_top_k_is_not_a_global_sort(warehouse):
    query = layout_bench.state_and_range(warehouse.read(FACT_OPT), registry.PARAMS)
    assert "TakeOrderedAndProject" in plan(query)


def test_items_are_scanned_once_and_combined_before_each_shuffle(spark, sf_dir):
    items = marts.stg_order_items(fixture.raw_order_items(spark, sf_dir))
    text = plan(order_rollup(items))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_sum(price") == 1
    assert text.count("partial_min(") == 1


def test_rollup_by_order_shuffles_and_sorts_once(spark, sf_dir):
    items = marts.stg_order_items(fixture.raw_order_items(spark, sf_dir))
    text = plan(order_rollup_by_order(items))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_rank_limit_runs_before_the_shuffle(spark, sf_dir):
    items = marts.stg_order_items(fixture.raw_order_items(spark, sf_dir))
    text = plan(primary_seller(items_per_order(items)))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_fact_forces_no_broadcast_and_reuses_the_order_partitioning(spark, sf_dir, unsized):
    text = plan(marts.staged_fact(fixture.raw_tables(spark, sf_dir)))
    assert "Broadcast" not in text
    assert text.count("SortMergeJoin") == 3
    # items 1, customers 1, sellers 1, orders by customer / order / seller 3
    assert text.count("Exchange hashpartitioning") == 6
    # rows without an order never reach a shuffle
    items = [line for line in text.splitlines() if "FileScan" in line and "l_suppkey" in line]
    assert items and all("IsNotNull(l_orderkey)" in line for line in items)


def test_dimension_does_not_sort_the_fact(warehouse):
    text = plan(marts.dim_seller(warehouse.read(FACT)))
    # sorting starts after the first aggregation has reduced the fact to sellers
    below = text[text.index("HashAggregate(keys=[seller_id") :]
    assert "Sort" not in below
    assert text.count("FileScan") == 1


def test_mart_checks_scan_each_measure_once(warehouse):
    text = plan(gates.warehouse_mart_checks(warehouse))
    # fact: measures, order ids, sellers; dim: measures, ids, members
    assert text.count("FileScan") == 6
    for operator in ("NestedLoop", "CartesianProduct"):
        assert operator not in text


@pytest.mark.parametrize("name", sorted(registry.REGISTRY))
def test_no_query_needs_python_workers_or_cross_joins(spark, sf_dir, name):
    if name in ("rebuild_twice", "layout_report", "catalog_views"):
        pytest.skip("runs jobs; its parts are covered")
    text = plan(registry.REGISTRY[name](spark, sf_dir))
    for operator in ("Python", "NestedLoop", "CartesianProduct"):
        assert operator not in text


def test_planned_bytes_see_only_the_months_asked_for(warehouse):
    rows = {
        (r.query, r.layout): r for r in layout_bench.planned(warehouse, registry.PARAMS).collect()
    }
    base = rows["q1_quarter_by_state", "base"].planned_bytes
    assert rows["q3_state_and_range", "base"].planned_bytes == base
    q1, q2, q3 = (rows[name, "opt"].planned_bytes for name in layout_bench.QUERIES)
    assert q1 < q3 < q2
    assert q2 == warehouse.size_bytes(FACT_OPT)


@pytest.fixture
def whole_paths(spark):
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    yield
    spark.conf.set(key, before)


def test_calendar_reads_dates_of_two_months(spark, layer, warehouse, whole_paths):
    dates, *months = sorted(scans(layer["vw_bi_calendar"]), key=lambda s: "struct<>" in s)
    assert "ReadSchema: struct<order_date:date>" in dates
    assert "order_month" in dates.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ubquery" in dates.split("PartitionFilters:")[1]
    assert months and all("ReadSchema: struct<>" in scan for scan in months)


def test_bi_gate_reads_the_copy_in_few_ways(warehouse, layer, whole_paths):
    """Equal scans are one at run time: Spark reuses equal subqueries and exchanges."""
    gate = gates.warehouse_bi_checks(warehouse, layer, fixture.STATE_COUNT)
    copy = [scan for scan in scans(gate) if f"/{FACT_OPT}/" in scan]
    whole = {scan.split("ReadSchema:")[1] for scan in copy if "ubquery" not in scan}
    assert 2 <= len(whole) <= 4


def test_layout_tasks_stay_bounded_at_any_size():
    assert plan_files(100 << 40, 10**12, 128 << 20, 8)[0] == 30_000
    tasks, records = plan_files(100 << 40, 819_200 * 1000, 128 << 20, 8)
    assert (tasks, records) == (30_000, 1000)
    assert plan_files(0, 0, 128 << 20, 8) == (1, 1)


def test_reference_states_join_by_broadcast(spark, warehouse):
    text = plan(bi.bi_orders(warehouse.read(FACT_OPT), ref_br_state(spark)))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text


def test_hot_customers_and_sellers_are_split(spark, sf_dir):
    """Adaptive execution splits both skewed joins of the fact, whatever follows them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512b",
    }
    tables = fixture.raw_tables(spark, sf_dir)
    third = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
    tables["orders"] = tables["orders"].withColumn(
        "customer_id", F.when(third, F.lit(0)).otherwise(F.col("customer_id"))
    ).repartition(8)
    tables["order_items"] = tables["order_items"].withColumn(
        "seller_id", F.when(third, F.lit(0)).otherwise(F.col("seller_id"))
    )
    expected = marts.staged_fact(tables).collect()
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        built = marts.staged_fact(tables)
        rows = built.collect()
        final = plan(built).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert sorted(map(str, rows)) == sorted(map(str, expected))
    for key in ("customer_id", "seller_id"):
        assert re.search(rf"SortMergeJoin\(skew=true\) \[{key}", final), key


@pytest.fixture
def small_warehouse(spark, tmp_path):
    return Warehouse(spark, f"file://{tmp_path}/wh")


def test_a_hot_seller_and_month_spread_over_many_files(spark, small_warehouse):
    keys = F.struct(
        F.when(F.col("id") % 3 == 0, 201801).otherwise(201701 + F.col("id") % 12).alias("m"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("s"),
    )
    rows = fact(spark, {}).drop("order_id", "order_month", "seller_id")
    many = spark.range(30_000).select(F.col("id").cast("string").alias("order_id"), keys.alias("k"))
    table = many.select(
        "order_id",
        F.col("k.m").cast("bigint").alias("order_month"),
        F.col("k.s").alias("seller_id"),
        *(F.lit(value).cast(rows.schema[name].dataType).alias(name)
          for name, value in rows.first().asDict().items()),
    ).select(*FACT_COLUMNS)
    small_warehouse.replace(FACT, table)
    opt = write_partitioned(small_warehouse, file_bytes=small_warehouse.size_bytes(FACT) // 10)
    hot = opt.where("seller_id = 'hot'").groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(row["count"] for row in hot) == 10_000
    assert len(hot) >= 3 and max(row["count"] for row in hot) <= 5_000
    assert opt.exceptAll(table).isEmpty() and table.exceptAll(opt).isEmpty()


def test_copy_keeps_rows_without_a_month_and_odd_text(spark, small_warehouse):
    table = fact(
        spark, {"order_month": None}, {"seller_state": "=/%", "seller_id": ""}, {"seller_id": None}
    )
    small_warehouse.replace(FACT, table)
    opt = write_partitioned(small_warehouse)
    assert opt.exceptAll(table).isEmpty() and table.exceptAll(opt).isEmpty()


# -- scans, differences and distinct counts ----------------------------------------------


def test_provenance_agrees_with_the_plan_of_files(warehouse):
    planned = layout_bench.planned(warehouse, registry.PARAMS).collect()
    seen = {(r.query, r.layout): r for r in layout_bench.provenance(warehouse, registry.PARAMS).collect()}
    for row in planned:
        mine = seen[row.query, row.layout]
        assert (mine.files, mine.bytes) == (row.planned_files, row.planned_bytes)


def test_opened_files_name_their_months_and_rows(warehouse):
    opt = layout_bench.traced(warehouse.read(FACT_OPT))
    files = layout_bench.opened_files(opt.where(F.col("order_month").between(199801, 199803))).collect()
    assert sorted(month for f in files for month in f.months) == [199801, 199802, 199803]
    assert all(f"order_month={f.months[0]}" in f.path and f.blocks == 1 for f in files)
    assert sum(f.rows for f in files) == opt.where("order_month between 199801 and 199803").count()
    plain = layout_bench.opened_months(layout_bench.traced(warehouse.read(FACT))).collect()
    assert len(plain) > 3 and not any(r.alone for r in plain)


def test_scans_are_counted_where_they_ran(warehouse):
    opt = warehouse.read(FACT_OPT)
    one = opt.where("order_month = 199801").groupBy("seller_state").count()
    assert layout_bench.scan_metrics(one)["rows"] == 0  # not yet run
    n = sum(r["count"] for r in one.collect())
    assert layout_bench.scan_metrics(one) == {"files": 1, "partitions": 1, "rows": n}
    joined = opt.join(warehouse.read(DIM_SELLER), "seller_id").agg(F.count(F.lit(1)).alias("n"))
    joined.collect()
    read = layout_bench.scan_metrics(joined)
    assert read["rows"] == opt.count() + warehouse.read(DIM_SELLER).count()


@pytest.mark.parametrize("seed", range(4))
def test_difference_equals_the_set_operation(spark, seed):
    rng = random.Random(seed)

    def table():
        rows = [
            (rng.choice([None, 1, 2]), rng.choice([None, "a", ""]), rng.choice([None, 0.5, float("nan")]))
            for _ in range(rng.choice([0, 30, 200]))
        ]
        return spark.createDataFrame(rows, "i int, s string, d double")

    left, right = table(), table()
    row = gates.difference(left, right.select("d", "s", "i")).first()
    assert row.only_left == left.exceptAll(right).count()
    assert row.only_right == right.exceptAll(left).count()


def test_difference_of_other_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="other columns"):
        gates.difference(spark.range(1), spark.range(1).withColumnRenamed("id", "i"))


def test_difference_shuffles_a_hash_of_each_row_once(warehouse):
    text = plan(gates.difference(warehouse.read(FACT), warehouse.read(FACT_OPT)))
    assert text.count("Exchange hashpartitioning") == 1
    moved = re.search(r"Exchange hashpartitioning\((.*?), \d+\)", text).group(1)
    assert re.sub(r"#\d+L?", "", moved) == "a, b"
    assert "partial_sum(sign" in text and "Join" not in text


@pytest.mark.parametrize(
    "keys", [[], [None], [5], [5, 5, None], [-40_000, -1, 0, 1, 32_767, 32_768, 99_999], list(range(70_000))]
)
def test_bitmaps_count_distinct_integers(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys * 2], "k bigint").repartition(5)
    assert gates._distinct(df, "k", dense=True).first()["keys"] == len(set(keys) - {None})


def test_dense_keys_do_not_move(spark, sf_dir, warehouse):
    assert gates.is_dense(warehouse.stats(FACT)) and gates.is_dense(warehouse.stats(DIM_SELLER))
    text = plan(gates.warehouse_mart_checks(warehouse))
    assert text.count("bitmap_construct_agg") >= 2 and "distinct order_id" not in text
    for key in ("order_id", "seller_id"):
        assert not re.search(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\), ENSURE_REQUIREMENTS, \[plan_id=\d+\]\n\s*\+- \*?\(?\d*\)? ?HashAggregate\(keys=\[{key}#\d+L?\], functions=\[\]", text)
    rows = {r.check_name: r.bad_rows for r in gates.warehouse_mart_checks(warehouse).collect()}
    exact = gates.mart_checks(warehouse.read(FACT), warehouse.read(DIM_SELLER)).collect()
    assert rows == {r.check_name: r.bad_rows for r in exact}


def test_sparse_and_text_keys_are_counted_as_before():
    assert gates.is_dense({"rows": 10, "low": 1, "high": 600})
    assert not gates.is_dense({"rows": 10, "low": 1, "high": 10_000_000})
    assert not gates.is_dense({"rows": 10, "low": "a", "high": "b"})
    assert not gates.is_dense({}) and not gates.is_dense({"rows": 0, "low": None, "high": None})


def test_the_copy_has_small_row_groups(warehouse):
    import glob

    import pyarrow.parquet as pq

    folder = warehouse.path(FACT_OPT).removeprefix("file:").removeprefix("//")
    for path in glob.glob(f"{folder}/*/*.parquet")[:3]:
        meta = pq.ParquetFile(path).metadata
        assert all(meta.row_group(i).total_byte_size <= 17 << 20 for i in range(meta.num_row_groups))
