"""Load, rebuild, extract, publish and the command line."""

from __future__ import annotations

import hashlib
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark import SparkConf
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import registry
from punctual.__main__ import main
from punctual.contracts import DIM_SELLER, FACT, FACT_OPT, RAW_TABLES
from punctual.operators.checks import GateFailed
from punctual.plans import bi, catalog, layout_bench, marts, rebuild
from punctual.session import SQL_SETTINGS, prepare, scratch_dir
from punctual.sources import csv_load, fixture, history
from punctual.sources.warehouse import Warehouse, contents

HEADERS = {
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_customer_date,order_estimated_delivery_date",
    "order_items": "order_id,order_item_id,product_id,seller_id,price,freight_value",
    "customers": "customer_id,customer_city,customer_state",
    "sellers": "seller_id,seller_state",
}
ROWS = {
    "orders": [
        f"o{i},c{i % 3},delivered,2018-0{1 + i % 3}-05 10:00:00,,"
        f"2018-0{1 + i % 3}-1{i % 10} 09:00:00,2018-0{1 + i % 3}-15 00:00:00"
        for i in range(40)
    ],
    "order_items": [f"o{i},{k},p,s{(i + k) % 2},10.5{k},1.25" for i in range(40) for k in (1, 2)],
    "customers": ['c0,"Rio, ""o"" centro",RJ', "c1,x,SP", "c2,x,AL"],
    "sellers": ["s0,SP", "s1,MG"],
}


def write(folder, **changes):
    for table in RAW_TABLES:
        lines = [HEADERS[table], *changes.get(table, ROWS[table])]
        (folder / f"{table}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    return folder


def test_load_takes_files_as_they_are(spark, source, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    csv_load.load(warehouse, write(source))
    orders = warehouse.read("orders")
    assert orders.columns == HEADERS["orders"].split(",")  # unnamed columns stay
    assert orders.schema["order_purchase_timestamp"].dataType == T.TimestampType()
    assert warehouse.read("order_items").schema["price"].dataType == T.DoubleType()
    assert warehouse.read("customers").where("customer_id = 'c0'").first().customer_city == (
        'Rio, "o" centro'
    )
    csv_load.load(warehouse, write(source))
    assert warehouse.read("orders").count() == 40  # replaced, not appended


def test_declared_schema_saves_inference_and_guards_the_header(spark, source, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    schema = T._parse_datatype_string("seller_id string, seller_state string")
    csv_load.load(warehouse, write(source), schemas={"sellers": schema})
    assert warehouse.read("sellers").schema == schema
    wrong = T._parse_datatype_string("seller_id string, state string")
    with pytest.raises(Exception, match="CSV"):
        csv_load.load(warehouse, str(source), schemas={"sellers": wrong})


@pytest.mark.parametrize("bad", ["s2,SP,extra", "s2"])
def test_malformed_row_fails_the_load(spark, source, tmp_path, bad):
    write(source, sellers=[*ROWS["sellers"], bad])
    with pytest.raises(Exception, match="[Mm]alformed"):
        csv_load.load(Warehouse(spark, f"{tmp_path}/wh"), str(source))


def test_failed_load_leaves_the_old_table(spark, source, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    csv_load.load(warehouse, write(source))
    write(source, sellers=[*ROWS["sellers"], "s2,SP,extra"])
    with pytest.raises(Exception, match="[Mm]alformed"):
        csv_load.load(warehouse, str(source))
    assert warehouse.read("sellers").count() == 2


def test_preflight_names_all_missing_files_before_touching_tables(spark, source, tmp_path):
    root = f"{tmp_path}/wh"
    csv_load.load(Warehouse(spark, root), write(source))
    os.remove(source / "orders.csv")
    os.remove(source / "sellers.csv")
    with pytest.raises(csv_load.MissingInputs) as raised:
        rebuild.rebuild(spark, str(source), root)
    assert [os.path.basename(p) for p in raised.value.paths] == ["orders.csv", "sellers.csv"]
    assert Warehouse(spark, root).read("orders").count() == 40


def test_rebuild_is_idempotent_and_sql_can_name_everything(spark, source, tmp_path):
    write(source)
    root = f"{tmp_path}/wh"
    warehouse = Warehouse(spark, root)

    def once():
        views = rebuild.rebuild(spark, str(source), root)
        tables = {name: warehouse.read(name) for name in (FACT, DIM_SELLER, FACT_OPT)}
        return contents({**tables, **views}).collect()

    first = once()
    assert first == once()
    assert {r.table_name: r.row_count for r in first}[FACT_OPT] == 40
    assert spark.sql("SELECT sum(orders) FROM vw_bi_monthly").first()[0] == 40
    assert spark.sql("SELECT count(*) FROM stg_order_items").first()[0] == 80
    # two sellers with one item each per order: the smaller id is primary
    assert {r.seller_id for r in warehouse.read(FACT).select("seller_id").collect()} == {"s0"}

    catalog.publish(warehouse, "mart_test")
    catalog.publish(warehouse, "mart_test")
    months = spark.sql(
        f"SELECT order_month, count(*) AS n FROM mart_test.{FACT_OPT} GROUP BY 1 ORDER BY 1"
    ).collect()
    assert [(r.order_month, r.n) for r in months] == [(201801, 14), (201802, 13), (201803, 13)]
    table = spark.table(f"mart_test.{FACT_OPT}")
    assert dict(table.dtypes)["order_month"] == "bigint"
    spark.sql("DROP DATABASE mart_test CASCADE")


def test_catalog_views_equal_the_frames(spark, sf_dir):
    registry.catalog_views(spark, sf_dir)
    database = "punctual_" + hashlib.sha1(sf_dir.encode()).hexdigest()[:8]
    warehouse = Warehouse(spark, registry.folder(spark, sf_dir, "published"))
    raw = {table: warehouse.read(table) for table in RAW_TABLES}
    frames = {
        "stg_orders": marts.stg_orders(raw["orders"]),
        "stg_order_items": marts.stg_order_items(raw["order_items"]),
        **bi.bi_views(warehouse, fixture.states(spark, sf_dir)),
    }
    for name, frame in frames.items():
        view = spark.table(f"{database}.{name}")
        assert view.dtypes == frame.dtypes
        assert view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty()
    orders = spark.table(f"{database}.vw_bi_orders").where("order_month = 199801")
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_failed_rebuild_leaves_every_old_table(spark, source, tmp_path):
    write(source)
    rebuild.rebuild(spark, str(source), f"{tmp_path}/wh")
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    tables = (*RAW_TABLES, FACT, DIM_SELLER, FACT_OPT)
    paths = {table: warehouse.path(table) for table in tables}
    before = contents({table: warehouse.read(table) for table in tables}).collect()
    fewer = {"orders": ROWS["orders"][:5], "sellers": [*ROWS["sellers"], "s2,SP,extra"]}
    write(source, **fewer)
    with pytest.raises(Exception, match="[Mm]alformed"):
        rebuild.rebuild(spark, str(source), f"{tmp_path}/wh")
    assert {table: warehouse.path(table) for table in tables} == paths
    assert contents({table: warehouse.read(table) for table in tables}).collect() == before


def test_readers_of_the_version_before_can_finish(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    first = warehouse.replace("orders", spark.range(3))
    second = warehouse.replace("orders", spark.range(5))
    assert (first.count(), second.count(), warehouse.read("orders").count()) == (3, 5, 5)
    staged = warehouse.stage("orders", spark.range(9))
    assert warehouse.read("orders").count() == 5
    warehouse.commit("orders", staged)
    assert warehouse.read("orders").count() == 9
    home = tmp_path / "wh" / "raw" / "orders"
    assert len(list(home.glob("v*"))) == 2  # the one before the last is gone


def test_fingerprint_sees_where_nulls_are(spark):
    rows = [spark.createDataFrame([r], "a int, b int") for r in ((None, 7), (7, None))]
    first, second = (contents({"t": df}).first().fingerprint for df in rows)
    assert first != second


def test_marts_follow_changed_input_files(spark, sf_dir, tmp_path):
    copy = shutil.copytree(sf_dir, tmp_path / "in")
    for path in [copy, *copy.iterdir()]:
        path.chmod(0o755)
    before = registry.headline(spark, str(copy)).first()
    first = registry.built(spark, str(copy)).read(FACT).count()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    half = orders.where("o_orderkey % 2 = 0").toArrow()
    pq.write_table(half, copy / "orders.parquet")
    assert registry.built(spark, str(copy)).read(FACT).count() < first
    assert registry.headline(spark, str(copy)).first() != before


def test_gate_stops_the_job_before_the_layout(spark, source, tmp_path):
    early = [row.replace("2018-01-05", "2018-01-29") for row in ROWS["orders"]]
    write(source, orders=early)
    with pytest.raises(GateFailed, match="delivered_before_purchase=14"):
        rebuild.rebuild(spark, str(source), f"{tmp_path}/wh")
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    assert warehouse.exists(FACT) and not warehouse.exists(FACT_OPT)


def test_text_that_is_no_date_is_staged_as_null(spark, source, tmp_path):
    broken = [ROWS["orders"][0].replace("2018-01-15 00:00:00", "soon"), *ROWS["orders"][1:]]
    write(source, orders=broken)
    rebuild.rebuild(spark, str(source), f"{tmp_path}/wh")
    assert Warehouse(spark, f"{tmp_path}/wh").read(FACT).count() == 39


def test_command_line(spark, source, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr("punctual.__main__.get_session", lambda **conf: spark)
    write(source)
    for table in RAW_TABLES:
        os.replace(source / f"{table}.csv", source / f"shop_{table}_2018.csv")
    root, target = f"{tmp_path}/wh", f"{tmp_path}/extract"
    naming = ["--naming", "shop_{table}_2018.csv"]
    assert main(["rebuild", str(source), root, *naming]) == 0
    assert "PASS" in capsys.readouterr().out
    assert main(["extract", root, target]) == 0
    assert spark.read.parquet(f"{target}/vw_bi_orders").count() == 40
    assert sorted(os.listdir(target)) == sorted(rebuild.EXTRACT)
    assert main(["layout", root]) == 0
    assert "reduction_pct" in capsys.readouterr().out
    assert main(["rebuild", str(tmp_path), root]) == 1
    assert "missing source files" in capsys.readouterr().err


# -- measurement -----------------------------------------------------------------------


def test_real_bytes_come_from_the_event_log(spark, sf_dir):
    warehouse = registry.built(spark, sf_dir)
    assert history.event_log_path(spark) is not None
    measured = layout_bench.measure(warehouse, registry.PARAMS, "bench7").collect()
    assert len(measured) == 6
    assert all(row.real_bytes > 0 for row in measured)
    # what tasks say that they read is what the scans of the same queries counted
    rows = {(r.query, r.layout): r.real_rows for r in measured}
    scans = layout_bench.scanned(warehouse, registry.PARAMS).collect()
    assert {(r.query, r.layout): r.read_rows for r in scans} == rows
    kept = layout_bench.surviving_rows(warehouse, registry.PARAMS).collect()
    assert all(0 < rows[r.query, r.layout] <= r.rows for r in kept)
    assert all(row.planned_files > 0 and row.seconds > 0 for row in measured)


def test_nothing_stands_in_where_no_events_are_logged(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(history, "logs_events", lambda _: False)
    measured = layout_bench.measure(registry.built(spark, sf_dir), registry.PARAMS, "bench8")
    assert all(row.real_bytes is None for row in measured.collect())
    compared = {r.query: r for r in layout_bench.comparison(measured).collect()}
    q1 = compared["q1_quarter_by_state"]
    assert q1.base_real_bytes is None and q1.opt_real_bytes is None and q1.reduction_pct is None
    expected = (q1.base_planned_bytes - q1.opt_planned_bytes) * 100 / q1.base_planned_bytes
    assert q1.planned_reduction_pct == pytest.approx(expected, abs=0.051)
    assert q1.opt_files < compared["q2_one_state_all_time"].opt_files


def test_a_log_that_lags_is_an_error(spark):
    with pytest.raises(TimeoutError, match="no end of run never"):
        layout_bench._logged(spark, "never", seconds=0.5)


def test_spark_has_a_default_folder_for_its_log(spark, monkeypatch):
    conf = SparkConf(False).setAll(
        [("spark.eventLog.enabled", "true"), ("spark.eventLog.compress", "false")]
    )
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda _: conf)
    assert history.logs_events(spark) and history.event_log_path(spark) is None


def test_job_history_tells_runs_and_states(spark):
    context = spark.sparkContext
    context.setLocalProperty(layout_bench.RUN, "run9")
    context.setLocalProperty(layout_bench.LAYOUT, "base")
    context.setLocalProperty(layout_bench.QUERY, "count")
    spark.range(1000).repartition(3).count()
    context.setLocalProperty(layout_bench.QUERY, "broken")
    with pytest.raises(Exception):
        spark.range(1).select(F.raise_error(F.lit("x"))).collect()
    context.setLocalProperty(layout_bench.QUERY, None)
    spark.range(1).count()
    for name in (layout_bench.RUN, layout_bench.LAYOUT):
        context.setLocalProperty(name, None)
    jobs = layout_bench._logged(spark, "run9")
    query = F.col("properties")[layout_bench.QUERY]
    mine = jobs.where(F.col("properties")[layout_bench.RUN] == "run9")
    states = {(r.query, r.state) for r in mine.select(query.alias("query"), "state").collect()}
    assert states == {("count", "DONE"), ("broken", "FAILED"), (None, "DONE")}
    work = layout_bench.measured_work(jobs, "run9").collect()
    assert [(r.query, r.layout) for r in work] == [("count", "base")]


def test_lookback_window(spark):
    jobs = spark.sql(
        "SELECT * FROM VALUES (timestamp'2020-01-01 10:00:00', 'a b'),"
        " (timestamp'2020-01-01 12:00:00', 'a b'), (timestamp'2020-01-01 12:00:00', 'a x')"
        " AS t(ts, text)"
    )
    now = F.lit("2020-01-01 12:00:00").cast("timestamp")
    assert history.recent(jobs, "ts", "text", now, 2, "a%", "%x").count() == 1  # > is strict


# -- session ---------------------------------------------------------------------------


def test_session_grows_with_the_input(spark):
    shuffles, scans = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before = {key: spark.conf.get(key) for key in (shuffles, scans, *SQL_SETTINGS)}
    try:
        prepare(spark, 0)
        assert {key: spark.conf.get(key) for key in before} == before
        prepare(spark, 1 << 40)
        assert (spark.conf.get(shuffles), spark.conf.get(scans)) == ("8192", before[scans])
        prepare(spark, 100 << 40)
        assert spark.conf.get(shuffles) == "30000"
        assert spark.conf.get(scans) == f"{1 << 30}b"
        prepare(spark, 0)  # a small query after a large one plans as it would before it
        assert {key: spark.conf.get(key) for key in before} == before
        prepare(spark, 1 << 40)
        spark.conf.set(shuffles, "77")  # the user's word counts
        prepare(spark, 0)
        assert spark.conf.get(shuffles) == "77"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_fixture_tables_cover_the_raw_contract(spark, sf_dir):
    from punctual.contracts import RAW_COLUMNS

    for table, df in fixture.raw_tables(spark, sf_dir).items():
        assert tuple(df.columns) == RAW_COLUMNS[table]
