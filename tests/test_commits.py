"""The commit log, and what relies on it: several writers, crashes, drafts, the catalog, extracts."""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from punctual.contracts import DIM_SELLER, FACT, FACT_OPT, RAW_TABLES
from punctual.operators.checks import GateFailed
from punctual.operators.joins import heavy_keys
from punctual.plans import bi, catalog, marts, rebuild
from punctual.sources import csv_load, files, warehouse as store
from punctual.sources.commits import KEPT, CommitLog, Conflict, Snapshot
from punctual.sources.states import ref_br_state
from punctual.sources.warehouse import Warehouse, contents
from tests.test_jobs import ROWS, write

TABLES = (*RAW_TABLES, FACT, DIM_SELLER, FACT_OPT)


@pytest.fixture
def root(tmp_path):
    return f"{tmp_path}/wh"


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    return folder


def versions(root, table):
    home = os.path.join(root, "raw" if table in RAW_TABLES else "marts", table)
    return sorted(name for name in os.listdir(home) if name.startswith("v"))


# -- the log


@pytest.mark.parametrize("way", ["link", "rename"])
def test_a_commit_file_is_never_replaced(spark, tmp_path, monkeypatch, way):
    if way == "rename":  # what other file systems than local disks do
        monkeypatch.setattr(files, "_link", files._rename)
    path = f"{tmp_path}/log/7.json"
    assert files.put_if_absent(spark, path, '{"a": "é"}')
    assert not files.put_if_absent(spark, path, "{}")
    assert json.loads(files.read_text(spark, path)) == {"a": "é"}
    assert [n for n in os.listdir(tmp_path / "log") if "tmp" in n] == []


def test_every_one_of_many_writers_keeps_its_commits(spark, tmp_path):
    def write_some(writer):
        log = CommitLog(spark, f"{tmp_path}/log")
        for k in range(8):
            log.append(lambda state: {**state, f"{writer}-{k}": 1})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write_some, range(4)))
    log = CommitLog(spark, f"{tmp_path}/log")
    assert log.numbers() == list(range(1, 33))
    assert len(log.latest().state) == 32
    sizes = [len(log.at(n).state) for n in log.numbers()]
    assert sizes == list(range(1, 33))  # each adds to what the one before left


def test_old_commit_files_go(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    assert log.latest() == Snapshot(0, {})
    for n in range(KEPT + 3):
        log.append(lambda state, n=n: {"n": n})
    assert log.numbers() == list(range(4, KEPT + 4)) and log.latest().state == {"n": KEPT + 2}


# -- writers of one table


@pytest.mark.parametrize("between", [False, True])
def test_the_last_commit_decides_not_the_last_version(spark, root, between):
    one, other = Warehouse(spark, root), Warehouse(spark, root)
    one.replace("orders", spark.range(1))
    early = one.stage("orders", spark.range(2))
    late = other.stage("orders", spark.range(3))
    other.commit("orders", late)
    if between:
        other.replace("orders", spark.range(4))
    one.commit("orders", early)
    for reader in (one, other, Warehouse(spark, root)):
        assert reader.path("orders").endswith(early) and reader.read("orders").count() == 2
    # the current version and the one before it stay, whatever their names sort like
    assert len(versions(root, "orders")) == 2 and early in versions(root, "orders")
    other.replace("orders", spark.range(5))
    assert early in versions(root, "orders") and one.read("orders").count() == 5


def test_the_other_order(spark, root):
    one, other = Warehouse(spark, root), Warehouse(spark, root)
    early, late = one.stage("orders", spark.range(2)), other.stage("orders", spark.range(3))
    one.commit("orders", early)
    other.commit("orders", late)
    assert one.read("orders").count() == 3
    one.commit("orders", late)  # again: nothing changes, nothing is lost
    assert one.read("orders").count() == 3 and versions(root, "orders") == sorted([early, late])


def test_a_refused_commit_changes_nothing(spark, root):
    warehouse = Warehouse(spark, root)
    warehouse.replace("orders", spark.range(1))
    warehouse.replace("sellers", spark.range(1))
    seen = warehouse.snapshot()
    mine = {t: warehouse.stage(t, spark.range(9)) for t in ("orders", "sellers")}
    warehouse.replace("sellers", spark.range(2))
    with pytest.raises(Conflict, match="sellers was changed since commit 2"):
        warehouse.commit_all(mine, since=seen)
    assert [warehouse.read(t).count() for t in mine] == [1, 2]


def test_dropped_tables_and_abandoned_versions_leave_no_files(spark, root):
    warehouse = Warehouse(spark, root)
    for n in (1, 2):
        warehouse.replace("orders", spark.range(n))
    left = warehouse.stage("orders", spark.range(9))
    assert warehouse.clean() == []  # it is young: its job may still run
    assert [path.rsplit("/", 1)[1] for path in warehouse.clean(older_than=0)] == [left]
    assert warehouse.read("orders").count() == 2 and len(versions(root, "orders")) == 2
    warehouse.drop("orders")
    warehouse.drop("orders")
    assert not warehouse.exists("orders") and versions(root, "orders") == []
    with pytest.raises(FileNotFoundError, match="no table orders"):
        warehouse.path("orders")


# -- tables that belong together


def test_a_crash_between_the_tables_of_a_load_leaves_the_old_four(spark, source, root, monkeypatch):
    warehouse = Warehouse(spark, root)
    csv_load.load(warehouse, write(source))
    before = contents({t: warehouse.read(t) for t in RAW_TABLES}).collect()
    write(source, orders=ROWS["orders"][:5], sellers=["s9,SP"])
    stage, done = Warehouse.stage, []

    def failing(self, table, *args, **kwargs):
        if len(done) == 3:
            raise RuntimeError("power cut")
        done.append(table)
        return stage(self, table, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "stage", failing)
    with pytest.raises(RuntimeError, match="power cut"):
        csv_load.load(warehouse, str(source))
    monkeypatch.undo()
    monkeypatch.setattr(files, "_link", lambda *_: 1 / 0)  # all are staged, the commit fails
    with pytest.raises(ZeroDivisionError):
        csv_load.load(warehouse, str(source))
    monkeypatch.undo()
    assert contents({t: warehouse.read(t) for t in RAW_TABLES}).collect() == before
    csv_load.load(warehouse, str(source))
    assert [warehouse.read(t).count() for t in RAW_TABLES] == [5, 80, 3, 1]


def test_a_pinned_reader_sees_one_commit(spark, source, root):
    warehouse = Warehouse(spark, root)
    csv_load.load(warehouse, write(source))
    pinned = warehouse.pinned()
    csv_load.load(warehouse, write(source, orders=ROWS["orders"][:5], order_items=ROWS["order_items"][:7]))
    assert [pinned.read(t).count() for t in ("orders", "order_items")] == [40, 80]
    assert [warehouse.read(t).count() for t in ("orders", "order_items")] == [5, 7]
    assert pinned.pinned().snapshot() == pinned.snapshot()


def test_marts_become_current_together(spark, source, root, monkeypatch):
    warehouse = Warehouse(spark, root)
    csv_load.load(warehouse, write(source))
    marts.build_marts(warehouse)
    number, before = warehouse.snapshot().number, warehouse.path(FACT)
    monkeypatch.setattr(marts, "dim_seller", lambda fact: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        marts.build_marts(warehouse)
    assert warehouse.path(FACT) == before
    monkeypatch.undo()
    marts.build_marts(warehouse)
    assert warehouse.snapshot().number == number + 1 and warehouse.path(FACT) != before


# -- a rebuild that shows nothing before its gates have passed


def test_a_draft_that_fails_its_gate_was_never_seen(spark, source, root):
    rebuild.rebuild(spark, write(source), root, at_once=True)
    warehouse = Warehouse(spark, root)
    assert warehouse.snapshot().number == 1  # seven tables, one commit
    paths = {t: warehouse.path(t) for t in TABLES}
    early = [row.replace("2018-01-05", "2018-01-29") for row in ROWS["orders"]]
    with pytest.raises(GateFailed, match="delivered_before_purchase"):
        rebuild.rebuild(spark, write(source, orders=early), root, at_once=True)
    assert {t: warehouse.path(t) for t in TABLES} == paths
    views = rebuild.rebuild(spark, write(source, orders=ROWS["orders"][:9]), root, at_once=True)
    assert views["vw_bi_orders"].count() == 9 and warehouse.snapshot().number == 2
    assert spark.sql("SELECT count(*) FROM vw_bi_orders").first()[0] == 9


def test_a_draft_gives_way_to_a_commit_in_between(spark, source, root):
    warehouse = Warehouse(spark, root)
    csv_load.load(warehouse, write(source))
    draft = warehouse.draft()
    draft.replace("orders", spark.range(3))
    draft.drop("sellers")
    assert (draft.read("orders").count(), warehouse.read("orders").count()) == (3, 40)
    assert not draft.exists("sellers") and warehouse.exists("sellers")
    warehouse.replace("sellers", spark.range(1))
    with pytest.raises(Conflict, match="sellers"):
        draft.finish()
    with pytest.raises(RuntimeError, match="finish the draft"):
        draft.publish("x")
    again = warehouse.draft()
    again.replace("orders", spark.range(4))
    again.drop("sellers")
    again.finish()
    assert warehouse.read("orders").count() == 4 and not warehouse.exists("sellers")


# -- the catalog


def test_the_catalog_follows_commits_without_a_drop(spark, source, root, monkeypatch):
    warehouse, name = Warehouse(spark, root), "follow_test"
    rebuild.rebuild(spark, write(source), root)
    catalog.publish(warehouse, name)
    sql = spark.sql
    said = []
    monkeypatch.setattr(type(spark), "sql", lambda self, text, **kw: said.append(text) or sql(text, **kw))
    for rows in (7, 12):  # the version that was published first is deleted by then
        rebuild.rebuild(spark, write(source, orders=ROWS["orders"][:rows]), root)
    monkeypatch.undo()
    assert not any(text.startswith(("DROP", "CREATE TABLE")) for text in said)
    assert any(text.startswith("ALTER TABLE follow_test.orders SET LOCATION") for text in said)
    views = {**bi.bi_views(warehouse, ref_br_state(spark)), **{t: warehouse.read(t) for t in TABLES}}
    published = {t: spark.table(f"{name}.{t}") for t in views}
    assert contents(published).collect() == contents(views).collect()
    months = spark.sql(f"SELECT order_month, count(*) AS n FROM {name}.{FACT_OPT} GROUP BY 1 ORDER BY 1")
    assert [tuple(r) for r in months.collect()] == [(201801, 4), (201802, 4), (201803, 4)]
    one = spark.table(f"{name}.{FACT_OPT}").where("order_month = 201802")
    assert "PartitionFilters: [isnotnull(order_month" in one._jdf.queryExecution().executedPlan().toString()
    # another writer's commit, and one that adds a column
    Warehouse(spark, root).replace("sellers", spark.range(3).withColumn("more", F.lit(1)))
    assert spark.table(f"{name}.sellers").columns == ["id", "more"]
    assert spark.table(f"{name}.sellers").count() == 3
    spark.sql(f"DROP DATABASE {name} CASCADE")
    warehouse.replace("sellers", spark.range(2))  # no database here: nothing to follow
    assert warehouse.read("sellers").count() == 2


def test_a_late_follower_does_not_turn_the_catalog_back(spark, root, monkeypatch):
    one, other, name = Warehouse(spark, root), Warehouse(spark, root), "late_test"
    one.replace("orders", spark.range(1))
    one.publish(name)
    follow = store.Warehouse._follow

    def slow(self):  # another commit, with its own switch, comes in before this one's
        monkeypatch.setattr(store.Warehouse, "_follow", follow)
        other.replace("orders", spark.range(7))
        follow(self)

    monkeypatch.setattr(store.Warehouse, "_follow", slow)
    one.replace("orders", spark.range(5))
    assert one.read("orders").count() == spark.table(f"{name}.orders").count() == 7
    spark.sql(f"DROP DATABASE {name} CASCADE")


# -- the extract


def extracted(spark, target):
    return {name: spark.read.parquet(f"{target}/{name}").count() for name in rebuild.EXTRACT}


def test_a_failing_third_view_leaves_all_three_extracts(spark, source, root, tmp_path):
    target = f"{tmp_path}/extract"
    rebuild.extract(rebuild.rebuild(spark, write(source), root), target)
    before = extracted(spark, target)
    views = rebuild.rebuild(spark, write(source, orders=ROWS["orders"][:30]), root)
    last = rebuild.EXTRACT[2]
    broken = views[last].withColumn("seller_state", F.raise_error(F.lit("no view")))
    with pytest.raises(Exception, match="no view"):
        rebuild.extract({**views, last: broken}, target)
    assert extracted(spark, target) == before and before["vw_bi_orders"] == 40
    rebuild.extract(views, target)
    assert extracted(spark, target)["vw_bi_orders"] == 30
    assert sorted(os.listdir(target)) == sorted(rebuild.EXTRACT)


def test_an_extract_that_stops_half_way_is_ended_by_the_next(spark, source, root, tmp_path, monkeypatch):
    target = f"{tmp_path}/extract"
    views = rebuild.rebuild(spark, write(source), root)
    rebuild.extract(views, target)
    fewer = rebuild.rebuild(spark, write(source, orders=ROWS["orders"][:9]), root)
    wanted = {name: fewer[name].count() for name in rebuild.EXTRACT}
    move, moved = files.move, []

    def once(*args):
        if moved:
            raise RuntimeError("power cut")
        moved.append(args)
        move(*args)

    monkeypatch.setattr(files, "move", once)
    with pytest.raises(RuntimeError, match="power cut"):
        rebuild.extract(fewer, target)
    monkeypatch.undo()
    rebuild.settle(spark, target)
    assert extracted(spark, target) == wanted
    assert sorted(os.listdir(target)) == sorted(rebuild.EXTRACT)


def test_an_extract_is_of_one_commit(spark, source, root, tmp_path):
    rebuild.rebuild(spark, write(source), root)
    warehouse = Warehouse(spark, root)
    views = bi.bi_views(warehouse.pinned(), ref_br_state(spark))
    rebuild.rebuild(spark, write(source, orders=ROWS["orders"][:9]), root)
    rebuild.extract(views, f"{tmp_path}/extract")
    assert extracted(spark, f"{tmp_path}/extract")["vw_bi_orders"] == 40


# -- hot orders from what the load observed


def test_the_load_finds_hot_orders_along_the_way(spark, source, root, monkeypatch):
    items = [f"o{i if i < 40 else 7},{i},p,s0,1.5,0.5" for i in range(940)]
    warehouse = Warehouse(spark, root)
    csv_load.load(warehouse, write(source, order_items=items))
    raw = {t: warehouse.read(t) for t in RAW_TABLES}
    wanted = heavy_keys("order_id", raw["orders"], raw["order_items"], min_rows=100)
    assert marts.known_hot_orders(warehouse, 100) == wanted == ["o7"]
    monkeypatch.setattr(marts, "heavy_keys", lambda *a, **k: 1 / 0)  # no scan before the fact
    marts.build_marts(warehouse, hot_rows=100)
    assert warehouse.read(FACT).count() == 40
    assert warehouse.read(FACT).where("order_id = 'o7'").first().item_count == 901
    assert warehouse.stats(FACT) == {"rows": 40, "low": "o0", "high": "o9"}
    assert warehouse.stats("sellers") == {}


def test_without_an_observed_load_a_job_looks(spark, source, root):
    warehouse = Warehouse(spark, root)
    csv_load.load(warehouse, write(source))
    warehouse.replace("orders", warehouse.read("orders"))
    assert marts.known_hot_orders(warehouse) is None
    marts.build_marts(warehouse)
    assert warehouse.read(FACT).count() == 40
