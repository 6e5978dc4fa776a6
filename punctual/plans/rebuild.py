"""The jobs: full rebuild from raw to gated BI layer, and the report extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctual.contracts import EXPECTED_STATES, RAW_TABLES
from punctual.operators.checks import enforce
from punctual.operators.layout import write_partitioned
from punctual.plans.bi import bi_views, register_views
from punctual.plans.gates import warehouse_bi_checks, warehouse_mart_checks
from punctual.plans.marts import build_marts, stg_order_items, stg_orders
from punctual.session import prepare
from punctual.sources import csv_load, files
from punctual.sources.states import ref_br_state
from punctual.sources.warehouse import Warehouse

DRAFTS, COMPLETE = "_drafts", "_complete"
EXTRACT = ("vw_bi_orders", "vw_bi_calendar", "vw_bi_seller_leaderboard")


def build(
    warehouse: Warehouse,
    states: DataFrame | None = None,
    expected_states: int = EXPECTED_STATES,
) -> dict[str, DataFrame]:
    """Marts, gate, layout, views, gate; the first gate that fails stops the job.

    Each stage ends in a written table, so a later stage never recomputes an earlier
    one, whatever executors are lost.
    """
    spark = warehouse.spark
    prepare(spark, sum(warehouse.size_bytes(table) for table in RAW_TABLES))
    states = ref_br_state(spark) if states is None else states
    build_marts(warehouse)
    enforce(warehouse_mart_checks(warehouse), "mart checks failed")
    write_partitioned(warehouse)
    enforce(
        warehouse_bi_checks(warehouse, bi_views(warehouse, states), expected_states),
        "BI checks failed",
    )
    return register(warehouse, states)


def register(warehouse: Warehouse, states: DataFrame) -> dict[str, DataFrame]:
    """The session's staging and BI views, all over the same commit; the BI views."""
    now = warehouse.pinned()
    views = bi_views(now, states)
    register_views(
        {
            "stg_orders": stg_orders(now.read("orders")),
            "stg_order_items": stg_order_items(now.read("order_items")),
            **views,
        }
    )
    return views


def rebuild(
    spark: SparkSession,
    source_dir: str,
    root: str,
    naming: str = csv_load.DEFAULT_NAMING,
    states: DataFrame | None = None,
    expected_states: int = EXPECTED_STATES,
    at_once: bool = False,
) -> dict[str, DataFrame]:
    """Rebuild everything from the CSV files. Running it twice leaves the same data.

    All files are checked, read and staged before the first table changes, so a missing or
    malformed one leaves the warehouse as it was. Raw tables, marts and the copy are a
    commit each, and a gate that fails leaves what it looked at in place. With ``at_once``
    everything is built and gated unseen and becomes current in one commit: a gate that
    fails changes nothing, and so does somebody else's commit in between (``Conflict``).
    """
    csv_load.preflight(spark, csv_load.source_paths(source_dir, naming))
    warehouse = Warehouse(spark, root)
    warehouse.clean()
    target = warehouse.draft() if at_once else warehouse
    csv_load.load(target, source_dir, naming)
    views = build(target, states, expected_states)
    if at_once:
        target.finish()
        views = register(warehouse, ref_br_state(spark) if states is None else states)
    return views


def extract(views: dict[str, DataFrame], target: str) -> dict[str, str]:
    """Snapshot the three views the report model imports; path per view.

    ``views`` come from one commit where they are built on a ``pinned`` warehouse. All
    three are written beside the extracts that are there, so a view that fails leaves all
    three as they were. Then a note says that they are complete, and each takes the place
    of its predecessor. Where that stops half way, the next extract, or ``settle`` alone,
    ends it: the three always end up from one run.
    """
    spark = views[EXTRACT[0]].sparkSession
    target = target.rstrip("/")
    settle(spark, target)
    drafts = f"{target}/{DRAFTS}"
    files.delete(spark, drafts)  # of a run that failed before it was complete
    for name in EXTRACT:
        views[name].write.parquet(f"{drafts}/{name}")
    files.write_text(spark, f"{drafts}/{COMPLETE}", "\n".join(EXTRACT))
    return settle(spark, target)


def settle(spark: SparkSession, target: str) -> dict[str, str]:
    """Put complete drafts of an extract in place, if there are any; path per view."""
    target = target.rstrip("/")
    drafts = f"{target}/{DRAFTS}"
    if files.exists(spark, f"{drafts}/{COMPLETE}"):
        for name in EXTRACT:
            if files.exists(spark, f"{drafts}/{name}"):
                files.delete(spark, f"{target}/{name}")
                files.move(spark, f"{drafts}/{name}", f"{target}/{name}")
        files.delete(spark, drafts)
    return {name: f"{target}/{name}" for name in EXTRACT}
