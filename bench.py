"""Times the headline queries and measures the layout; prints one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the local cores. Each query runs
once to warm the JVM and is then timed; results go to the ``noop`` sink, so every row and
column is computed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual import registry
from punctual.contracts import DIM_SELLER, FACT, FACT_OPT, NUMERIC
from punctual.operators.layout import write_partitioned
from punctual.plans import bi, gates, layout_bench, marts, reports
from punctual.session import get_session
from punctual.sources import fixture
from punctual.sources.warehouse import Warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_LAYOUT_COPIES", "100"))


def main() -> None:
    events = tempfile.mkdtemp(prefix="bench-events-")
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=CPUS,
        spark__eventLog__enabled="true",
        spark__eventLog__compress="false",
        spark__eventLog__dir=f"file://{events}",
        # Spark's byte counts miss what other threads read.
        spark__hadoop__parquet__hadoop__vectored__io__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    warehouse = registry.built(spark, SF_DIR)
    rebuilt = Warehouse(spark, registry.folder(spark, SF_DIR, "bench"))
    raw = fixture.raw_tables(spark, SF_DIR)
    states = fixture.states(spark, SF_DIR)
    fact, dim, opt = (warehouse.read(name) for name in (FACT, DIM_SELLER, FACT_OPT))
    views = bi.bi_views(warehouse, states)
    orders, board = views["vw_bi_orders"], views["vw_bi_seller_leaderboard"]
    params = registry.PARAMS

    queries = {
        "build_marts": lambda: marts.build_marts(rebuilt, raw),
        "write_layout": lambda: write_partitioned(rebuilt) and None,
        "fact": lambda: marts.staged_fact(raw, marts.hot_orders(raw)),
        "dim_seller": lambda: marts.dim_seller(fact),
        "headline_from_raw": lambda: reports.headline(
            marts.staged_fact(raw, marts.hot_orders(raw))
        ),
        "headline": lambda: reports.headline(fact),
        "mart_checks": lambda: gates.mart_checks(fact, dim),
        "bi_checks": lambda: gates.bi_checks(fact, opt, views, fixture.STATE_COUNT),
        "bi_orders": lambda: orders,
        "bi_monthly": lambda: views["vw_bi_monthly"],
        "bi_by_state": lambda: views["vw_bi_by_state"],
        "bi_seller_leaderboard": lambda: board,
        "bi_calendar": lambda: views["vw_bi_calendar"],
        "measures_by_region": lambda: reports.measures_by_region(orders),
        "state_ranking": lambda: reports.state_ranking(orders),
        "monthly_trend": lambda: reports.monthly_trend(orders, views["vw_bi_calendar"]),
        "top_sellers": lambda: reports.top_sellers(orders, board),
        "leaderboard_coverage": lambda: reports.leaderboard_coverage(orders, board),
        **{
            f"{name}_{layout}": lambda build=build, table=table: build(table, params)
            for name, build in layout_bench.QUERIES.items()
            for layout, table in (("base", fact), ("opt", opt))
        },
    }

    def seconds(query) -> float:
        begin = time.perf_counter()
        result = query()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    for query in queries.values():
        seconds(query)
    times = {name: seconds(query) for name, query in queries.items()}

    def compared(of: Warehouse, run_id: str) -> dict:
        measured = layout_bench.measure(of, params, run_id)
        return {row.query: row.asDict() for row in layout_bench.comparison(measured).collect()}

    layout = compared(warehouse, "bench")
    # a month of the test tables is a file of some KB; the layout is for files of some MB,
    # of orders that differ: equal ones would be folded away by dictionaries
    large = Warehouse(spark, registry.folder(spark, SF_DIR, "bench-large"))

    def drawn(seed: int, values: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "order_id", "id"), F.lit(values))

    copies = fact.repartition(16).crossJoin(spark.range(COPIES)).withColumns(
        {
            "order_id": F.col("order_id") * COPIES + F.col("id"),
            "seller_id": F.col("seller_id") * 7 + drawn(1, 7),
            "order_value": (drawn(2, 10_000_000) / 100).cast(NUMERIC),
            "freight_value": (drawn(3, 10_000) / 100).cast(NUMERIC),
            "late_days": drawn(4, 40) - 20,
            "delivery_days": drawn(5, 60),
        }
    )
    large.replace(FACT, copies.drop("id"))
    write_partitioned(large)
    large_layout = compared(large, "benchlarge")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "layout": layout,
                "layout_of_copies": {"copies": COPIES, **large_layout},
            }
        )
    )


if __name__ == "__main__":
    main()
