"""What the partitioned copy saves: three queries on both layouts, planned and real."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.contracts import FACT, FACT_OPT, PARTITION_KEY
from punctual.functions.scalar import mean_money
from punctual.plans.bi import bi_orders
from punctual.sources import history
from punctual.sources.warehouse import Warehouse

LAYOUTS = {"base": FACT, "opt": FACT_OPT}
# properties of the jobs of a run
RUN, QUERY, LAYOUT = "punctual.layout.run", "punctual.layout.query", "punctual.layout.layout"


@dataclass(frozen=True)
class Params:
    quarter: tuple[int, int] = (201801, 201803)
    half_year: tuple[int, int] = (201801, 201806)
    state: str = "SP"


def quarter_by_state(fact: DataFrame, p: Params) -> DataFrame:
    """A narrow month range over all states."""
    return (
        fact.where(F.col("order_month").between(*p.quarter))
        .groupBy("seller_state")
        .agg(
            F.round(F.avg("late_days"), 2).alias("avg_late_days"),
            F.count(F.lit(1)).alias("orders"),
        )
        .orderBy(F.desc("orders"), "seller_state")
    )


def one_state_all_time(fact: DataFrame, p: Params) -> DataFrame:
    """One state over the full history."""
    return (
        fact.where(F.col("seller_state") == p.state)
        .groupBy("order_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(mean_money("freight_value"), 2).alias("avg_freight"),
        )
        .orderBy("order_month")
    )


def state_and_range(fact: DataFrame, p: Params) -> DataFrame:
    """One state within a month range: its ten busiest sellers, ties by id."""
    return (
        fact.where(
            F.col("order_month").between(*p.half_year) & (F.col("seller_state") == p.state)
        )
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.avg("delivery_days"), 2).alias("avg_delivery_days"),
        )
        .orderBy(F.desc("orders"), "seller_id")
        .limit(10)
    )


# The names of the three queries.
QUERIES = {
    "q1_quarter_by_state": quarter_by_state,
    "q2_one_state_all_time": one_state_all_time,
    "q3_state_and_range": state_and_range,
}
_MONTHS = {"q1_quarter_by_state": "quarter", "q3_state_and_range": "half_year"}


def planned(warehouse: Warehouse, p: Params) -> DataFrame:
    """Files each query opens and their bytes, by partition pruning only.

    That is neither a bound of what tasks read nor an estimate of it: they skip columns and
    row groups, but read the end of a file, where its layout stands, once to plan and once
    to read, which on files of some KB is most of it. The month range is applied where months are partitions. Other filters are left
    out, because they cannot exclude a file before it is opened. Files are listed, not
    read: the file source has one row per file, and its content is never asked for.
    """
    listing = warehouse.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    rows = []
    for query in QUERIES:
        for layout, name in LAYOUTS.items():
            data = listing.load(warehouse.path(name))
            if layout == "opt" and query in _MONTHS:
                data = data.where(F.col(PARTITION_KEY).between(*getattr(p, _MONTHS[query])))
            rows.append(
                data.agg(
                    F.count(F.lit(1)).alias("planned_files"),
                    F.coalesce(F.sum("length"), F.lit(0)).alias("planned_bytes"),
                ).select(F.lit(query).alias("query"), F.lit(layout).alias("layout"), "*")
            )
    return reduce(DataFrame.unionByName, rows)


def run(warehouse: Warehouse, p: Params, run_id: str) -> DataFrame:
    """Run every query on both layouts and log what it took.

    Each job carries run, query and layout as job properties, which the history keeps. A
    last job without a query marks the end of the run. Results are tiny (a row per state,
    per month, or ten), so collecting them is bounded.
    """
    context, log = warehouse.spark.sparkContext, []
    context.setLocalProperty(RUN, run_id)
    try:
        for query, build in QUERIES.items():
            for layout, name in LAYOUTS.items():
                context.setLocalProperty(QUERY, query)
                context.setLocalProperty(LAYOUT, layout)
                begin = time.perf_counter()
                build(warehouse.read(name), p).collect()
                log.append((query, layout, time.perf_counter() - begin))
        for key in (QUERY, LAYOUT):
            context.setLocalProperty(key, None)
        warehouse.spark.range(1).count()
    finally:
        for key in (RUN, QUERY, LAYOUT):
            context.setLocalProperty(key, None)
    return warehouse.spark.createDataFrame(log, "query string, layout string, seconds double")


def _property(name: str) -> Column:
    return F.col("properties")[name]


def measured_work(jobs: DataFrame, run_id: str) -> DataFrame:
    """Bytes and task time per query and layout of a run, by its jobs' properties."""
    return (
        jobs.where((F.col("state") == "DONE") & (_property(RUN) == run_id))
        .where(_property(QUERY).isNotNull())
        .groupBy(_property(QUERY).alias("query"), _property(LAYOUT).alias("layout"))
        .agg(
            F.sum("total_bytes_processed").alias("read_bytes"),
            F.sum("total_records_read").alias("read_rows"),
            F.sum("total_task_ms").alias("task_ms"),
        )
    )


def _logged(spark: SparkSession, run_id: str, seconds: float = 30) -> DataFrame | None:
    """The history once it holds the run's end; None where the session logs no events.

    The log is written behind the jobs. It is read anew after growing pauses; if the end
    doesn't come, that is an error, not a result.
    """
    if not history.logs_events(spark):
        return None
    ended = (F.col("state") == "DONE") & (_property(RUN) == run_id) & _property(QUERY).isNull()
    deadline, pause = time.monotonic() + seconds, 0.2
    while True:
        path = history.event_log_path(spark)
        if path is not None:
            jobs = history.job_history(spark, path)
            if not jobs.where(ended).isEmpty():
                return jobs
        if time.monotonic() >= deadline:
            raise TimeoutError(f"the event log has no end of run {run_id} after {seconds} s")
        time.sleep(pause)
        pause = min(2 * pause, 5)


def measure(warehouse: Warehouse, p: Params, run_id: str) -> DataFrame:
    """Planned and real bytes per query and layout.

    Real bytes and rows are those the tasks read, from the event log. Where the session logs no
    events nothing was measured, and ``real_bytes`` is NULL.
    """
    runs = run(warehouse, p, run_id)
    jobs = _logged(warehouse.spark, run_id)
    if jobs is None:
        unknown = F.lit(None).cast("bigint")
        real = runs.withColumns(
            {"read_bytes": unknown, "read_rows": unknown, "task_ms": unknown}
        )
    else:
        real = runs.join(measured_work(jobs, run_id), ["query", "layout"], "left")
    return (
        planned(warehouse, p)
        .join(real, ["query", "layout"], "left")
        .withColumnsRenamed({"read_bytes": "real_bytes", "read_rows": "real_rows"})
    )


# -- where rows were read ----------------------------------------------------------------


def traced(table: DataFrame) -> DataFrame:
    """``table`` with ``scanned``: the file each row was read from, by Spark's own record.

    The hidden columns of the file source survive filters, so what is left of them after a
    filter on partitions is what a scan with that filter opens.
    """
    meta = F.col("_metadata")
    return table.select(
        "*",
        F.struct(
            meta["file_path"].alias("path"),
            meta["file_size"].alias("bytes"),
            meta["file_block_start"].alias("block"),
        ).alias("scanned"),
    )


def opened_files(rows: DataFrame) -> DataFrame:
    """Per file that ``rows``, traced, come from: its bytes, months, rows and blocks.

    Counted per file, month and block first, so a file's rows are never together.
    """
    fine = rows.groupBy("scanned", PARTITION_KEY).agg(F.count(F.lit(1)).alias("rows"))
    return fine.groupBy(F.col("scanned.path").alias("path"), F.col("scanned.bytes").alias("bytes")).agg(
        F.collect_set(PARTITION_KEY).alias("months"),  # a table has few
        F.sum("rows").alias("rows"),
        F.count_distinct("scanned.block").alias("blocks"),
    )


def opened_months(rows: DataFrame) -> DataFrame:
    """Per month in the files that a scan opens: its orders, and whether every file that
    has some has that month alone."""
    fine = rows.groupBy("scanned.path", PARTITION_KEY).agg(F.count(F.lit(1)).alias("orders"))
    months = fine.groupBy("path").agg(F.count(F.lit(1)).alias("months"))
    return (
        fine.join(months, "path")
        .groupBy(PARTITION_KEY)
        .agg(F.sum("orders").alias("orders"), (F.max("months") == 1).alias("alone"))
    )


def pruned(warehouse: Warehouse, query: str, layout: str, p: Params) -> DataFrame:
    """What partition pruning leaves of a layout's table for a query, traced."""
    data = traced(warehouse.read(LAYOUTS[layout]))
    if layout == "opt" and query in _MONTHS:
        data = data.where(F.col(PARTITION_KEY).between(*getattr(p, _MONTHS[query])))
    return data


def view_pruning(warehouse: Warehouse, states: DataFrame, p: Params) -> DataFrame:
    """The months in the files that a quarter's filter opens: by way of the order view,
    whose filter has to reach the partitions, and on the plain fact, which has none."""
    view = bi_orders(traced(warehouse.read(FACT_OPT)), states, "scanned")
    quarter = view.where(F.col(PARTITION_KEY).between(*p.quarter))
    sides = {"view": quarter, "fact": traced(warehouse.read(FACT))}
    return reduce(
        DataFrame.unionByName,
        (opened_months(rows).withColumn("source", F.lit(name)) for name, rows in sides.items()),
    )


def provenance(warehouse: Warehouse, p: Params) -> DataFrame:
    """Per query and layout, by the rows' own record: files, bytes, months and rows."""
    return reduce(
        DataFrame.unionByName,
        (
            opened_files(pruned(warehouse, query, layout, p))
            .agg(
                F.count(F.lit(1)).alias("files"),
                F.sum("bytes").alias("bytes"),
                F.size(F.array_distinct(F.flatten(F.collect_list("months")))).cast("bigint").alias("months"),
                F.sum("rows").alias("rows"),
            )
            .select(F.lit(query).alias("query"), F.lit(layout).alias("layout"), "*")
            for query in QUERIES
            for layout in LAYOUTS
        ),
    )


def planned_scans(warehouse: Warehouse, p: Params) -> DataFrame:
    """The planned side against the rows' own record of where they were read.

    Empty files are planned for but give no row; there are none in tables written here.
    """
    same = (F.col("files") == F.col("planned_files")) & (F.col("bytes") == F.col("planned_bytes"))
    return (
        planned(warehouse, p)
        .join(provenance(warehouse, p), ["query", "layout"], "left")
        .select("query", "layout", "months", "rows", same.alias("as_planned"))
    )


# -- what scans really did ---------------------------------------------------------------


def scan_metrics(df: DataFrame) -> dict[str, int]:
    """Files, partitions and rows that the file scans of a finished query have read.

    Spark counts them per scan of the executed plan; stages that adaptive execution has
    run stand behind query stages.
    """
    found = {"files": 0, "partitions": 0, "rows": 0}
    names = {"files": "numFiles", "partitions": "numPartitions", "rows": "numOutputRows"}
    waiting = [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            metrics = node.metrics()
            for key, name in names.items():
                if metrics.contains(name):
                    found[key] += metrics.apply(name).value()
        elif kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def scanned(warehouse: Warehouse, p: Params) -> DataFrame:
    """Runs every query on both layouts; what its scan read, and the rows that it kept."""
    rows = []
    for query, build in QUERIES.items():
        for layout, name in LAYOUTS.items():
            result = build(warehouse.read(name), p)
            kept = sum(row["orders"] for row in result.collect())  # a row per state or month, or ten
            read = scan_metrics(result)
            rows.append((query, layout, read["files"], read["partitions"], read["rows"], kept))
    return warehouse.spark.createDataFrame(
        rows,
        "query string, layout string, read_files bigint, read_partitions bigint, "
        "read_rows bigint, kept_rows bigint",
    )


def measured_scans(warehouse: Warehouse, p: Params) -> DataFrame:
    """Planned against actual scans, with the columns that follow from the data alone.

    How many files there are, and which rows of a month a row group's bounds leave out,
    depends on how the tables were written; that scans keep to the plan doesn't. Months
    are those a scan took as partitions, 0 on the plain table.
    """
    plan = planned(warehouse, p).join(surviving_rows(warehouse, p), ["query", "layout"])
    return plan.join(scanned(warehouse, p), ["query", "layout"], "left").select(
        "query",
        "layout",
        F.col("rows").alias("planned_rows"),
        F.col("read_partitions").alias("months"),
        (F.col("read_files") == F.col("planned_files")).alias("files_as_planned"),
        F.col("read_rows").between(F.col("kept_rows"), F.col("rows")).alias("rows_within_plan"),
    )


def row_comparison(measured: DataFrame) -> DataFrame:
    """One row per query: the rows that both layouts have to look at, and the savings."""
    sides = (
        measured.groupBy("query")
        .pivot("layout", list(LAYOUTS))
        .agg(
            F.first("planned_rows").alias("rows"),
            F.first("months").alias("months"),
            F.first("rows_within_plan").alias("within_plan"),
        )
    )
    return sides.withColumn("rows_reduction_pct", _saved("rows")).orderBy("query")


def surviving_rows(warehouse: Warehouse, p: Params) -> DataFrame:
    """Rows in the partitions that pruning leaves, per query and layout.

    The part of the comparison that follows from the data alone: files and bytes depend on
    how they were written.
    """
    rows = []
    for query in QUERIES:
        for layout, name in LAYOUTS.items():
            data = warehouse.read(name)
            if layout == "opt" and query in _MONTHS:
                data = data.where(F.col(PARTITION_KEY).between(*getattr(p, _MONTHS[query])))
            rows.append(
                data.agg(F.count(F.lit(1)).alias("rows")).select(
                    F.lit(query).alias("query"), F.lit(layout).alias("layout"), "rows"
                )
            )
    return reduce(DataFrame.unionByName, rows)


def _saved(measure: str) -> Column:
    """How many percent less the copy takes than the plain table."""
    base, opt = F.col(f"base_{measure}"), F.col(f"opt_{measure}")
    return F.round(F.try_divide((base - opt) * 100, base), 1)


def comparison(measured: DataFrame) -> DataFrame:
    """One row per query: both layouts side by side and the savings in percent."""
    sides = (
        measured.groupBy("query")
        .pivot("layout", list(LAYOUTS))
        .agg(
            F.first("planned_files").alias("files"),
            F.first("planned_bytes").alias("planned_bytes"),
            F.first("real_bytes").alias("real_bytes"),
            F.first("real_rows").alias("real_rows"),
        )
    )
    return sides.withColumns(
        {
            "planned_reduction_pct": _saved("planned_bytes"),
            "reduction_pct": _saved("real_bytes"),
        }
    ).orderBy("query")
