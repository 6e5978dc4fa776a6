"""The month-partitioned, sorted copy of the fact."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from punctual.contracts import CLUSTER_KEYS, FACT, FACT_OPT, PARTITION_KEY
from punctual.session import MAX_SHUFFLE_PARTITIONS
from punctual.sources.warehouse import Warehouse

FILE_BYTES = 128 * 1024 * 1024
# Rows lie in cluster order, so a row group holds few states: small ones let a filter on
# the state skip most of a file. Sellers of a state aren't all apart; a Bloom filter of
# their ids, as large as they need, lets a row group without one seller be skipped.
CLUSTER_OPTIONS = {
    "parquet.block.size": str(16 * 1024 * 1024),
    "parquet.bloom.filter.enabled#seller_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def write_partitioned(
    warehouse: Warehouse, source: str = FACT, target: str = FACT_OPT, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Replace ``target`` by ``source``, one folder per month, rows in cluster order.

    Rows are range-partitioned by (month, seller_state, seller_id, order_id). A month is
    cut into as many files as its size needs, each with its own range of states, so a
    filter on the state skips files and row groups. The order id comes last only to make
    the range key divisible: a seller or month with a third of all rows still spreads
    over many tasks. A task writes ``file_bytes``, or down to a quarter of it where cores
    would idle, plus one file for each month boundary in its range. Beyond
    ``MAX_SHUFFLE_PARTITIONS`` tasks a task writes several files instead, cut by their
    number of rows, so that map tasks times reducers stays bounded.
    """
    table = warehouse.read(source)
    tasks, records = plan_files(
        warehouse.size_bytes(source),
        table.count(),
        file_bytes,
        warehouse.spark.sparkContext.defaultParallelism,
    )
    rows = (
        table
        .repartitionByRange(tasks, PARTITION_KEY, *CLUSTER_KEYS, "order_id")
        .sortWithinPartitions(PARTITION_KEY, *CLUSTER_KEYS)
    )
    return warehouse.replace(target, rows, (PARTITION_KEY,), records, CLUSTER_OPTIONS)


def plan_files(size: int, rows: int, file_bytes: int, cores: int) -> tuple[int, int]:
    """How many tasks write a table of ``size`` bytes, and the rows of a file at most."""
    files = size / file_bytes
    tasks = max(1, math.ceil(files), min(cores, math.ceil(4 * files)))
    records = math.ceil(rows / files) if files else 0
    return min(tasks, MAX_SHUFFLE_PARTITIONS), max(1, records)
