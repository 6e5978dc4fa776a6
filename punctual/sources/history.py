"""Job history: what Spark itself recorded about the jobs it ran.

Spark's event log is the counterpart of a warehouse's job table. It has to be written
plain (``spark.eventLog.compress=false``) to be readable while the application runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.scalar import text_or_null
from punctual.sources import files

# The field names of the event log.
_EVENTS = """
    `Event` string, `Job ID` bigint, `Stage ID` bigint, `Stage IDs` array<bigint>,
    `Submission Time` bigint, `Completion Time` bigint,
    `Properties` map<string,string>, `Job Result` struct<`Result`: string>,
    `Task Metrics` struct<`Executor Run Time`: bigint,
                          `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>>
"""


DEFAULT_FOLDER = "file:/tmp/spark-events"  # Spark's own, where none is set


def logs_events(spark: SparkSession) -> bool:
    """Whether the session writes an event log that can be read while it runs."""
    conf = spark.sparkContext.getConf()
    return (
        conf.get("spark.eventLog.enabled", "false") == "true"
        and conf.get("spark.eventLog.compress", "true") == "false"
    )


def event_log_path(spark: SparkSession) -> str | None:
    """This application's event log, or None where the session writes no readable one."""
    conf = spark.sparkContext.getConf()
    if not logs_events(spark):
        return None
    folder = conf.get("spark.eventLog.dir", DEFAULT_FOLDER).rstrip("/")
    app = spark.sparkContext.applicationId
    rolling, single = f"{folder}/eventlog_v2_{app}*/events_*", f"{folder}/{app}*"
    return next((path for path in (rolling, single) if files.matches(spark, path)), None)


def job_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished or running job of the application logged at ``path``."""
    events = spark.read.schema(_EVENTS).json(path)
    started = events.where("Event = 'SparkListenerJobStart'").select(
        F.col("Job ID").alias("job_id"),
        F.timestamp_millis("Submission Time").alias("creation_time"),
        F.col("Properties")["spark.job.description"].alias("description"),
        F.col("Properties").alias("properties"),
        F.col("Stage IDs").alias("stages"),
    )
    ended = events.where("Event = 'SparkListenerJobEnd'").select(
        F.col("Job ID").alias("job_id"),
        F.when(F.col("Job Result.Result") == "JobSucceeded", "DONE")
        .otherwise("FAILED")
        .alias("state"),
    )
    tasks = (
        events.where("Event = 'SparkListenerTaskEnd'")
        .groupBy(F.col("Stage ID").alias("stage_id"))
        .agg(
            F.sum("Task Metrics.Input Metrics.Bytes Read").alias("bytes"),
            F.sum("Task Metrics.Input Metrics.Records Read").alias("records"),
            F.sum("Task Metrics.Executor Run Time").alias("task_ms"),
        )
    )
    # A stage that several jobs list ran in the first of them.
    work = (
        started.select("job_id", F.explode("stages").alias("stage_id"))
        .groupBy("stage_id")
        .agg(F.min("job_id").alias("job_id"))
        .join(tasks, "stage_id")
        .groupBy("job_id")
        .agg(
            F.sum("bytes").alias("total_bytes_processed"),
            F.sum("records").alias("total_records_read"),
            F.sum("task_ms").alias("total_task_ms"),
        )
    )
    return (
        started.drop("stages")
        .join(ended, "job_id", "left")
        .join(work, "job_id", "left")
        .select(
            "job_id",
            "creation_time",
            F.coalesce("state", F.lit("RUNNING")).alias("state"),
            "description",
            "properties",
            F.coalesce("total_bytes_processed", F.lit(0)).alias("total_bytes_processed"),
            F.coalesce("total_records_read", F.lit(0)).alias("total_records_read"),
            F.coalesce("total_task_ms", F.lit(0)).alias("total_task_ms"),
        )
    )


def recent(
    jobs: DataFrame, created: str, text: str, now: Column, hours: int, like: str, unlike: str
) -> DataFrame:
    """Jobs of the last ``hours`` before ``now`` whose text is LIKE one and not the other."""
    since = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    return jobs.where(
        (F.col(created) > since) & F.col(text).like(like) & ~F.col(text).like(unlike)
    )


def tag_part(text: str, pattern: str) -> Column:
    """The first group of ``pattern`` in the job text, NULL where it does not occur."""
    return text_or_null(F.regexp_extract(text, pattern, 1))
