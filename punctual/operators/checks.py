"""Declarative checks: each input is scanned once, the checks compare its numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``bad_rows`` is computed from the one-row measurements, named ``input.measure``."""

    name: str
    bad_rows: Column
    description: str


class GateFailed(Exception):
    """A gate found bad rows; ``failures`` are the rows of the report that failed."""

    def __init__(self, title: str, failures: list[Row]):
        self.failures = failures
        detail = "; ".join(f"{row.check_name}={row.bad_rows}" for row in failures)
        super().__init__(f"{title}: {detail}")


def zero_or_one(ok: Column) -> Column:
    """0 where ``ok`` holds, 1 where it is false or unknown."""
    return F.when(ok, F.lit(0)).otherwise(F.lit(1))


def report(
    spark: SparkSession, measurements: dict[str, DataFrame], checks: Sequence[Check]
) -> DataFrame:
    """PASS or FAIL per check, worst first.

    Every measurement is an aggregate without grouping, so it enters as an
    uncorrelated scalar subquery of one struct: evaluated once, whatever number of
    checks reads it, and compared to the others without a join.
    """
    base = spark.range(0, 1, 1, 1).select(
        *(
            df.select(F.struct(*df.columns)).scalar().alias(name)
            for name, df in measurements.items()
        )
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(check.name).alias("check_name"),
                check.bad_rows.cast("bigint").alias("bad_rows"),
                F.when(check.bad_rows == 0, "PASS").otherwise("FAIL").alias("status"),
                F.lit(check.description).alias("description"),
            )
            for check in checks
        )
    )
    return base.select(F.inline(rows)).orderBy(F.desc("bad_rows"), "check_name")


def gate_total(checks: DataFrame) -> DataFrame:
    """All bad rows of a report; an empty report totals 0."""
    return checks.agg(F.coalesce(F.sum("bad_rows"), F.lit(0)).alias("bad_rows"))


def enforce(checks: DataFrame, title: str) -> list[Row]:
    """Print the report, then raise if any check found a bad row.

    A report has one row per check, so collecting it is bounded; it is evaluated once.
    """
    rows = checks.collect()
    for row in rows:
        print(f"{row.status}  {row.check_name:<30} {row.bad_rows:>12}  {row.description}")
    failures = [row for row in rows if row.bad_rows != 0]
    if failures:
        raise GateFailed(title, failures)
    return rows
