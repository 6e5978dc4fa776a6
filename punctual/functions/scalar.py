"""Scalar expressions with the warehouse semantics the marts rely on.

All of them are built from JVM functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.contracts import NUMERIC

# A full date, optionally a full time of day, optionally a zone. Spark alone would also
# read '2017', '2017-10' and 'today', which must come out as NULL.
TIMESTAMP_TEXT = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"([ Tt]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?(\s*([Zz]|[+-]\d.*|[A-Za-z].*))?)?\z"
)

ZONED_TEXT = (
    r"^\d{4}-\d{1,2}-\d{1,2}[ Tt]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?"
    r"\s*([Zz]|[+-]\d.*|[A-Za-z].*)\z"
)


def safe_timestamp(df: DataFrame, name: str) -> Column:
    """``name`` as a UTC wall-clock timestamp; values that are none become NULL.

    The result has no zone, so the date taken from it never depends on the session. Text
    without a zone is taken as it is; text with one, and instants, are converted to UTC.
    """
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return _utc(column)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp_ntz")
    text = column.cast("string")
    return F.when(text.rlike(ZONED_TEXT), _utc(text.try_cast("timestamp"))).when(
        text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp_ntz")
    )


def _utc(instant: Column) -> Column:
    """The wall clock in UTC at an instant: the time since 1970, added to 1970."""
    seconds = F.unix_micros(instant).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    since = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + since


def safe_numeric(name: str) -> Column:
    """``name`` as exact money; values that are no number become NULL."""
    return F.col(name).try_cast(NUMERIC)


def month_key(date: Column) -> Column:
    """YYYYMM as a bigint, from integer arithmetic only."""
    return (F.year(date) * 100 + F.month(date)).cast("bigint")


def month_text(date: Column) -> Column:
    """YYYYMM as text: a second route to the key, used to verify it."""
    return F.date_format(date, "yyyyMM")


def month_start(key: Column) -> Column:
    """First day of the month a YYYYMM key names; a month 13 raises."""
    return F.to_date(key.cast("string"), "yyyyMM")


def month_label(date: Column) -> Column:
    return F.date_format(date, "MMM yyyy")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def flag(late: Column, on_time: int) -> Column:
    """0 when late, else ``on_time``; an unknown flag takes the else arm."""
    return F.when(late, F.lit(0)).otherwise(F.lit(on_time)).cast("bigint")


def mean_money(name: str) -> Column:
    """Mean of an exact money column, to 9 decimals."""
    return F.try_divide(F.sum(name), F.count(name)).cast(NUMERIC)


def text_or_null(text: Column) -> Column:
    """``regexp_extract`` says '' where there is no match; the callers want NULL."""
    return F.nullif(text, F.lit(""))


def range_bucket(value: Column, low: int, high: int, step: int) -> Column:
    """How many of the bounds low, low+step, ... <= high are <= ``value``.

    Equal steps need no array of bounds: the count is a division.
    """
    bounds = (high - low) // step + 1
    below = F.floor((value - F.lit(low)) / F.lit(step)) + 1
    inside = F.least(F.greatest(below, F.lit(0)), F.lit(bounds)).cast("bigint")
    return F.when(value.isNotNull(), inside)


def range_bucket_of(value: Column, bounds: Column) -> Column:
    """The same count for any sorted array of bounds."""
    inside = F.size(F.filter(bounds, lambda bound: bound <= value)).cast("bigint")
    return F.when(value.isNotNull(), inside)
