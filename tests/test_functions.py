from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from punctual.functions import scalar


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2017-10-02 10:56:33", datetime.datetime(2017, 10, 2, 10, 56, 33)),
        ("2017-10-02T10:56:33.25", datetime.datetime(2017, 10, 2, 10, 56, 33, 250000)),
        ("2017-10-02 10:56:33+02:00", datetime.datetime(2017, 10, 2, 8, 56, 33)),
        ("2017-10-02 10:56:33 UTC", datetime.datetime(2017, 10, 2, 10, 56, 33)),
        ("2017-10-02", datetime.datetime(2017, 10, 2)),
        ("2017-1-2", datetime.datetime(2017, 1, 2)),
        ("2017", None),
        ("2017-10", None),
        ("today", None),
        ("abc", None),
        ("", None),
        (None, None),
        ("2017-13-01", None),
        ("2017-02-30 00:00:00", None),
    ],
)
def test_safe_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(scalar.safe_timestamp(df, "v")).first()[0] == expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_safe_timestamp_of_typed_columns(spark, kind):
    df = spark.sql(f"SELECT cast('2018-03-04' AS {kind}) AS v")
    out = df.select(scalar.safe_timestamp(df, "v").alias("v"))
    assert out.schema["v"].dataType.simpleString() == "timestamp_ntz"
    assert out.first().v == datetime.datetime(2018, 3, 4)


def test_safe_timestamp_of_a_number_is_null(spark):
    df = spark.createDataFrame([(20171002,)], "v bigint")
    assert df.select(scalar.safe_timestamp(df, "v")).first()[0] is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [("58.905", Decimal("58.905")), ("1e3", Decimal(1000)), ("x", None), ("", None), (None, None)],
)
def test_safe_numeric(spark, text, expected):
    assert one(spark, text, "string", scalar.safe_numeric("v")) == expected


def test_safe_numeric_of_a_double_keeps_its_decimal_form(spark):
    assert one(spark, 58.9, "double", scalar.safe_numeric("v")) == Decimal("58.9")


def test_rounding_ties_go_away_from_zero(spark):
    days = spark.createDataFrame(
        [(1, 1)] + [(1, 0)] * 199 + [(2, -1)] + [(2, 0)] * 199 + [(3, 201)] + [(3, 0)] * 199,
        "k int, v bigint",
    )
    means = days.groupBy("k").agg(F.round(F.avg("v"), 2).alias("m"))
    # 1/200 = 0.005, -1/200 and 201/200 = 1.005, which has no exact double
    assert {r.k: r.m for r in means.collect()} == {1: 0.01, 2: -0.01, 3: 1.01}


def test_mean_money_is_exact(spark):
    rows = [("1.005",), ("1.005",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(scalar.safe_numeric("t").alias("v"))
    row = df.agg(
        scalar.mean_money("v").alias("m"), F.round(scalar.mean_money("v"), 2).alias("r")
    ).first()
    assert (row.m, row.r) == (Decimal("1.005"), Decimal("1.01"))
    assert df.where("v > 5").agg(scalar.mean_money("v").alias("m")).first().m is None


def test_flag_of_unknown_is_on_time(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "late boolean")
    assert [r[0] for r in df.select(scalar.flag(F.col("late"), 100)).collect()] == [0, 100, 100]


def test_month_forms(spark):
    day = datetime.date(2018, 1, 31)
    assert one(spark, day, "date", scalar.month_key(F.col("v"))) == 201801
    assert one(spark, day, "date", scalar.month_text(F.col("v"))) == "201801"
    assert one(spark, day, "date", scalar.month_label(F.col("v"))) == "Jan 2018"
    assert one(spark, 201802, "bigint", scalar.month_start(F.col("v"))) == datetime.date(2018, 2, 1)


def test_month_thirteen_raises(spark):
    with pytest.raises(Exception, match="MonthOfYear"):
        one(spark, 201813, "bigint", scalar.month_start(F.col("v")))


def test_range_bucket_agrees_with_counting_bounds(spark):
    low, high, step = 201601, 201912, 7
    bounds = F.sequence(F.lit(low), F.lit(high), F.lit(step))
    df = spark.range(201590, 201930).unionByName(
        spark.createDataFrame([(None,)], "id bigint")
    )
    both = df.select(
        scalar.range_bucket(F.col("id"), low, high, step).alias("a"),
        scalar.range_bucket_of(F.col("id"), bounds).alias("b"),
    )
    assert both.where("NOT a <=> b").isEmpty()
    assert both.where("a IS NULL").count() == 1


def test_december_2017_bucket(spark):
    assert one(spark, 201712, "bigint", scalar.range_bucket(F.col("v"), 201601, 201912, 1)) == 112


def test_text_or_null(spark):
    pattern = F.regexp_extract("v", "k=([0-9]+)", 1)
    assert one(spark, "k=7", "string", scalar.text_or_null(pattern)) == "7"
    assert one(spark, "none", "string", scalar.text_or_null(pattern)) is None


def test_safe_timestamp_in_any_session_zone(spark):
    texts = {
        "2017-10-02 10:56:33": "2017-10-02 10:56:33",
        "2017-03-12 02:30:00": "2017-03-12 02:30:00",  # skipped by the clocks of New York
        "2017-10-02 10:56:33Z": "2017-10-02 10:56:33",
        "2017-10-02 10:56:33.5+02:00": "2017-10-02 08:56:33.5",
        "1960-01-01T00:00:00 America/New_York": "1960-01-01 05:00:00",
        "2017-10-02": "2017-10-02 00:00:00",
    }
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set(zone, name)
            df = spark.createDataFrame(list(texts.items()), "v string, w string")
            typed = spark.sql("SELECT timestamp_micros(1506941793000000) AS v")
            wrong = df.where(~scalar.safe_timestamp(df, "v").eqNullSafe(F.col("w").cast("timestamp_ntz")))
            assert wrong.collect() == []
            instant = typed.select(scalar.safe_timestamp(typed, "v").cast("string")).first()[0]
            assert instant == "2017-10-02 10:56:33"
    finally:
        spark.conf.set(zone, before)
