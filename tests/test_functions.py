"""Rounding and time buckets."""

import duckdb
import pytest
from pyspark.sql import functions as F

from loadgrain.functions.numbers import int_half_even, round_half_up
from loadgrain.functions.timebuckets import (
    month_bucket,
    sample_time,
    seconds,
    time_bucket,
)


@pytest.mark.parametrize(("divisor", "digits"), [(3, 1), (8, 2), (7, 1), (16, 3)])
def test_rounding_matches(spark, divisor, digits):
    values = spark.range(-2000, 20000).select((F.col("id") / divisor).alias("v"))
    mine = [r[0] for r in values.select(round_half_up(F.col("v"), digits)).collect()]
    sql = f"SELECT round(range / {divisor}.0::DOUBLE, {digits}) FROM range(-2000, 20000)"
    assert mine == [r[0] for r in duckdb.sql(sql).fetchall()]


def test_half_even(spark):
    values = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-1.5,), (2.4,)], "v double")
    assert [r[0] for r in values.select(int_half_even(F.col("v"))).collect()] == [0, 2, 2, 0, -2, 2]


TIMES = [
    "1969-12-31 23:59:58.999999", "1999-12-31 23:59:59.5", "2000-01-02 23:59:59.999999",
    "2000-01-03 00:00:00", "2024-02-29 12:34:56.789012", "2026-05-11 12:00:00",
]


def nanos(spark):
    rows = spark.createDataFrame([(t,) for t in TIMES], "t string")
    return rows.select(
        "t", (F.unix_micros(F.col("t").cast("timestamp")) * 1000 + 999).alias("ts_unix_nano")
    )


@pytest.mark.parametrize("width", ["5 seconds", "1 hour", "7 hours", "7 days", "250ms", "90m"])
def test_time_bucket_matches(spark, width):
    micros = round(seconds(width) * 1_000_000)
    mine = nanos(spark).select("t", time_bucket(width).cast("timestamp_ntz").alias("b")).collect()
    for row in mine:
        sql = f"SELECT time_bucket(to_microseconds({micros}), TIMESTAMP '{row.t}')"
        assert row.b == duckdb.sql(sql).fetchall()[0][0]


@pytest.mark.parametrize("months", [1, 3, 5, 12])
def test_month_bucket_matches(spark, months):
    mine = nanos(spark).select("t", month_bucket(months).cast("timestamp_ntz").alias("b"))
    for row in mine.collect():
        sql = f"SELECT time_bucket(INTERVAL {months} MONTH, TIMESTAMP '{row.t}')"
        assert row.b == duckdb.sql(sql).fetchall()[0][0]


def test_sample_time_rounds_down(spark):
    rows = spark.createDataFrame([(1,), (1_700_000_000_123_456_789,), (-1,)], "ts_unix_nano long")
    shown = [str(r[0]) for r in rows.select(sample_time().cast("timestamp_ntz")).collect()]
    assert shown == [
        "1970-01-01 00:00:00", "2023-11-14 22:13:20.123456", "1969-12-31 23:59:59.999999",
    ]


@pytest.mark.parametrize(
    ("text", "value"), [("1s", 1), ("10ms", 0.01), ("1h30m", 5400), ("2 minutes", 120), (3, 3)]
)
def test_durations(text, value):
    assert seconds(text) == value


@pytest.mark.parametrize("text", ["", "soon", "5", "5 parsecs", "not-a-duration"])
def test_bad_durations(text):
    with pytest.raises(ValueError, match="not a duration"):
        seconds(text)
