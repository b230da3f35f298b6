"""A run over time: throughput, p95 and concurrency per bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.numbers import int_half_even, round_half_up
from loadgrain.functions.percentiles import grouped_percentiles
from loadgrain.functions.timebuckets import seconds, time_bucket
from loadgrain.session import settle


def value_of(metric: str) -> Column:
    return F.when(F.col("metric_name") == metric, F.col("value"))


def throughput_over_time(
    samples: DataFrame,
    width: str | int = "5 seconds",
    bucket: Column | None = None,
    method: str = "exact",
    **limits: int,
) -> DataFrame:
    """Requests, p95 and virtual users per time bucket.

    Every sample opens its bucket, whatever its metric.
    """
    table = _throughput(samples, width, bucket, method, **limits)
    return table.withColumn("p95_ms", round_half_up(F.col("p95_ms"), 1)).orderBy("bucket")


def _throughput(samples, width, bucket=None, method="exact", **limits) -> DataFrame:
    """The series with its p95 unrounded.

    Counts need all samples; the percentiles read the one metric they are of.
    """
    bucket = (time_bucket(width) if bucket is None else bucket).alias("bucket")
    counts = samples.groupBy(bucket).agg(
        F.count_if(F.col("metric_name") == "http_reqs").alias("reqs"),
        F.max(value_of("vus")).alias("vus"),
    )
    timed = samples.where(F.col("metric_name") == "http_req_duration").select(bucket, "value")
    p95 = grouped_percentiles(timed, ["bucket"], {"p95_ms": 0.95}, method=method, **limits)
    p95 = p95.withColumnRenamed("bucket", "timed")
    return counts.join(p95, F.col("bucket").eqNullSafe(F.col("timed")), "left").select(
        "bucket", "reqs", "p95_ms", int_half_even(F.col("vus")).alias("vus")
    )


def first_breach(
    samples: DataFrame, limit_ms: float, width: str | int = "5 seconds", method: str = "exact"
) -> DataFrame:
    """The first bucket whose p95 lies above ``limit_ms``, compared before rounding."""
    return (
        _throughput(samples, width, method=method)
        .where(F.col("p95_ms") > limit_ms)
        .orderBy("bucket")
        .limit(1)
        .select("bucket", "reqs", round_half_up(F.col("p95_ms"), 1).alias("p95_ms"))
    )


def breach_spans(
    samples: DataFrame,
    limit_ms: float,
    width: str | int = "5 seconds",
    buckets: int = 12,
    fraction: float = 0.95,
    run: str = "run_id",
) -> DataFrame:
    """When a run's p95 lay above ``limit_ms``, and for how long.

    p95 is that of a window of so many buckets, which slides on by one; there is a window
    for every bucket with requests, and it ends with it. Windows over the limit that
    follow each other make a span: the first and the last of these buckets, their number
    and the worst p95. Each bucket's durations are counted by value once, and the counts
    are what windows are put together from.
    """
    step = int(round(seconds(width)))
    at = F.unix_micros(time_bucket(width).cast("timestamp"))
    counts = (
        samples.where(F.col("metric_name") == "http_req_duration")
        .groupBy(F.col(run).alias("run"), (at / 1_000_000).cast("bigint").alias("at"), "value")
        .agg(F.count("*").alias("n"))
    )
    counts = settle(counts, "value-counts")
    ends = counts.select(F.col("run").alias("of"), F.col("at").alias("end")).distinct()
    within = F.explode(F.sequence(F.col("at"), F.col("at") + F.lit((buckets - 1) * step), F.lit(step)))
    slid = counts.select("run", "value", "n", within.alias("end"))
    slid = slid.join(ends.withColumnRenamed("end", "to"), (F.col("end") == F.col("to")) & F.col("run").eqNullSafe(F.col("of")))
    p95 = grouped_percentiles(slid, ["run", "end"], {"p95": fraction}, weight="n")
    breaches = p95.where(F.col("p95") > limit_ms)
    # The windows of one run are in one task; a run has no more than it has buckets.
    in_run = Window.partitionBy("run").orderBy("end")
    place = F.row_number().over(in_run)
    spans = breaches.withColumn("island", F.col("end") - place * step).groupBy("run", "island")
    return (
        spans.agg(
            F.timestamp_seconds(F.min("end")).alias("started"),
            F.timestamp_seconds(F.max("end")).alias("ended"),
            F.count("*").alias("windows"),
            round_half_up(F.max("p95"), 1).alias("worst_p95_ms"),
        )
        .drop("island")
        .withColumnRenamed("run", "run_id")
        .orderBy(F.asc_nulls_last("run_id"), "started")
    )
