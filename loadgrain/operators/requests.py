"""Counts, rates and averages per section of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.functions.numbers import int_half_even, round_half_up

# Phase metric, report column and decimals, in the order of a request's life.
PHASES = (
    ("http_req_blocked", "blocked_ms", 1),
    ("http_req_connecting", "connect_ms", 1),
    ("http_req_tls_handshaking", "tls_ms", 1),
    ("http_req_sending", "send_ms", 2),
    ("http_req_waiting", "wait_ms", 1),
    ("http_req_receiving", "recv_ms", 1),
)


def metric_name() -> Column:
    return F.col("metric_name")


def group_section() -> Column:
    """The section a sample's group names: nested groups are joined by ``::``."""
    return F.replace(F.col("group"), F.lit("::"), F.lit(""))


def like_request_metric() -> Column:
    """``LIKE 'http_req_%'``: each ``_`` stands for any character.

    So ``http_reqs`` matches too. Catalyst pushes no such pattern to the scan,
    hence the prefix it implies is stated next to it.
    """
    return metric_name().startswith("http") & metric_name().like("http_req_%")


def average_where(metric: str) -> Column:
    return F.avg(F.when(metric_name() == metric, F.col("value")))


def request_phases(samples: DataFrame, by: str = "name") -> DataFrame:
    """Average time per request phase, one column per phase, in one pass.

    Sections seen only in the request counter appear with NULL phases.
    """
    section = F.col(by)
    return (
        samples.where(
            like_request_metric()
            & ~metric_name().isin("http_req_duration", "http_req_failed")
            & section.isNotNull()
        )
        .groupBy(section.alias("section"))
        .agg(*[round_half_up(average_where(m), d).alias(out) for m, out, d in PHASES])
        .orderBy(F.desc_nulls_last("wait_ms"), "section")
    )


def phase_averages(samples: DataFrame) -> DataFrame:
    """Average per name and phase metric in long form; trends only, unrounded."""
    return (
        samples.where(like_request_metric() & (F.col("metric_type") == "trend"))
        .groupBy("name", "metric_name")
        .agg(F.avg("value").alias("avg"))
    )


def check_pass_rate(samples: DataFrame) -> DataFrame:
    """Share of passed checks; checks carry a group, never a name."""
    return (
        samples.where(metric_name() == "checks")
        .groupBy(group_section().alias("section"), F.col("check").alias("check_name"))
        .agg(
            F.count("*").alias("n"),
            round_half_up(F.avg("value") * 100, 2).alias("pass_pct"),
        )
        .orderBy(
            F.asc_nulls_last("pass_pct"), F.asc_nulls_last("section"), F.asc_nulls_last("check_name")
        )
    )


def pass_rate_by_check(samples: DataFrame) -> DataFrame:
    """Pass rate per name and check, unrounded."""
    return (
        samples.where(metric_name() == "checks")
        .groupBy("name", "check")
        .agg(F.avg("value").alias("pass_rate"))
    )


def error_rate(samples: DataFrame, by: str = "name") -> DataFrame:
    """Share of failed requests."""
    return (
        samples.where(metric_name() == "http_req_failed")
        .groupBy(F.col(by).alias("section"))
        .agg(
            F.count("*").alias("requests"),
            round_half_up(F.avg("value") * 100, 2).alias("error_pct"),
        )
        .orderBy(F.desc_nulls_last("error_pct"), F.asc_nulls_last("section"))
    )


def status_distribution(samples: DataFrame, by: str = "name") -> DataFrame:
    """Requests per section and response status."""
    return (
        samples.where(metric_name() == "http_req_duration")
        .groupBy(F.col(by).alias("section"), "status")
        .agg(F.count("*").alias("n"))
        .orderBy(F.asc_nulls_last("section"), F.asc_nulls_last("status"))
    )


def iteration_balance(samples: DataFrame, by: str = "name") -> DataFrame:
    """Iterations per section, counted by the one request each makes."""
    return (
        samples.where(metric_name() == "http_reqs")
        .groupBy(F.col(by).alias("section"))
        .agg(F.count("*").alias("iterations"))
        .orderBy(F.desc_nulls_last("iterations"), F.asc_nulls_last("section"))
    )


def script_overhead(samples: DataFrame) -> DataFrame:
    """How much longer a section takes than its requests do."""
    http, group = average_where("http_req_duration"), average_where("group_duration")
    return (
        samples.where(metric_name().isin("http_req_duration", "group_duration"))
        .groupBy(F.coalesce(F.col("name"), group_section()).alias("section"))
        .agg(
            round_half_up(http, 1).alias("http_avg_ms"),
            round_half_up(group, 1).alias("group_avg_ms"),
            round_half_up(group - http, 1).alias("overhead_ms"),
        )
        .orderBy(F.desc_nulls_last("overhead_ms"), F.asc_nulls_last("section"))
    )


def bytes_received(samples: DataFrame, by: str = "group") -> DataFrame:
    """Bytes received per group; NULL for bytes that belong to no request."""
    return (
        samples.where(metric_name() == "data_received")
        .groupBy(F.col(by))
        .agg(F.sum("value").alias("bytes"))
        .orderBy(F.desc_nulls_last("bytes"), F.asc_nulls_last(by))
    )


def latency_histogram(samples: DataFrame, width: int = 50) -> DataFrame:
    """Number of request durations in each step of ``width`` ms."""
    if width <= 0:
        raise ValueError("width must be > 0")
    step = F.floor(F.col("value") / width) * F.lit(width)
    return (
        samples.where(metric_name() == "http_req_duration")
        .groupBy(step.cast("bigint").alias("ms_bucket_lower"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.asc_nulls_last("ms_bucket_lower"))
    )


def with_bars(histogram: DataFrame, per_mark: int) -> DataFrame:
    """A histogram with a text bar: a mark for every ``per_mark`` of a step's number.

    Choose it by the largest number, as bars are as long as that takes.
    """
    if per_mark <= 0:
        raise ValueError("per_mark must be > 0")
    return histogram.withColumn(
        "bar", F.repeat(F.lit("▇"), int_half_even(F.col("n") / per_mark))
    )
