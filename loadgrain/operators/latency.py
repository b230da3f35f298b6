"""Percentiles of request durations and the requests in their tail."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.functions.numbers import round_half_up
from loadgrain.functions.percentiles import grouped_percentiles
from loadgrain.functions.ranks import average_ranks
from loadgrain.functions.timebuckets import sample_time
from loadgrain.session import settle

BY_NAME = {"section": "name"}


def durations(samples: DataFrame, by: Mapping[str, str | Column], metric: str) -> DataFrame:
    """The samples of one trend metric: the keys under their new names, and the value."""
    keys = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in by.items()]
    return samples.where(F.col("metric_name") == metric).select(*keys, "value")


def latency_percentiles(
    samples: DataFrame,
    by: Mapping[str, str | Column] = BY_NAME,
    metric: str = "http_req_duration",
    method: str = "exact",
    **limits: int,
) -> DataFrame:
    """Samples, p50, p95, p99 and maximum per section, slowest p95 first."""
    table = grouped_percentiles(
        durations(samples, by, metric),
        list(by),
        {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99},
        aggs={"samples": ("count", "*"), "max_ms": ("max", "value")},
        method=method,
        **limits,
    )
    rounded = [round_half_up(F.col(c), 1).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms", "max_ms")]
    return table.select(*by, "samples", *rounded).orderBy(
        F.desc_nulls_last("p95_ms"), *[F.asc_nulls_last(k) for k in by]
    )


def p95_by(
    samples: DataFrame,
    by: Mapping[str, str | Column],
    alias: str = "p95_ms",
    count_as: str | None = None,
    metric: str = "http_req_duration",
    method: str = "exact",
) -> DataFrame:
    """Unrounded p95 per group, with the number of samples if asked for."""
    aggs = {count_as: ("count", "*")} if count_as else {}
    return grouped_percentiles(
        durations(samples, by, metric), list(by), {alias: 0.95}, aggs=aggs, method=method
    ).orderBy(F.desc_nulls_last(alias), *[F.asc_nulls_last(k) for k in by])


def slowest_requests(samples: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` slowest requests; equal durations in order of time."""
    return (
        samples.where(F.col("metric_name") == "http_req_duration")
        .orderBy(F.desc_nulls_last("value"), F.asc("ts_unix_nano"), F.asc_nulls_last("name"))
        .limit(k)
        .select(
            sample_time().alias("ts"),
            F.col("name").alias("section"),
            "method",
            "status",
            round_half_up(F.col("value"), 1).alias("duration_ms"),
        )
    )


def tail_outliers(
    samples: DataFrame, fraction: float = 0.99, by: str = "name", method: str = "exact"
) -> DataFrame:
    """Every request slower than its section's ``fraction`` percentile.

    The limits are settled first, so they are broadcast only if they are small.
    """
    requests = samples.where(F.col("metric_name") == "http_req_duration")
    limits = settle(
        grouped_percentiles(
            requests.select(F.col(by).alias("section"), "value"),
            ["section"],
            {"limit_ms": fraction},
            method=method,
        ),
        "limits",
    )
    return (
        requests.join(limits, requests[by].eqNullSafe(limits["section"]))
        .where(F.col("value") > F.col("limit_ms"))
        .select(
            sample_time().alias("ts"),
            "section",
            "method",
            "status",
            F.col("value").alias("duration_ms"),
            "limit_ms",
        )
    )


def status_timing(samples: DataFrame, method: str = "exact") -> DataFrame:
    """How request duration depends on the response status."""
    table = grouped_percentiles(
        durations(samples, {"status": "status"}, "http_req_duration"),
        ["status"],
        {"p50_ms": 0.50, "p95_ms": 0.95},
        aggs={"requests": ("count", "*"), "avg_ms": ("avg", "value")},
        method=method,
    )
    rounded = [round_half_up(F.col(c), 1).alias(c) for c in ("avg_ms", "p50_ms", "p95_ms")]
    return table.select("status", "requests", *rounded).orderBy(F.asc_nulls_last("status"))


def status_correlation(samples: DataFrame, by: str = "name") -> DataFrame:
    """Correlation of response status and duration per section."""
    status = F.col("status").cast("double")
    return (
        samples.where(F.col("metric_name") == "http_req_duration")
        .groupBy(F.col(by).alias("section"))
        .agg(F.count("*").alias("requests"), F.corr(status, "value").alias("status_corr"))
        .orderBy(F.asc_nulls_last("section"))
    )


def status_association(samples: DataFrame, by: str = "name") -> DataFrame:
    """How much of a section's request durations goes with the response status.

    Statuses are names, not sizes, and durations are skewed, so this goes by ranks: the
    Kruskal-Wallis H over the statuses (corrected for ties), and eta squared, the share
    of the ranks' variance between them. NULL where a section has one status only, as
    many statuses as requests, or equal durations throughout.
    """
    timed = samples.where(
        (F.col("metric_name") == "http_req_duration") & F.col("value").isNotNull()
    )
    counts = timed.groupBy(F.col(by).alias("section"), "status", "value").agg(F.count("*").alias("n"))
    ranked = average_ranks(counts, ["section"], "value", "n")
    # Once per value of a section, however many statuses share it: by its share in the ties.
    tied = F.col("n") * (F.col("ties") * F.col("ties") - 1.0)
    per_status = ranked.groupBy("section", "status").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("rank") * F.col("n")).alias("ranks"),
        F.sum(tied).alias("tied"),
    )
    n, k = F.col("requests"), F.col("statuses")
    between = 12 * F.col("squares") / (n * (n + 1.0)) - 3 * (n + 1.0)
    correction = 1 - F.col("tied") / (n * (n * n - 1.0))
    table = per_status.groupBy("section").agg(
        F.sum("n").alias("requests"),
        F.count("*").alias("statuses"),
        F.sum(F.col("ranks") * F.col("ranks") / F.col("n")).alias("squares"),
        F.sum("tied").alias("tied"),
    )
    enough = (k > 1) & (n > k) & (F.col("tied") < n * (n * n - 1.0))
    h = F.when(enough, between / correction)
    return (
        table.select("section", "requests", "statuses", h.alias("h"))
        .select("*", ((F.col("h") - k + 1) / (n - k)).alias("eta_squared"))
        .orderBy(F.asc_nulls_last("section"))
    )


def tag_percentiles(samples: DataFrame, tag: str, method: str = "exact") -> DataFrame:
    """Requests and p95 per value of a custom tag; NULL for requests without it."""
    return p95_by(samples, {"tag": F.col("extra_tags")[tag]}, count_as="samples", method=method)
